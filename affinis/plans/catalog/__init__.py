"""The query catalog: every operator on the test tables, most with a SQL counterpart."""

from affinis.plans.catalog import analytics, modeling, preparation, serving, storage  # noqa: F401
from affinis.plans.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
