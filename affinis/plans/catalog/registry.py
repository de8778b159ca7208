"""Registration of catalog queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from affinis.plans import testdata
from affinis.plans.prepare import Prepared, prepare
from affinis.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows when there is one."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


_stages: dict[tuple, object] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """A stage table, made once per session from the source tables and then reread, as a
    pipeline keeps its intermediate tables."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stages:
        _stages[key] = make()
    return _stages[key]


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    return stage(spark, sf_dir, "prepared", lambda: prepare(testdata.ratings(spark, sf_dir)))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-item edges of the training matrix (50 neighbours)."""
    from affinis.operators.item_item import item_item_fit

    return stage(
        spark, sf_dir, "edges", lambda: cut_lineage(item_item_fit(prepared(spark, sf_dir).matrix, 50))
    )
