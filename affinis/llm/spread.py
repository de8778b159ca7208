"""Joins by keys of which one may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than one in so many rows is frequent; so there are fewer frequent keys than this.
FREQUENT = 4096
#: Rank of a null id, after all others.
LAST = (1 << 63) - 1


def wide_hash(*columns: Column) -> list[Column]:
    """128 bits of hash as two longs, ``h1`` and ``h2``."""
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(1), *columns).alias("h2")]


def join_spread(rows: DataFrame, found: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``found``, which has one row a key and in ``count`` the key's rows.

    Both should be stored tables. Frequent keys, fewer than ``FREQUENT`` rows of ``found``, are
    broadcast, so their rows stay where they are; all others are shuffled, and none of them has
    more than one in ``FREQUENT`` rows. Null keys meet nothing.
    """
    total = rows.count()
    frequent = found.filter(F.col(count) * FREQUENT > total)
    rest = found.filter(F.col(count) * FREQUENT <= total).drop(count)
    met = rows.join(F.broadcast(frequent.drop(count)), keys)
    others = rows.join(F.broadcast(frequent.select(*keys)), keys, "left_anti").join(rest, keys, how)
    return met.unionByName(others)
