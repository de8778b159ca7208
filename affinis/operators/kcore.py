"""Iterated minimum-degree filter on the user-item graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from affinis.session import cut_lineage

# Share of rows that may be filtered lazily before the survivors are written again.
_REWRITE_SHARE = 0.2


def kcore_filter(
    interactions: DataFrame,
    min_user: int = 5,
    min_item: int = 10,
) -> DataFrame:
    """Drop users and items with too few rows until nothing changes.

    Each round counts users and items on the same rows in one aggregation (partial
    sums happen before the shuffle, so a heavy user or item costs one row per task)
    and keeps only the ids that fall short. Those short lists are removed by anti
    joins; the interactions are rewritten to the checkpoint folder only once enough
    of them are gone, not every round. Every round removes rows, so the loop ends by itself.
    """
    base = cut_lineage(interactions.filter("user_id IS NOT NULL AND item_id IS NOT NULL"))
    base_rows = base.count()
    out: DataFrame | None = None
    current, gone = base, 0
    while True:
        sides = F.array(
            F.struct(F.lit(True).alias("is_user"), F.col("user_id").cast("bigint").alias("id")),
            F.struct(F.lit(False).alias("is_user"), F.col("item_id").cast("bigint").alias("id")),
        )
        short = (
            current.select(F.explode(sides).alias("s"))
            .select("s.is_user", "s.id")
            .groupBy("is_user", "id")
            .agg(F.count(F.lit(1)).alias("n"))
            .filter(F.when(F.col("is_user"), F.col("n") < min_user).otherwise(F.col("n") < min_item))
        )
        seen = Observation()
        short = cut_lineage(short.observe(seen, F.count(F.lit(1)).alias("ids"), F.sum("n").alias("rows")))
        if not seen.get["ids"]:
            return current
        out = short if out is None else out.unionByName(short)
        current = _without(base, out)
        # an upper bound of the removed rows: a row may be short on both sides
        gone += seen.get["rows"]
        if gone > _REWRITE_SHARE * base_rows:
            base = cut_lineage(current)
            base_rows -= gone  # close enough to time the next rewrite
            current, out, gone = base, None, 0


def _without(rows: DataFrame, out: DataFrame) -> DataFrame:
    users = out.filter("is_user").select(F.col("id").alias("user_id"))
    items = out.filter("NOT is_user").select(F.col("id").alias("item_id"))
    return rows.join(users, "user_id", "left_anti").join(items, "item_id", "left_anti").select(
        *rows.columns
    )
