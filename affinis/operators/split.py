"""Time splits, fold splits and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.operators.prefix import order_statistics, prefix_sums

TRAIN, VAL, TEST = "train", "val", "test"


def split_cutoffs(
    interactions: DataFrame,
    train_ratio: float = 0.70,
    val_ratio: float = 0.15,
    test_ratio: float = 0.15,
    ts: str = "timestamp",
) -> DataFrame:
    """One row ``(train_cutoff, val_cutoff)``: the timestamps at 0-based positions
    ``int(n * train)`` and ``int(n * (train + val))`` of the sorted rows."""
    if abs(train_ratio + val_ratio + test_ratio - 1.0) > 0.001:
        raise ValueError("split ratios must sum to 1")
    return order_statistics(
        interactions, ts, {"train_cutoff": train_ratio, "val_cutoff": train_ratio + val_ratio}
    )


def split_label(ts: Column, train_cutoff: Column, val_cutoff: Column) -> Column:
    """Split of a row; rows tied with a cutoff go to the later split."""
    return F.when(ts < train_cutoff, TRAIN).when(ts < val_cutoff, VAL).otherwise(TEST)


def time_split(
    interactions: DataFrame, train_ratio: float = 0.70, val_ratio: float = 0.15,
    test_ratio: float = 0.15, ts: str = "timestamp",
) -> DataFrame:
    """Add a ``split`` column by global time cutoffs shared by all users."""
    cutoffs = split_cutoffs(interactions, train_ratio, val_ratio, test_ratio, ts)
    return (
        interactions.join(F.broadcast(cutoffs))  # exactly one row
        .withColumn("split", split_label(F.col(ts), F.col("train_cutoff"), F.col("val_cutoff")))
        .drop("train_cutoff", "val_cutoff")
    )


def split_stats(split: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Per split: rows, share, time range, distinct users and items, and how many of
    them appear in no earlier split."""
    level = F.when(F.col("split") == TRAIN, 0).when(F.col("split") == VAL, 1).otherwise(2)
    rows = split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")
    )
    total = split.agg(F.count(F.lit(1)).alias("n")).scalar()

    def coverage(key: str, name: str) -> DataFrame:
        # one row per (id, split): bounded by three rows per id
        seen = split.select(key, "split", level.alias("_l")).distinct()
        first = seen.groupBy(key).agg(F.min("_l").alias("_first"))
        return seen.join(first, key).groupBy("split").agg(
            F.count(F.lit(1)).alias(f"n_{name}"),
            F.sum((F.col("_l") == F.col("_first")).cast("bigint")).alias(f"new_{name}"),
        )

    return (
        rows.withColumn("share", F.col("n") / total)
        .join(coverage("user_id", "users"), "split")
        .join(coverage("item_id", "items"), "split")
        .select(
            "split", "n", "share", "min_ts", "max_ts", "n_users", "new_users", "n_items", "new_items"
        )
    )


def fold_split(positioned: DataFrame, folds: int = 5, pos: str = "pos") -> DataFrame:
    """Add ``fold``: contiguous blocks by row position. Fold i is the test set of run i."""
    n = positioned.agg(F.count(F.lit(1)).alias("n")).scalar()
    block = F.greatest(F.ceil(n / F.lit(folds)), F.lit(1))
    return positioned.withColumn("fold", (F.floor(F.col(pos) / block) + 1).cast("int"))


def holdout_n_per_user(
    positioned: DataFrame, start: int, stop: int, max_test: int = 0, pos: str = "pos"
) -> DataFrame:
    """Add ``is_test``: each user's rows number ``start..stop`` in position order, until
    ``max_test`` rows are taken overall (0 or less: no cap).

    A user's first ``stop`` rows are found by a pruned top-k window; the overall cap uses
    bucketed running counts over position.
    """
    w = W.partitionBy("user_id").orderBy(pos)
    early = (
        positioned.select("user_id", pos)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= stop)
        .filter(F.col("_rn") >= start)
        .select(pos)
    )
    if max_test > 0:
        early = prefix_sums(early, pos).filter(F.col("cum") <= max_test).select(pos)
    flagged = early.withColumn("is_test", F.lit(True))
    return positioned.join(flagged, pos, "left").withColumn(
        "is_test", F.coalesce("is_test", F.lit(False))
    )
