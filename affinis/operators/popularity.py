"""Item popularity and catalog statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.operators.prefix import quantiles


def popularity(train: DataFrame) -> DataFrame:
    """Per item: count, rank (ties share the smallest) and percentile (ties averaged).

    Ranks are computed on the histogram of counts. With R rows there are fewer than
    sqrt(2 R) different counts, so the one ordered pass over them stays small, and the
    result joins back by count.
    """
    counts = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("interaction_count"))
    histogram = counts.groupBy("interaction_count").agg(F.count(F.lit(1)).alias("_ties"))
    up = W.partitionBy(F.lit(0)).orderBy("interaction_count").rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy(F.lit(0))
    ranks = (
        histogram.withColumn("_upto", F.sum("_ties").over(up))
        .withColumn("_n", F.sum("_ties").over(everything))
        .select(
            "interaction_count",
            (F.col("_n") - F.col("_upto") + 1).cast("int").alias("popularity_rank"),
            F.bround(
                (F.col("_upto") - (F.col("_ties") - 1) / 2) / F.col("_n") * 100, 1
            ).alias("popularity_percentile"),
        )
    )
    return counts.join(ranks, "interaction_count").select(
        "item_id", "interaction_count", "popularity_rank", "popularity_percentile"
    )


def popularity_stats(pop: DataFrame) -> DataFrame:
    """One row: smallest, median and largest count."""
    ends = pop.agg(
        F.min("interaction_count").alias("min_count"), F.max("interaction_count").alias("max_count")
    )
    median = quantiles(pop, "interaction_count", {"median_count": 0.5})
    return ends.join(F.broadcast(median)).select("min_count", "median_count", "max_count")


def most_popular(pop: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best-ranked items."""
    return pop.orderBy("popularity_rank", "item_id").limit(n)


def genre_counts(items: DataFrame, n: int | None = 5) -> DataFrame:
    """Items per genre, most frequent first."""
    counts = (
        items.select(F.explode("genres").alias("genre"))
        .groupBy("genre")
        .agg(F.count(F.lit(1)).alias("n_items"))
    )
    ordered = counts.orderBy(F.desc("n_items"), "genre")
    return ordered if n is None else ordered.limit(n)


def titles_with_year(items: DataFrame) -> DataFrame:
    """One row: items in all and items with a known year."""
    return items.agg(F.count(F.lit(1)).alias("n_items"), F.count("year").alias("n_with_year"))


def density(interactions: DataFrame) -> DataFrame:
    """One row: rows, users, items and filled share of the matrix in percent."""
    sizes = interactions.agg(
        F.count(F.lit(1)).alias("n_interactions"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("item_id").alias("n_items"),
    )
    cells = (F.col("n_users") * F.col("n_items")).cast("double")
    return sizes.withColumn(
        "density_pct", F.try_divide(F.col("n_interactions") * 100.0, cells)
    )


def edge_density(edges: DataFrame, n_items: DataFrame) -> DataFrame:
    """One row: neighbour edges kept and their share of all item pairs in percent.

    ``n_items`` is a one-row table with column ``n``.
    """
    nnz = edges.agg(F.count(F.lit(1)).alias("n_edges"))
    return nnz.join(F.broadcast(n_items)).select(
        "n_edges",
        F.try_divide(F.col("n_edges") * 100.0, (F.col("n") * F.col("n")).cast("double")).alias("density_pct"),
    )
