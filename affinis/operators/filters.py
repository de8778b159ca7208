"""Row filters, lookups and small per-row rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_implicit(ratings: DataFrame, threshold: int = 4) -> DataFrame:
    """Ratings at or above ``threshold`` as interactions; the rating itself is dropped."""
    return ratings.filter(F.col("rating") >= threshold).drop("rating")


def sort_by_time(interactions: DataFrame) -> DataFrame:
    """Interactions in time order, ties by user and item (for output only)."""
    return interactions.orderBy("timestamp", "user_id", "item_id")


def _moment(bound) -> Column:
    """A time bound; a datetime without zone is wall-clock time, whatever the session zone."""
    if isinstance(bound, datetime) and bound.tzinfo is None:
        return F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")
    return bound if isinstance(bound, Column) else F.lit(bound)


def in_window(ts: Column, start=None, end=None) -> Column:
    """``start <= ts < end``; a missing bound is open."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (ts >= _moment(start))
    if end is not None:
        keep = keep & (ts < _moment(end))
    return keep


def filter_genres_any(items: DataFrame, wanted: Column, genres: str = "genres") -> DataFrame:
    """Keep items sharing a genre with ``wanted``.

    An empty or null request keeps everything, and so does an item without features.
    """
    no_request = wanted.isNull() | (F.size(wanted) == 0)
    g = F.col(genres)
    return items.filter(no_request | g.isNull() | F.arrays_overlap(g, wanted))


def filter_genre_one(items: DataFrame, wanted: Column, genres: str = "genres") -> DataFrame:
    """Keep items of one genre; items without features are dropped. Null keeps everything."""
    return items.filter(
        wanted.isNull() | F.coalesce(F.array_contains(F.col(genres), wanted), F.lit(False))
    )


def filter_year(
    items: DataFrame, year_min: Column, year_max: Column, year: str = "year"
) -> DataFrame:
    """Inclusive year range; null bounds are open and unknown years are kept."""
    y = F.col(year)
    low = year_min.isNull() | y.isNull() | (y >= year_min)
    high = year_max.isNull() | y.isNull() | (y <= year_max)
    return items.filter(low & high)


def exclude_items(candidates: DataFrame, excluded: DataFrame, on: list[str]) -> DataFrame:
    """Drop candidates found in ``excluded`` (seen or banned items)."""
    return candidates.join(excluded.select(*on), on, "left_anti")


def restrict_items(candidates: DataFrame, allowed: DataFrame, on: list[str]) -> DataFrame:
    """Keep only candidates found in ``allowed``."""
    return candidates.join(allowed.select(*on), on, "left_semi")


def enrich(rows: DataFrame, features: DataFrame) -> DataFrame:
    """Attach title, genres and year; items without features get placeholders."""
    f = features.select(
        "item_id", F.col("title").alias("_t"), F.col("genres").alias("_g"), F.col("year").alias("_y")
    )
    return (
        rows.join(f, "item_id", "left")
        .withColumn("title", F.coalesce("_t", F.concat(F.lit("Movie "), F.col("item_id"))))
        .withColumn("genres", F.coalesce("_g", F.array().cast("array<string>")))
        .withColumn("year", F.col("_y"))
        .drop("_t", "_g", "_y")
    )


def item_info(ids: DataFrame, features: DataFrame) -> DataFrame:
    """Features of the given item ids; unknown ids return no row."""
    return features.join(ids.select("item_id").distinct(), "item_id", "left_semi")


def validate_requests(
    requests: DataFrame, k_range=(1, 100), year_range=(1900, 2030)
) -> DataFrame:
    """Add ``rejected``: the first rule a request breaks, or null when it is valid."""
    low, high = k_range
    first, last = year_range

    def year_off(c: str) -> Column:
        return ~F.col(c).between(first, last)

    return requests.withColumn(
        "rejected",
        F.when(F.col("user_id").isNull(), "user_id required")
        .when(~F.col("k").between(low, high), "k out of range")
        .when(year_off("year_min"), "year_min out of range")
        .when(year_off("year_max"), "year_max out of range"),
    )


def check_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Project ``columns``; the analyzer raises when one is missing."""
    return df.select(*columns)


def check_ids(requested: DataFrame, n: int | DataFrame, idx: str = "idx") -> DataFrame:
    """Requested indices with ``valid``: within 0..n-1 of a fitted model.

    ``n`` is a number or the model's id map, whose rows are counted in the same plan.
    """
    size = F.lit(n) if isinstance(n, int) else n.agg(F.count(F.lit(1))).scalar()
    ok = F.coalesce((F.col(idx) >= 0) & (F.col(idx) < size), F.lit(False))
    return requested.withColumn("valid", ok)
