"""Id mappings as tables: ``(id, idx)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators.prefix import dense_ids


def build_mappings(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User and item mappings from the training rows."""
    return dense_ids(train, "user_id"), dense_ids(train, "item_id")


def reverse_ids(mapping: DataFrame) -> DataFrame:
    """The same pairs, looked up by index."""
    return mapping.select("idx", "id")


def map_ids(rows: DataFrame, mapping: DataFrame, key: str, out: str) -> DataFrame:
    """Add ``out``, the index of ``key``; unknown ids give null."""
    m = mapping.select(F.col("id").alias(key), F.col("idx").alias(out))
    return rows.join(m, key, "left")


def unmap_ids(rows: DataFrame, mapping: DataFrame, idx: str, out: str) -> DataFrame:
    """Add ``out``, the id behind the index ``idx``; unknown indices give null."""
    m = mapping.select(F.col("idx").alias(idx), F.col("id").alias(out))
    return rows.join(m, idx, "left")


def has_id(rows: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is mapped."""
    return rows.join(mapping.select(F.col("id").alias(key)), key, "left_semi")


def n_ids(mapping: DataFrame) -> DataFrame:
    """One row with the number of mapped ids."""
    return mapping.agg(F.count(F.lit(1)).alias("n"))


def all_ids(mapping: DataFrame) -> DataFrame:
    """All mapped ids."""
    return mapping.select("id")


def interaction_matrix(rows: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Long-form matrix ``(user_idx, item_idx, value)``.

    Repeated pairs add up; rows with an unmapped user or item are dropped. The pairs
    are summed before the two lookups, so a repeated pair reaches them once.
    """
    pairs = rows.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("value"))
    u = users.select(F.col("id").alias("user_id"), F.col("idx").alias("user_idx"))
    i = items.select(F.col("id").alias("item_id"), F.col("idx").alias("item_idx"))
    return pairs.join(u, "user_id").join(i, "item_id").select("user_idx", "item_idx", "value")
