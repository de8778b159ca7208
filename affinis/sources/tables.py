"""Tables between stages and id-mapping files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``. ``fmt`` may be ``csv`` (with header) for exchange."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """Read a table; a missing path raises the analyzer's path error."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            raise ValueError("CSV tables need a schema")
    return (reader.schema(schema) if schema else reader).load(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a table written with ``partition_by=['split']`` (partition pruning)."""
    return spark.read.parquet(path).filter(F.col("split") == split)


def write_mapping(mapping: DataFrame, path: str) -> None:
    """Write ``(id, idx)`` as JSON lines with string ids: ``{"id": "196", "idx": 0}``."""
    mapping.select(F.col("id").cast("string").alias("id"), "idx").write.mode("overwrite").json(path)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Read a mapping file: one JSON object ``{"196": 0, ...}`` or JSON lines.

    The text is cut at commas rather than read as one value, so a large mapping is read
    in parallel.
    """
    pieces = spark.read.option("lineSep", ",").text(path)
    plain = pieces.select(
        F.regexp_extract("value", r'"(-?\d+)"\s*:\s*(-?\d+)', 1).alias("i"),
        F.regexp_extract("value", r'"(-?\d+)"\s*:\s*(-?\d+)', 2).alias("x"),
    )
    return plain.filter("i <> ''").select(
        F.col("i").cast("bigint").alias("id"), F.col("x").cast("bigint").alias("idx")
    )


def read_mapping_lines(spark: SparkSession, path: str) -> DataFrame:
    """Read what ``write_mapping`` wrote."""
    return spark.read.schema("id string, idx bigint").json(path).select(F.col("id").cast("bigint"), "idx")
