"""Readers of the rating and item text files (ML-100K layout)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.functions.text import GENRES, clean_title, extract_year, genre_array

RATING_SCHEMA = "user_id int, item_id int, rating tinyint, timestamp bigint"


def scan_ratings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tab-separated ratings without header."""
    return spark.read.schema(RATING_SCHEMA).option("sep", "\t").csv(path)


def _item_schema() -> T.StructType:
    text = ["title", "release_date", "video_release_date", "imdb_url"]
    fields = [T.StructField("item_id", T.IntegerType())]
    fields += [T.StructField(c, T.StringType()) for c in text]
    return T.StructType(fields + [T.StructField(g, T.IntegerType()) for g in GENRES])


def scan_items(spark: SparkSession, path: str, keep_all: bool = False) -> DataFrame:
    """Pipe-separated Latin-1 items: id, title, dates, URL and 19 genre flags.

    The video date and URL columns are dropped unless ``keep_all``.
    """
    items = (
        spark.read.schema(_item_schema()).option("sep", "|").option("encoding", "ISO-8859-1").csv(path)
    )
    return items if keep_all else items.drop("video_release_date", "imdb_url")


def item_features(raw: DataFrame, genres: list[str] = GENRES) -> DataFrame:
    """``(item_id, title, year, genres)`` from raw items with one flag column per genre."""
    flags = {g: F.col(f"`{g}`") for g in genres}
    return raw.select(
        "item_id", clean_title("title").alias("title"), extract_year("title").alias("year"),
        genre_array(flags).alias("genres"),
    )


def source_manifest(spark: SparkSession, folder: str, required: list[str]) -> DataFrame:
    """Required files with ``present``: found in the folder and not empty."""
    wanted = spark.createDataFrame([(r,) for r in required], "name string")
    found = (
        spark.read.format("binaryFile").load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")
        .filter(F.col("length") > 0)
        .select("name", F.lit(True).alias("_ok"))
    )
    return wanted.join(found, "name", "left").select("name", F.coalesce("_ok", F.lit(False)).alias("present"))
