"""The request log: shaping, appending and reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.functions.text import json_ids
from affinis.operators.filters import in_window
from affinis.operators.kpi import POPULAR, RECOMMEND, SIMILAR

LOG_SCHEMA = (
    "request_id string, timestamp timestamp, user_id bigint, item_id bigint, endpoint string, "
    "model_version string, recommendations string, scores string, latency_ms double, "
    "is_fallback boolean, fallback_reason string"
)
_COLUMNS = [c.split()[0] for c in LOG_SCHEMA.split(", ")]


def _row(df: DataFrame, **columns) -> DataFrame:
    filled = {
        "user_id": F.lit(None).cast("bigint"), "item_id": F.lit(None).cast("bigint"),
        "model_version": F.lit(None).cast("string"), "is_fallback": F.lit(False),
        "fallback_reason": F.lit(None).cast("string"),
        "recommendations": F.to_json("recommendations"), "scores": F.to_json("scores"),
    } | columns
    return df.select(*[filled.get(c, F.col(c)).alias(c) for c in _COLUMNS])


def log_recommend(results: DataFrame) -> DataFrame:
    """Log rows of recommend results (``recommendations`` and ``scores`` as arrays)."""
    return _row(
        results, endpoint=F.lit(RECOMMEND), user_id=F.col("user_id"), model_version=F.col("model_version"),
        is_fallback=F.col("is_fallback"), fallback_reason=F.col("fallback_reason"),
    )


def log_similar(results: DataFrame, legacy_user_id: bool = False) -> DataFrame:
    """Log rows of similar-item results. The seed goes to ``item_id``; with
    ``legacy_user_id`` it is also stored as the user id, as older logs do."""
    seed = F.col("item_id")
    return _row(
        results, endpoint=F.lit(SIMILAR), item_id=seed, model_version=F.col("model_version"),
        user_id=seed if legacy_user_id else F.lit(None).cast("bigint"),
    )


def log_popular(results: DataFrame) -> DataFrame:
    """Log rows of popular-item results; a genre filter is noted as the reason."""
    genre = F.col("genre")
    return _row(
        results, endpoint=F.lit(POPULAR),
        fallback_reason=F.when(genre.isNotNull() & (genre != ""), F.concat(F.lit("genre="), genre)),
    )


def new_rows(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` with a request id not logged yet, each id once.

    Of repeated ids in the batch the earliest row stays (ties: the smaller row), so a
    retried job keeps the same one. The aggregate combines before the shuffle.
    """
    rest = [c for c in batch.columns if c not in ("request_id", "timestamp")]
    first = F.min(F.struct("timestamp", *rest)).alias("_r")
    rows = batch.groupBy("request_id").agg(first).select("request_id", "_r.*").select(*batch.columns)
    if existing is not None:
        rows = rows.join(existing.select("request_id"), "request_id", "left_anti")
    return rows


def append_request_log(batch: DataFrame, path: str) -> None:
    """Append new rows to the log table, partitioned by date."""
    spark = batch.sparkSession
    try:
        existing = spark.read.parquet(path)
    except Exception as e:  # first write
        if "PATH_NOT_FOUND" not in str(e):
            raise
        existing = None
    rows = new_rows(batch, existing).withColumn("date", F.to_date("timestamp"))
    rows.write.mode("append").partitionBy("date").parquet(path)


def read_request_log(spark: SparkSession, path: str, days: int | None = None, today=None) -> DataFrame:
    """The log; with ``days`` only the partitions of the last days before ``today``."""
    log = spark.read.parquet(path)
    if days is None:
        return log
    day = F.current_date() if today is None else F.lit(today)
    return log.filter(F.col("date") > F.date_sub(day, days))


def scan_request_log(log: DataFrame, start=None, end=None, endpoint: str = RECOMMEND) -> DataFrame:
    """Requests of one endpoint with a user and recommendations, the lists parsed.

    Rows whose list does not parse are skipped. Callers order by timestamp for output.
    """
    keep = (
        (F.col("endpoint") == endpoint) & F.col("user_id").isNotNull()
        & F.col("recommendations").isNotNull() & in_window(F.col("timestamp"), start, end)
    )
    return log.filter(keep).select(
        "request_id", "user_id", json_ids("recommendations").alias("recommendations"),
        "model_version", "timestamp", "is_fallback",
    ).filter(F.col("recommendations").isNotNull())
