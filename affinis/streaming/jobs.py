"""Streaming ingestion and figures of the request log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from affinis.operators.kpi import RECOMMEND
from affinis.sources.keyed_log import KeyedLog
from affinis.sources.request_log import LOG_SCHEMA


def read_log_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = LOG_SCHEMA) -> DataFrame:
    """Log rows arriving as files."""
    return spark.readStream.format(fmt).schema(schema).load(path)


def dedupe(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Each request id once within the watermark; state older than it is dropped."""
    return (
        stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        .withWatermark("timestamp", lateness)
        .dropDuplicatesWithinWatermark(["request_id"])
    )


def stream_log_ingest(
    stream: DataFrame, path: str, checkpoint: str, lateness: str = "1 hour", once: bool = False
) -> StreamingQuery:
    """Append de-duplicated rows to the log table, partitioned by date."""
    rows = dedupe(stream, lateness).withColumn("date", F.to_date("timestamp"))
    writer = (
        rows.writeStream.format("parquet").outputMode("append").partitionBy("date")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_keyed_ingest(stream: DataFrame, log: KeyedLog, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the rows of ids that the log does not hold, however long ago it got them.

    Each micro-batch is an append under the stream's id and the batch number, so a batch run
    again after a failure, or a restart from the checkpoint, adds nothing. Rows that the log
    held before the stream count as well, and a new checkpoint over the same input only repeats.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        log.on(spark).append(batch, f"{stream_id}/{number}")

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def window_kpis(log: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Figures per time window: requests, users (approximate), latency, fallback rate.

    The same plan runs on a batch log and on a stream with a watermark.
    """
    asked = F.col("endpoint") == RECOMMEND
    slot = F.window("timestamp", width, slide) if slide else F.window("timestamp", width)
    return (
        log.groupBy(slot.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.approx_count_distinct("user_id").alias("unique_users"),
            F.avg("latency_ms").alias("mean_ms"),
            F.percentile_approx("latency_ms", F.lit(0.95), F.lit(1000)).alias("p95_ms"),
            F.avg(F.when(asked, F.col("is_fallback").cast("int"))).alias("fallback_rate"),
        )
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "total_requests", "unique_users", "mean_ms", "p95_ms", "fallback_rate",
        )
    )


def stream_kpis(
    stream: DataFrame, path: str, checkpoint: str, width: str = "1 hour", slide: str | None = None,
    lateness: str = "1 hour", once: bool = False,
) -> StreamingQuery:
    """Write each closed window's figures to ``path``."""
    timed = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", lateness)
    writer = (
        window_kpis(timed, width, slide).writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
