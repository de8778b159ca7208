"""Replay of logged recommendations against what users interacted with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def user_history(interactions: DataFrame) -> DataFrame:
    """Distinct (user, item) pairs; the long form of a user-to-items map."""
    return interactions.select("user_id", "item_id").distinct()


def replay_request(
    log: DataFrame, interactions: DataFrame, window_seconds: int | None = None
) -> DataFrame:
    """Per request: ``n_recs, n_hits, precision, is_hit``.

    ``log`` is the output of ``scan_request_log`` (``recommendations`` as an array). A hit
    is a recommended item the user interacted with, each item once per request. With
    ``window_seconds`` only interactions after the request and within the window count.
    """
    shown = log.select(
        "request_id", "user_id", "timestamp", F.explode(F.array_distinct("recommendations")).alias("item_id")
    )
    if window_seconds is None:
        hits = shown.join(user_history(interactions), ["user_id", "item_id"], "left_semi")
    else:
        hits = _hits_within(shown, interactions, window_seconds)
    counts = hits.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_hits"))
    n_recs = F.size("recommendations")
    return (
        log.withColumn("n_recs", F.when(F.col("recommendations").isNull(), 0).otherwise(n_recs))
        .join(counts, "request_id", "left")
        .withColumn("n_hits", F.coalesce("n_hits", F.lit(0)))
        .select(
            "request_id", "user_id", "timestamp", "model_version", "n_recs", "n_hits",
            F.when(F.col("n_recs") > 0, F.col("n_hits") / F.col("n_recs")).otherwise(F.lit(0.0)).alias("precision"),
            (F.col("n_hits") > 0).alias("is_hit"),
        )
    )


def _hits_within(shown: DataFrame, interactions: DataFrame, seconds: int) -> DataFrame:
    """Recommended items with an interaction in ``(t, t + seconds]``.

    Time is cut into buckets as wide as the window: a matching interaction is either
    later in the request's bucket or early in the next one. Interactions reduce to one
    row per (user, item, bucket) before the join, so repeated pairs do not multiply.
    """
    ts = F.col("timestamp")
    bucket = F.floor(ts / seconds)
    spans = interactions.groupBy("user_id", "item_id", bucket.alias("_b")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last")
    )
    epoch = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(timestamp as timestamp_ntz))")
    asked = shown.withColumn("_t", epoch).withColumn("_b", F.floor(F.col("_t") / seconds))
    same = asked.join(spans, ["user_id", "item_id", "_b"]).filter(F.col("_last") > F.col("_t"))
    following = spans.withColumn("_b", F.col("_b") - 1)
    later = asked.join(following, ["user_id", "item_id", "_b"]).filter(F.col("_first") <= F.col("_t") + seconds)
    keys = ["request_id", "item_id"]
    return same.select(*keys).unionByName(later.select(*keys)).distinct()


def _summary(per_request: DataFrame, by: list[str]) -> DataFrame:
    sums = per_request.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count(F.when(F.col("is_hit"), 1)).alias("requests_with_hits"),
        F.coalesce(F.sum("n_recs"), F.lit(0)).alias("total_recommendations"),
        F.coalesce(F.sum("n_hits"), F.lit(0)).alias("total_hits"),
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("precision"),
        F.min("timestamp").alias("requests_start"),
        F.max("timestamp").alias("requests_end"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return sums.select(
        *by, ratio("requests_with_hits", "total_requests").alias("hit_rate"), "precision",
        ratio("total_hits", "total_recommendations").alias("ctr_proxy"),
        "total_requests", "requests_with_hits", "total_recommendations", "total_hits",
        "requests_start", "requests_end",
    )


def replay_eval(per_request: DataFrame) -> DataFrame:
    """One row over all requests; zeros when there are none."""
    return _summary(per_request, [])


def replay_by_version(per_request: DataFrame) -> DataFrame:
    """The same figures per model version; null and empty versions count as ``unknown``."""
    v = F.col("model_version")
    named = per_request.withColumn("model_version", F.when(v.isNull() | (v == ""), "unknown").otherwise(v))
    return _summary(named, ["model_version"])
