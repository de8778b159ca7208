"""Traffic, latency and quality figures of a request log.

Every function works on the whole log, on one time window, or per group (``by``), so
many windows are one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions.text import json_ids
from affinis.operators.filters import in_window
from affinis.operators.prefix import quantiles

RECOMMEND, SIMILAR, POPULAR = "/recommend", "/similar", "/popular"


def _window(log: DataFrame, start, end) -> DataFrame:
    return log.filter(in_window(F.col("timestamp"), start, end))


def _join_groups(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Join two one-row-per-group results."""
    if not by:
        return left.join(F.broadcast(right))  # one row each
    r = right.select(*[F.col(c).alias(f"_{c}") for c in by], *[c for c in right.columns if c not in by])
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return left.join(r, on, "left").drop(*[f"_{c}" for c in by])


def kpi_traffic(
    log: DataFrame, minutes: float | Column | None = None, start=None, end=None, by: list[str] | None = None
) -> DataFrame:
    """Requests, distinct users (null users do not count) and requests per minute."""
    by = list(by or [])
    length = F.lit(minutes) if not isinstance(minutes, Column) else minutes
    if minutes is None and start is not None and end is not None:
        length = F.lit((end - start).total_seconds() / 60)
    out = _window(log, start, end).groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_requests"), F.countDistinct("user_id").alias("unique_users")
    )
    rate = F.when(length > 0, F.col("total_requests") / length).otherwise(F.lit(0.0))
    return out.withColumn("requests_per_minute", rate)


def kpi_endpoints(log: DataFrame, start=None, end=None, by: list[str] | None = None) -> DataFrame:
    """Requests and mean latency per endpoint."""
    return _window(log, start, end).groupBy(*(by or []), "endpoint").agg(
        F.count(F.lit(1)).alias("n_requests"), F.avg("latency_ms").alias("mean_ms")
    )


def kpi_latency(log: DataFrame, start=None, end=None, by: list[str] | None = None) -> DataFrame:
    """Mean, p50, p95, p99 (linear interpolation) and maximum; zeros when there are no rows."""
    by = list(by or [])
    rows = _window(log, start, end).filter(F.col("latency_ms").isNotNull())
    simple = rows.groupBy(*by).agg(F.avg("latency_ms").alias("mean_ms"), F.max("latency_ms").alias("max_ms"))
    points = quantiles(rows, "latency_ms", {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}, by)
    names = ["mean_ms", "p50_ms", "p95_ms", "p99_ms", "max_ms"]
    return _join_groups(simple, points, by).select(
        *by, *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names]
    )


def latency_sketch(log: DataFrame, by: list[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Approximate percentiles in one pass, for dashboards over very long windows."""
    cut = F.percentile_approx("latency_ms", [0.5, 0.95, 0.99], accuracy)
    return log.groupBy(*(by or [])).agg(cut.alias("_p")).select(
        *(by or []), *[F.col("_p")[i].alias(n) for i, n in enumerate(("p50_ms", "p95_ms", "p99_ms"))]
    )


def kpi_quality(
    log: DataFrame, catalog_size: int | Column | None = None, start=None, end=None, by: list[str] | None = None
) -> DataFrame:
    """Fallback count and rate on the recommend endpoint; distinct items, mean list length
    and catalog coverage over all endpoints. Lists that do not parse are skipped."""
    by = list(by or [])
    rows = _window(log, start, end)
    asked = F.col("endpoint") == RECOMMEND
    parsed = json_ids("recommendations")
    head = rows.groupBy(*by).agg(
        F.count(F.when(asked, 1)).alias("_asked"),
        F.count(F.when(asked & F.col("is_fallback"), 1)).alias("fallback_count"),
        F.avg(F.array_size(parsed)).alias("_mean"),
    )
    items = (
        rows.select(*by, F.explode(parsed).alias("item_id")).distinct()
        .groupBy(*by).agg(F.count("item_id").alias("_items"))
    )
    size = F.lit(catalog_size) if not isinstance(catalog_size, Column) else catalog_size
    distinct = F.coalesce("_items", F.lit(0))
    size = F.coalesce(size.cast("bigint"), distinct)
    return _join_groups(head, items, by).select(
        *by,
        F.when(F.col("_asked") > 0, F.col("fallback_count") / F.col("_asked")).otherwise(F.lit(0.0)).alias("fallback_rate"),
        "fallback_count",
        F.when(size > 0, distinct / size).otherwise(F.lit(0.0)).alias("catalog_coverage"),
        distinct.alias("unique_items_recommended"),
        size.alias("total_catalog_size"),
        F.coalesce("_mean", F.lit(0.0)).alias("avg_recommendations_per_request"),
    )


def kpi_report(log: DataFrame, end, hours: float = 24.0, catalog_size: int | None = None) -> DataFrame:
    """One row for the last ``hours`` before ``end``: the three groups as structs, rounded
    as reports show them (2 digits, ratios 4), with per-endpoint maps."""
    from datetime import timedelta

    start = end - timedelta(hours=hours)
    rows = _window(log, start, end)

    def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
        return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])

    traffic = rounded(kpi_traffic(rows, minutes=hours * 60), {"requests_per_minute": 2})
    latency = rounded(kpi_latency(rows), dict.fromkeys(["mean_ms", "p50_ms", "p95_ms", "p99_ms", "max_ms"], 2))
    quality = rounded(
        kpi_quality(rows, catalog_size),
        {"fallback_rate": 4, "catalog_coverage": 4, "avg_recommendations_per_request": 2},
    )
    # the API has three endpoints
    maps = kpi_endpoints(rows).groupBy().agg(
        F.map_from_entries(F.collect_list(F.struct("endpoint", "n_requests"))).alias("requests_by_endpoint"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("mean_ms").isNotNull(), F.struct("endpoint", F.round("mean_ms", 2).alias("ms"))))
        ).alias("latency_by_endpoint"),
    )

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.struct(*df.columns).alias(name))

    out = packed(traffic, "traffic").join(F.broadcast(packed(latency, "latency")))
    out = out.join(F.broadcast(packed(quality, "quality"))).join(F.broadcast(maps))
    return out.select(
        F.lit(start).alias("start_time"), F.lit(end).alias("end_time"), F.lit(float(hours)).alias("duration_hours"),
        F.struct("traffic.*", "requests_by_endpoint").alias("traffic"),
        F.struct("latency.*", "latency_by_endpoint").alias("latency"),
        "quality",
    )


def kpi_status(latency: DataFrame, quality: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Dashboard marks: p95 under 100 ms, fallback under 10 %, coverage over 50 %; null
    where there is nothing to judge."""
    by = list(by or [])
    both = _join_groups(latency, quality, by)

    def mark(has_data: Column, good: Column, yes: str, no: str) -> Column:
        return F.when(has_data, F.when(good, yes).otherwise(no))

    return both.select(
        *by,
        mark(F.col("p95_ms") > 0, F.col("p95_ms") < 100, "OK", "High").alias("latency_status"),
        mark(F.col("fallback_count") > 0, F.col("fallback_rate") * 100 < 10, "OK", "High").alias("fallback_status"),
        mark(
            F.col("unique_items_recommended") > 0, F.col("catalog_coverage") * 100 > 50, "Good", "Low"
        ).alias("coverage_status"),
    )


def request_count(log: DataFrame, since=None, endpoint: str | None = None) -> DataFrame:
    """One row with the number of requests."""
    rows = _window(log, since, None)
    if endpoint is not None:
        rows = rows.filter(F.col("endpoint") == endpoint)
    return rows.agg(F.count(F.lit(1)).alias("n_requests"))


def average_latency(log: DataFrame, since=None, endpoint: str | None = None) -> DataFrame:
    """One row with the mean latency, null when there are no requests."""
    rows = _window(log, since, None)
    if endpoint is not None:
        rows = rows.filter(F.col("endpoint") == endpoint)
    return rows.agg(F.avg("latency_ms").alias("mean_ms"))


def fallback_rate(log: DataFrame, since=None) -> DataFrame:
    """One row with the fallback share of the recommend endpoint, null without requests."""
    rows = _window(log, since, None).filter(F.col("endpoint") == RECOMMEND)
    return rows.agg(F.avg(F.col("is_fallback").cast("int")).alias("fallback_rate"))


def recent_requests(log: DataFrame, limit: int = 100, endpoint: str | None = None) -> DataFrame:
    """The latest requests, newest first."""
    rows = log if endpoint is None else log.filter(F.col("endpoint") == endpoint)
    return rows.orderBy(F.desc("timestamp"), F.desc("request_id")).limit(limit)


def unseen_in_training(log: DataFrame, items: DataFrame) -> DataFrame:
    """Recommended items that training never saw: ``(item_id, n_requests)``."""
    shown = log.select(F.explode(json_ids("recommendations")).alias("item_id"))
    counts = shown.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_requests"))
    return counts.join(items.select("item_id"), "item_id", "left_anti")
