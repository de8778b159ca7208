"""Request log, KPI, replay, selection and promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions import text as fx
from affinis.operators import filters, kpi, promotion, replay
from affinis.plans import testdata as td
from affinis.plans.catalog import sql as q
from affinis.plans.catalog.registry import prepared, query
from affinis.sources import request_log as rl

_LOG = q.with_(q.LOG)
_DAY = "CAST(timestamp AS DATE)"


def _dated(spark, sf):
    return td.request_log(spark, sf).withColumn("day", F.to_date("timestamp"))


def _window(spark, sf):
    """The middle half of the logged time range."""
    from datetime import timedelta

    first, last = td.request_log(spark, sf).agg(F.min("timestamp"), F.max("timestamp")).first()
    quarter = timedelta(seconds=int((last - first).total_seconds()) // 4)
    return first + quarter, last - quarter


_WINDOW = """bounds AS (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM request_log),
win AS (SELECT lo + to_seconds(CAST(floor(epoch(hi - lo)) AS BIGINT) // 4) AS s, hi - to_seconds(CAST(floor(epoch(hi - lo)) AS BIGINT) // 4) AS e FROM bounds),
windowed AS (SELECT parsed_log.* FROM parsed_log, win WHERE timestamp >= s AND timestamp < e)"""
_IN_WINDOW = q.with_(q.LOG, _WINDOW)

# --- log ------------------------------------------------------------------------------


@query(
    "scan_request_log",
    _IN_WINDOW + """SELECT request_id, user_id, array_to_string(ids, ',') AS recommendations, model_version, timestamp, is_fallback
    FROM windowed WHERE endpoint = '/recommend' AND user_id IS NOT NULL AND ids IS NOT NULL ORDER BY timestamp""",
)
def scan_request_log(spark, sf):
    start, end = _window(spark, sf)
    rows = rl.scan_request_log(td.request_log(spark, sf), start, end)
    return rows.withColumn("recommendations", F.concat_ws(",", "recommendations")).orderBy("timestamp")


@query("time_window_filter", _IN_WINDOW + "SELECT request_id, timestamp FROM windowed")
def time_window_filter(spark, sf):
    start, end = _window(spark, sf)
    log = td.request_log(spark, sf)
    return log.filter(filters.in_window(F.col("timestamp"), start, end)).select("request_id", "timestamp")


@query("json_ids", _LOG + "SELECT request_id, unnest(ids) AS item_id FROM parsed_log")
def json_ids(spark, sf):
    log = td.request_log(spark, sf)
    return log.select("request_id", F.explode(fx.json_ids("recommendations")).alias("item_id"))


_SHAPED = """SELECT {id} AS request_id, ts AS timestamp, {user} AS user_id, {item} AS item_id, {endpoint} AS endpoint,
  {version} AS model_version, '[' || k || ',' || (k + 1) || ']' AS recommendations, '[1.0,0.5]' AS scores, value AS latency_ms,
  {fallback} AS is_fallback, {reason} AS fallback_reason FROM base_log WHERE event_type {kind}"""
_ID = "CAST(event_id AS VARCHAR)"
_LOGGED = {
    "log_recommend": _SHAPED.format(
        id=_ID, user="user_id", item="CAST(NULL AS BIGINT)", endpoint="'/recommend'", version="'v1'",
        fallback="event_id % 7 = 0", reason="CASE WHEN event_id % 7 = 0 THEN 'popularity' END",
        kind="NOT IN ('click', 'purchase')",
    ),
    "log_similar": _SHAPED.format(
        id=_ID, user="k", item="k", endpoint="'/similar'", version="'v1'", fallback="false",
        reason="CAST(NULL AS VARCHAR)", kind="= 'click'",
    ),
    "log_popular": _SHAPED.format(
        id=_ID, user="CAST(NULL AS BIGINT)", item="CAST(NULL AS BIGINT)", endpoint="'/popular'",
        version="CAST(NULL AS VARCHAR)", fallback="false",
        reason="CASE WHEN k % 2 = 0 THEN 'genre=' || event_type END", kind="= 'purchase'",
    ),
}


def _results(spark, sf):
    """The events table as results of the three endpoints."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    ident = F.col("event_id")
    return td.table(spark, sf, "events").select(
        ident.cast("string").alias("request_id"), F.col("ts").alias("timestamp"), "user_id",
        k.alias("item_id"), "event_type", F.lit("v1").alias("model_version"),
        F.array(k, k + 1).alias("recommendations"), F.array(F.lit(1.0), F.lit(0.5)).alias("scores"),
        F.col("value").alias("latency_ms"), (ident % 7 == 0).alias("is_fallback"),
        F.when(ident % 7 == 0, "popularity").alias("fallback_reason"),
        F.when(k % 2 == 0, F.col("event_type")).alias("genre"),
    )


def _logged(spark, sf):
    r = _results(spark, sf)
    kind = F.col("event_type")
    return {
        "log_recommend": rl.log_recommend(r.filter(~kind.isin("click", "purchase"))),
        "log_similar": rl.log_similar(r.filter(kind == "click"), legacy_user_id=True),
        "log_popular": rl.log_popular(r.filter(kind == "purchase")),
    }


@query("log_recommend", _LOG + _LOGGED["log_recommend"])
def log_recommend(spark, sf):
    return _logged(spark, sf)["log_recommend"]


@query("log_similar", _LOG + _LOGGED["log_similar"])
def log_similar(spark, sf):
    return _logged(spark, sf)["log_similar"]


@query("log_popular", _LOG + _LOGGED["log_popular"])
def log_popular(spark, sf):
    return _logged(spark, sf)["log_popular"]


@query(
    "append_request_log",
    q.with_(q.LOG, "shaped AS (" + " UNION ALL ".join(_LOGGED.values()) + ")")
    + "SELECT endpoint, CAST(timestamp AS DATE) AS date, count(*) AS n, sum(latency_ms) AS latency FROM shaped GROUP BY 1, 2",
)
def append_request_log(spark, sf):
    """Append all three result kinds, one of them twice, and read the table back."""
    import uuid

    from affinis.session import checkpoint_dir

    path = f"{checkpoint_dir(spark)}/request_log_{uuid.uuid4().hex}"
    parts = _logged(spark, sf)
    rl.append_request_log(parts["log_recommend"].unionByName(parts["log_similar"]), path)
    rl.append_request_log(parts["log_similar"].unionByName(parts["log_popular"]), path)
    log = rl.read_request_log(spark, path)
    return log.groupBy("endpoint", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("latency_ms").alias("latency"))


@query(
    "keyed_log_append",
    q.with_(q.LOG, "shaped AS (" + " UNION ALL ".join(_LOGGED.values()) + ")")
    + "SELECT endpoint, CAST(timestamp AS DATE) AS date, count(*) AS n, sum(latency_ms) AS latency FROM shaped GROUP BY 1, 2",
)
def keyed_log_append(spark, sf):
    """Appends that share rows, and one appended twice, through the index of ids."""
    import uuid

    from affinis.session import checkpoint_dir
    from affinis.sources.keyed_log import KeyedLog

    log = KeyedLog(spark, f"{checkpoint_dir(spark)}/keyed_log_{uuid.uuid4().hex}")
    parts = _logged(spark, sf)
    log.append(parts["log_recommend"].unionByName(parts["log_similar"]), "first")
    log.append(parts["log_similar"].unionByName(parts["log_popular"]), "second")
    log.append(parts["log_popular"], "second")
    return log.rows().groupBy("endpoint", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("latency_ms").alias("latency"))


@query("recent_requests", _LOG + "SELECT request_id, timestamp, endpoint FROM request_log ORDER BY timestamp DESC, request_id DESC LIMIT 100")
def recent_requests(spark, sf):
    return kpi.recent_requests(td.request_log(spark, sf)).select("request_id", "timestamp", "endpoint")


@query("request_id")
def request_id(spark, sf):
    return td.request_log(spark, sf).select("timestamp", fx.request_id().alias("request_id"))


@query("request_id_format", "SELECT count(*) AS n, count(*) AS n_distinct, true AS well_formed FROM events")
def request_id_format(spark, sf):
    """New ids differ from row to row and have the usual form."""
    ids = td.request_log(spark, sf).select(fx.request_id().alias("id"))
    form = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return ids.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_distinct"), F.min(F.col("id").rlike(form)).alias("well_formed")
    )


# --- KPI ------------------------------------------------------------------------------


@query(
    "kpi_traffic",
    _LOG + f"""SELECT {_DAY} AS day, count(*) AS total_requests, count(DISTINCT user_id) AS unique_users,
    count(*) / CAST(1440 AS DOUBLE) AS requests_per_minute FROM request_log GROUP BY 1""",
)
def kpi_traffic(spark, sf):
    return kpi.kpi_traffic(_dated(spark, sf), minutes=24 * 60, by=["day"])


@query(
    "kpi_traffic_total",
    _LOG + "SELECT count(*) AS total_requests, count(DISTINCT user_id) AS unique_users, count(*) / CAST(43200 AS DOUBLE) AS requests_per_minute FROM request_log",
)
def kpi_traffic_total(spark, sf):
    return kpi.kpi_traffic(td.request_log(spark, sf), minutes=30 * 24 * 60)


@query(
    "kpi_endpoints",
    _LOG + "SELECT endpoint, count(*) AS n_requests, avg(latency_ms) AS mean_ms FROM request_log GROUP BY 1",
)
def kpi_endpoints(spark, sf):
    return kpi.kpi_endpoints(td.request_log(spark, sf))


_LATENCY = """avg(latency_ms) AS mean_ms, quantile_cont(latency_ms, 0.5) AS p50_ms, quantile_cont(latency_ms, 0.95) AS p95_ms,
    quantile_cont(latency_ms, 0.99) AS p99_ms, max(latency_ms) AS max_ms"""


@query("kpi_latency", _LOG + f"SELECT {_LATENCY} FROM request_log")
def kpi_latency(spark, sf):
    return kpi.kpi_latency(td.request_log(spark, sf))


@query("kpi_latency_daily", _LOG + f"SELECT {_DAY} AS day, endpoint, {_LATENCY} FROM request_log GROUP BY 1, 2")
def kpi_latency_daily(spark, sf):
    return kpi.kpi_latency(_dated(spark, sf), by=["day", "endpoint"])


_QUALITY = """heads AS (
  SELECT {by} count(*) FILTER (endpoint = '/recommend') AS asked,
         count(*) FILTER (endpoint = '/recommend' AND is_fallback) AS fallback_count, avg(len(ids)) AS mean
  FROM {src} {group}),
shown AS (SELECT {by} count(DISTINCT item) AS items FROM (SELECT *, unnest(ids) AS item FROM {src}) {group})
SELECT {by} CASE WHEN asked > 0 THEN fallback_count / CAST(asked AS DOUBLE) ELSE 0 END AS fallback_rate, fallback_count,
       coalesce(items, 0) / CAST((SELECT count(*) FROM part) AS DOUBLE) AS catalog_coverage, coalesce(items, 0) AS unique_items_recommended,
       (SELECT count(*) FROM part) AS total_catalog_size, coalesce(mean, 0) AS avg_recommendations_per_request
FROM heads LEFT JOIN shown {on}"""
_DAILY_LOG = "daily AS (SELECT *, CAST(timestamp AS DATE) AS day FROM parsed_log)"


def _catalog_size(spark, sf):
    return td.table(spark, sf, "part").agg(F.count(F.lit(1))).scalar()


@query("kpi_quality", q.with_(q.LOG, _QUALITY.format(by="", src="parsed_log", group="", on="ON true")))
def kpi_quality(spark, sf):
    return kpi.kpi_quality(td.request_log(spark, sf), _catalog_size(spark, sf))


@query(
    "kpi_quality_daily",
    q.with_(q.LOG, _DAILY_LOG, _QUALITY.format(by="day,", src="daily", group="GROUP BY day", on="USING (day)")),
)
def kpi_quality_daily(spark, sf):
    return kpi.kpi_quality(_dated(spark, sf), _catalog_size(spark, sf), by=["day"])


@query(
    "kpi_status",
    _LOG + """, l AS (SELECT CAST(timestamp AS DATE) AS day, quantile_cont(latency_ms, 0.95) AS p95,
      count(*) FILTER (endpoint = '/recommend' AND is_fallback) AS fc, count(*) FILTER (endpoint = '/recommend') AS asked FROM parsed_log GROUP BY 1),
    i AS (SELECT CAST(timestamp AS DATE) AS day, count(DISTINCT item) AS n FROM (SELECT timestamp, unnest(ids) AS item FROM parsed_log) GROUP BY 1)
    SELECT day, CASE WHEN p95 > 0 THEN CASE WHEN p95 < 100 THEN 'OK' ELSE 'High' END END AS latency_status,
      CASE WHEN fc > 0 THEN CASE WHEN fc * CAST(100 AS DOUBLE) / asked < 10 THEN 'OK' ELSE 'High' END END AS fallback_status,
      CASE WHEN n > 0 THEN CASE WHEN n * CAST(100 AS DOUBLE) / (SELECT count(*) FROM part) > 50 THEN 'Good' ELSE 'Low' END END AS coverage_status
    FROM l LEFT JOIN i USING (day)""",
)
def kpi_status(spark, sf):
    log = _dated(spark, sf)
    return kpi.kpi_status(
        kpi.kpi_latency(log, by=["day"]), kpi.kpi_quality(log, _catalog_size(spark, sf), by=["day"]), ["day"]
    )


@query("kpi_report")
def kpi_report(spark, sf):
    """The report of the last 24 hours as JSON (its parts have SQL counterparts above)."""
    from datetime import timedelta

    from affinis.sources.reports import report_json

    log = td.request_log(spark, sf)
    end = log.agg(F.max("timestamp")).first()[0] + timedelta(seconds=1)
    return report_json(kpi.kpi_report(log, end, 24.0))


@query("request_count", _LOG + "SELECT count(*) AS n_requests FROM request_log WHERE endpoint = '/recommend'")
def request_count(spark, sf):
    return kpi.request_count(td.request_log(spark, sf), endpoint="/recommend")


@query("average_latency", _LOG + "SELECT avg(latency_ms) AS mean_ms FROM request_log WHERE endpoint = '/similar'")
def average_latency(spark, sf):
    return kpi.average_latency(td.request_log(spark, sf), endpoint="/similar")


@query("fallback_rate", _LOG + "SELECT avg(CAST(is_fallback AS INTEGER)) AS fallback_rate FROM request_log WHERE endpoint = '/recommend'")
def fallback_rate(spark, sf):
    return kpi.fallback_rate(td.request_log(spark, sf))


@query(
    "fallback_kind",
    _LOG + """SELECT request_id, CASE WHEN fallback_reason = 'popularity' THEN 'popularity'
      WHEN fallback_reason LIKE 'popularity:genre=%' THEN 'genre' WHEN fallback_reason LIKE 'similar_to_seed:%' THEN 'seed' END AS kind,
      CASE WHEN fallback_reason LIKE 'popularity:genre=%' THEN split_part(fallback_reason, '=', 2)
           WHEN fallback_reason LIKE 'similar_to_seed:%' THEN split_part(fallback_reason, ':', 2) END AS argument FROM request_log""",
)
def fallback_kind(spark, sf):
    return td.request_log(spark, sf).select(
        "request_id", fx.fallback_kind("fallback_reason").alias("kind"),
        fx.fallback_argument("fallback_reason").alias("argument"),
    )


@query(
    "unseen_in_training",
    q.with_(q.RATINGS, q.kcore(), q.CUTOFFS, q.SPLIT, q.IDS, q.LOG, "shown AS (SELECT unnest(ids) AS item_id FROM parsed_log)")
    + "SELECT item_id, count(*) AS n_requests FROM shown WHERE item_id NOT IN (SELECT id FROM item_map) GROUP BY 1",
)
def unseen_in_training(spark, sf):
    trained = prepared(spark, sf).items.withColumnRenamed("id", "item_id")
    return kpi.unseen_in_training(td.request_log(spark, sf), trained)


@query(
    "version_string",
    _LOG + "SELECT request_id, strftime(timestamp, 'v%Y%m%d_%H%M%S') AS version FROM request_log",
)
def version_string(spark, sf):
    return td.request_log(spark, sf).select("request_id", fx.version_string("timestamp").alias("version"))


@query(
    "validate_requests",
    q.with_(q.REQUESTS) + """SELECT request_id, CASE WHEN uid IS NULL THEN 'user_id required' WHEN k NOT BETWEEN 1 AND 100 THEN 'k out of range'
      WHEN year_min NOT BETWEEN 1900 AND 2030 THEN 'year_min out of range' WHEN year_max NOT BETWEEN 1900 AND 2030 THEN 'year_max out of range' END AS rejected
    FROM (SELECT request_id, CASE WHEN item_id % 9 <> 0 THEN user_id END AS uid, CAST(k * 8 - 8 AS INTEGER) AS k,
          year_min - item_id AS year_min, year_max + item_id AS year_max FROM requests)""",
)
def validate_requests(spark, sf):
    r = td.requests(spark, sf)
    odd = r.select(
        "request_id", F.when(F.col("item_id") % 9 != 0, F.col("user_id")).alias("user_id"),
        (F.col("k") * 8 - 8).cast("int").alias("k"), (F.col("year_min") - F.col("item_id")).alias("year_min"),
        (F.col("year_max") + F.col("item_id")).alias("year_max"),
    )
    return filters.validate_requests(odd).select("request_id", "rejected")


# --- replay ---------------------------------------------------------------------------

_REPLAYED = """logs AS (SELECT request_id, user_id, ids, model_version, timestamp FROM parsed_log
  WHERE endpoint = '/recommend' AND user_id IS NOT NULL AND ids IS NOT NULL),
liked AS (SELECT DISTINCT user_id, item_id FROM ratings WHERE rating >= 4),
shown AS (SELECT DISTINCT request_id, user_id, timestamp, unnest(ids) AS item_id FROM logs)"""
_PER_REQUEST = """per_request AS (SELECT request_id, user_id, timestamp, model_version, len(ids) AS n_recs, coalesce(n, 0) AS n_hits,
    CASE WHEN len(ids) > 0 THEN coalesce(n, 0) / CAST(len(ids) AS DOUBLE) ELSE 0 END AS precision, coalesce(n, 0) > 0 AS is_hit
  FROM logs LEFT JOIN hits USING (request_id))"""
_HITS = "hits AS (SELECT request_id, count(*) AS n FROM shown SEMI JOIN liked USING (user_id, item_id) GROUP BY 1)"
_REPLAY = q.with_(q.RATINGS, q.LOG, _REPLAYED, _HITS, _PER_REQUEST)


def _replayed(spark, sf, window=None):
    logs = rl.scan_request_log(td.request_log(spark, sf))
    liked = filters.to_implicit(td.ratings(spark, sf)).select("user_id", "item_id", "timestamp")
    return replay.replay_request(logs, liked, window)


@query("user_history", q.with_(q.RATINGS) + "SELECT DISTINCT user_id, item_id FROM ratings")
def user_history(spark, sf):
    return replay.user_history(td.ratings(spark, sf))


@query("replay_request", _REPLAY + "SELECT * FROM per_request")
def replay_request(spark, sf):
    return _replayed(spark, sf)


_SUMMARY = """count(*) FILTER (is_hit) / CAST(count(*) AS DOUBLE) AS hit_rate, avg(precision) AS precision,
    sum(n_hits) / CAST(sum(n_recs) AS DOUBLE) AS ctr_proxy, count(*) AS total_requests, count(*) FILTER (is_hit) AS requests_with_hits,
    CAST(sum(n_recs) AS BIGINT) AS total_recommendations, CAST(sum(n_hits) AS BIGINT) AS total_hits,
    min(timestamp) AS requests_start, max(timestamp) AS requests_end"""


@query("replay_eval", _REPLAY + f"SELECT {_SUMMARY} FROM per_request")
def replay_eval(spark, sf):
    return replay.replay_eval(_replayed(spark, sf))


@query(
    "replay_by_version",
    _REPLAY + f"SELECT coalesce(nullif(model_version, ''), 'unknown') AS model_version, {_SUMMARY} FROM per_request GROUP BY 1",
)
def replay_by_version(spark, sf):
    return replay.replay_by_version(_replayed(spark, sf))


# The log starts years after most shipments, so the request clock is set back and the
# window is long: 20 years earlier and five years wide.
_BACK, _WIDE = 20 * 365 * 86400, 5 * 365 * 86400
_HITS_WITHIN = f"""hits AS (SELECT request_id, count(*) AS n FROM (
    SELECT DISTINCT s.request_id, s.item_id FROM shown s JOIN ratings r ON r.user_id = s.user_id AND r.item_id = s.item_id AND r.rating >= 4
      AND r.timestamp > CAST(floor(epoch(s.timestamp)) AS BIGINT) - {_BACK} AND r.timestamp <= CAST(floor(epoch(s.timestamp)) AS BIGINT) - {_BACK} + {_WIDE}) GROUP BY 1)"""


@query(
    "replay_within_window",
    q.with_(q.RATINGS, q.LOG, _REPLAYED, _HITS_WITHIN, _PER_REQUEST) + "SELECT request_id, n_recs, n_hits, precision, is_hit FROM per_request",
)
def replay_within_window(spark, sf):
    logs = rl.scan_request_log(td.request_log(spark, sf)).withColumn(
        "timestamp", F.timestamp_add("SECOND", F.lit(-_BACK), F.date_trunc("second", "timestamp"))
    )
    liked = filters.to_implicit(td.ratings(spark, sf)).select("user_id", "item_id", "timestamp")
    return replay.replay_request(logs, liked, _WIDE).select("request_id", "n_recs", "n_hits", "precision", "is_hit")


# --- selection and promotion ----------------------------------------------------------
# Every (day, version) of the log is read as one tracked run; its figures are the metrics.

_RUNS = """runs AS (SELECT strftime(timestamp, '%Y%m%d') || '-' || coalesce(model_version, 'none') AS run_id,
    avg(len(ids)) AS length, 1 - avg(CAST(is_fallback AS INTEGER)) AS ndcg, max(latency_ms) AS worst, count(*) AS n
  FROM parsed_log GROUP BY 1)"""


def _runs(spark, sf):
    log = td.request_log(spark, sf)
    run_id = F.concat(F.date_format("timestamp", "yyyyMMdd"), F.lit("-"), F.coalesce("model_version", F.lit("none")))
    return log.groupBy(run_id.alias("run_id")).agg(
        F.avg(F.array_size(fx.json_ids("recommendations"))).alias("length"),
        (1 - F.avg(F.col("is_fallback").cast("int"))).alias("ndcg"),
        F.max("latency_ms").alias("worst"), F.count(F.lit(1)).alias("n"),
    )


def _run_table(spark, sf):
    return _runs(spark, sf).select(
        "run_id", F.col("run_id").alias("run_name"),
        F.map_filter(
            F.create_map(F.lit("length"), "length", F.lit("ndcg_at_10"), F.when(F.col("n") % 2 == 0, F.col("ndcg"))),
            lambda k, v: v.isNotNull(),
        ).alias("metrics"),
        F.create_map(F.lit("n"), F.col("n").cast("string")).alias("params"),
    )


@query("best_run", q.with_(q.LOG, _RUNS) + "SELECT run_id, length AS value FROM runs WHERE length > 0 ORDER BY length DESC, run_id LIMIT 1")
def best_run(spark, sf):
    return promotion.best_run(_run_table(spark, sf), "length").select("run_id", "value")


@query(
    "compare_runs",
    q.with_(q.LOG, _RUNS) + "SELECT run_id, CASE WHEN n % 2 = 0 THEN ndcg END AS value FROM runs ORDER BY 2 DESC NULLS LAST, run_id LIMIT 60",
)
def compare_runs(spark, sf):
    return promotion.compare_runs(_run_table(spark, sf), "ndcg@10", 60).select("run_id", "value")


_METRICS = """metrics AS (SELECT run_id AS model, n AS pos, 'ndcg@10' AS metric, ndcg AS value FROM runs WHERE n % 2 = 0
  UNION ALL SELECT run_id, n, 'length', length FROM runs)"""


@query(
    "best_model",
    q.with_(q.LOG, _RUNS, _METRICS) + """SELECT model, value FROM (SELECT model, min(pos) AS pos,
      coalesce(max(value) FILTER (metric = 'ndcg@10'), 0) AS value FROM metrics GROUP BY 1) ORDER BY value DESC, pos, model LIMIT 1""",
)
def best_model(spark, sf):
    r = _runs(spark, sf)
    # training order: by request count, then by name
    pos = F.struct("n", "run_id")
    primary = r.filter(F.col("n") % 2 == 0).select(
        F.col("run_id").alias("model"), pos.alias("pos"), F.lit("ndcg@10").alias("metric"), F.col("ndcg").alias("value")
    )
    other = r.select(F.col("run_id").alias("model"), pos.alias("pos"), F.lit("length").alias("metric"), F.col("length").alias("value"))
    return promotion.best_model(primary.unionByName(other))


_DAILY = """daily AS (SELECT CAST(timestamp AS DATE) AS day, avg(len(ids)) AS p, 1 - avg(CAST(is_fallback AS INTEGER)) AS a, max(latency_ms) AS b FROM parsed_log GROUP BY 1),
pairs AS (SELECT n.day, n.p, n.a, n.b, c.p AS cp, c.a AS ca, c.b AS cb, c.day IS NULL AS fresh FROM daily n LEFT JOIN daily c ON c.day = n.day - 1),
gains AS (SELECT *, CASE WHEN cp > 0 THEN (p - cp) / cp ELSE CASE WHEN p > 0 THEN 1.0 ELSE 0.0 END END AS gain,
   CASE WHEN ca > 0 THEN (a - ca) / ca END AS da, CASE WHEN cb > 0 THEN (b - cb) / cb END AS db FROM pairs),
judged AS (SELECT *, gain < 0.01 AS weak, CASE WHEN da < -0.05 THEN 'answered' WHEN db < -0.05 THEN 'worst' END AS fell,
   CASE WHEN da < -0.05 THEN da WHEN db < -0.05 THEN db END AS fell_by FROM gains)"""


@query(
    "should_promote",
    q.with_(q.LOG, _DAILY) + """SELECT CAST(day AS VARCHAR) AS candidate, fresh OR (NOT weak AND fell IS NULL) AS promote,
      CASE WHEN NOT fresh THEN gain END AS improvement, CASE WHEN NOT fresh AND NOT weak THEN fell END AS worst_metric,
      CASE WHEN fresh THEN 'No existing production model'
           WHEN weak THEN 'Insufficient improvement on length: ' || printf('%.2f', gain * 100) || '% < 1.00% required'
           WHEN fell IS NOT NULL THEN 'Regression on ' || fell || ': ' || printf('%.2f', fell_by * 100) || '% exceeds max allowed -5.00%'
           ELSE 'Improved length by ' || printf('%.2f', gain * 100) || '%' END AS reason
    FROM judged""",
)
def should_promote(spark, sf):
    """Each day's figures against those of the day before."""
    log = _dated(spark, sf)
    daily = log.groupBy("day").agg(
        F.avg(F.array_size(fx.json_ids("recommendations"))).alias("length"),
        (1 - F.avg(F.col("is_fallback").cast("int"))).alias("answered"), F.max("latency_ms").alias("worst"),
    )

    def long(df):
        return df.select(
            F.col("day").cast("string").alias("candidate"),
            F.expr("stack(3, 0, 'length', length, 1, 'answered', answered, 2, 'worst', worst) as (pos, metric, value)"),
        )

    current = long(daily.withColumn("day", F.date_add("day", 1)))
    return promotion.should_promote(long(daily), current, primary="length")


@query(
    "sanitize_metric",
    q.with_(q.LOG, _RUNS) + "SELECT run_id, replace('ndcg@' || n, '@', '_at_') AS metric FROM runs",
)
def sanitize_metric(spark, sf):
    return _runs(spark, sf).select("run_id", fx.sanitize_metric(F.concat(F.lit("ndcg@"), "n")).alias("metric"))


@query(
    "merge_interactions",
    q.with_(q.RATINGS) + "SELECT DISTINCT user_id, item_id, timestamp FROM ratings WHERE rating >= 2",
)
def merge_interactions(spark, sf):
    """Retraining data: ratings of 4 and more, appended with all of 2 and more."""
    r = td.ratings(spark, sf)
    old = filters.to_implicit(r, 4).select("user_id", "item_id", "timestamp")
    new = filters.to_implicit(r, 2).select("user_id", "item_id", "timestamp")
    return promotion.merge_interactions(old, new)


@query(
    "catalog_coverage",
    _LOG + """, r AS (SELECT unnest(ids) AS item_id, unnest(range(1, len(ids) + 1)) AS rank FROM parsed_log)
    SELECT count(DISTINCT item_id) AS n_items, (SELECT count(DISTINCT p_partkey) FROM part) AS catalog_size,
      count(DISTINCT item_id) / CAST((SELECT count(DISTINCT p_partkey) FROM part) AS DOUBLE) AS coverage FROM r WHERE rank <= 100""",
)
def catalog_coverage(spark, sf):
    from affinis.operators.rank_metrics import catalog_coverage as coverage

    shown = td.request_log(spark, sf).select(F.posexplode(fx.json_ids("recommendations")).alias("p", "item_id"))
    return coverage(shown.withColumn("rank", F.col("p") + 1), td.items(spark, sf))


# --- streams --------------------------------------------------------------------------


def _log_stream(spark, sf):
    """The events table arriving as a stream of log rows."""
    schema = td.table(spark, sf, "events").schema
    return _log_rows(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf))


def _log_rows(events):
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("request_id"),
        # event time as an instant, the wall clock read as UTC
        F.timestamp_micros(
            F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
        ).alias("timestamp"),
        "user_id",
        F.when(kind == "click", "/similar").when(kind == "purchase", "/popular").otherwise("/recommend").alias("endpoint"),
        F.col("value").alias("latency_ms"), (F.col("event_id") % 7 == 0).alias("is_fallback"),
    )


def _scratch(spark, name):
    import uuid

    from affinis.session import checkpoint_dir

    return f"{checkpoint_dir(spark)}/{name}_{uuid.uuid4().hex}"


@query(
    "stream_log_ingest",
    _LOG + "SELECT endpoint, count(*) AS n, count(DISTINCT request_id) AS n_ids, sum(latency_ms) AS latency FROM request_log GROUP BY 1",
)
def stream_log_ingest(spark, sf):
    """Ingest the stream twice over; repeats of a request id are dropped."""
    from affinis.streaming.jobs import stream_log_ingest as ingest

    once = _log_stream(spark, sf)
    path = _scratch(spark, "stream_log")
    ingest(once.union(_log_stream(spark, sf)), path, path + "_state", once=True).awaitTermination()
    return spark.read.parquet(path).groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("request_id").alias("n_ids"), F.sum("latency_ms").alias("latency")
    )


@query(
    "stream_keyed_ingest",
    _LOG + """SELECT endpoint, count(*) AS n, count(DISTINCT request_id) AS n_ids,
      sum(CASE WHEN endpoint = '/popular' THEN -1.0 ELSE latency_ms END) AS latency FROM request_log GROUP BY 1""",
)
def stream_keyed_ingest(spark, sf):
    """Ingest the stream twice over into a log that holds the rows of one endpoint; those stay as they were."""
    from affinis.sources.keyed_log import KeyedLog
    from affinis.streaming.jobs import stream_keyed_ingest as ingest

    once = _log_stream(spark, sf)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in once.schema)
    log = KeyedLog(spark, _scratch(spark, "stream_keyed"), schema=schema, fan_in=2)
    held = _log_rows(td.table(spark, sf, "events")).filter("endpoint = '/popular'")
    log.append(held.withColumn("latency_ms", F.lit(-1.0)), "held before")
    ingest(once.union(_log_stream(spark, sf)), log, log.path + "_state", once=True).awaitTermination()
    return log.rows().groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("request_id").alias("n_ids"), F.sum("latency_ms").alias("latency")
    )


@query(
    "stream_kpis",
    _LOG + """SELECT strftime(time_bucket(INTERVAL '1 day', timestamp), '%Y-%m-%d') AS day, count(*) AS total_requests, avg(latency_ms) AS mean_ms,
      avg(CAST(event_id % 7 = 0 AS INTEGER)) FILTER (endpoint = '/recommend') AS fallback_rate
    FROM (SELECT ts AS timestamp, value AS latency_ms, event_id, endpoint FROM base_log)
    GROUP BY 1 HAVING max(CAST(timestamp AS DATE)) < (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def stream_kpis(spark, sf):
    """Daily figures of all closed windows (the last day stays open)."""
    from affinis.streaming.jobs import stream_kpis as figures

    path = _scratch(spark, "stream_kpis")
    figures(_log_stream(spark, sf), path, path + "_state", "1 day", once=True).awaitTermination()
    return spark.read.parquet(path).select(
        fx.ts_to_string(F.unix_seconds("window_start")).substr(1, 10).alias("day"),
        "total_requests", "mean_ms", "fallback_rate",
    )


@query(
    "window_kpis",
    _LOG + """SELECT strftime(time_bucket(INTERVAL '1 hour', timestamp), '%Y-%m-%d %H') AS hour, count(*) AS total_requests, avg(latency_ms) AS mean_ms,
      avg(CAST(is_fallback AS INTEGER)) FILTER (endpoint = '/recommend') AS fallback_rate FROM request_log GROUP BY 1""",
)
def window_kpis(spark, sf):
    from affinis.streaming.jobs import window_kpis as figures

    return figures(td.request_log(spark, sf)).select(
        F.date_format("window_start", "yyyy-MM-dd HH").alias("hour"), "total_requests", "mean_ms", "fallback_rate"
    )
