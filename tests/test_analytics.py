from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.operators import kpi, promotion, replay
from affinis.sources import request_log as rl
from affinis.sources.reports import report_json, report_sink

T0 = datetime(2026, 1, 1)
LOG = (
    "request_id string, timestamp timestamp_ntz, user_id bigint, endpoint string, model_version string, "
    "recommendations string, latency_ms double, is_fallback boolean, fallback_reason string"
)


@pytest.fixture(scope="module")
def rows():
    out, rng = [], np.random.default_rng(0)
    for n in range(60):
        endpoint = ["/recommend", "/recommend", "/similar", "/popular"][n % 4]
        recs = ["[1,2,3]", "[3,4]", "bad", None, "[]", "null", "5"][n % 7]
        out.append((
            f"r{n}", T0 + timedelta(minutes=n), None if endpoint == "/popular" else n % 5, endpoint,
            [None, "", "v1"][n % 3], recs, None if n % 10 == 9 else float(rng.random() * 200), n % 8 == 0, None,
        ))
    return out


@pytest.fixture(scope="module")
def log(spark, rows):
    return spark.createDataFrame(rows, LOG).cache()


def test_kpis(log, rows):
    end = T0 + timedelta(minutes=40)
    inside = [r for r in rows if r[1] < end]
    t = kpi.kpi_traffic(log, start=T0, end=end).first()
    assert t.total_requests == 40 and t.unique_users == len({r[2] for r in inside if r[2] is not None})
    assert t.requests_per_minute == pytest.approx(1.0)
    ms = [r[6] for r in inside if r[6] is not None]
    lat = kpi.kpi_latency(log, T0, end).first()
    assert [lat.mean_ms, lat.max_ms] == pytest.approx([np.mean(ms), np.max(ms)])
    assert [lat.p50_ms, lat.p95_ms, lat.p99_ms] == pytest.approx(np.percentile(ms, [50, 95, 99]).tolist())
    q = kpi.kpi_quality(log, 10, T0, end).first()
    asked = [r for r in inside if r[3] == "/recommend"]
    assert q.fallback_count == sum(r[7] for r in asked)
    assert q.fallback_rate == pytest.approx(q.fallback_count / len(asked))
    lists = [{"[1,2,3]": 3, "[3,4]": 2, "[]": 0}[r[5]] for r in inside if r[5] in ("[1,2,3]", "[3,4]", "[]")]
    assert q.unique_items_recommended == 4 and q.catalog_coverage == pytest.approx(0.4)
    assert q.avg_recommendations_per_request == pytest.approx(np.mean(lists))
    assert kpi.kpi_quality(log).first().catalog_coverage == 1.0  # catalog unknown: the shown items


def test_empty_log(log):
    none = log.limit(0)
    assert kpi.kpi_traffic(none, minutes=0).first().requests_per_minute == 0.0
    assert tuple(kpi.kpi_latency(none).first()) == (0.0,) * 5
    assert tuple(kpi.kpi_quality(none, 0).first()) == (0.0, 0, 0.0, 0, 0, 0.0)
    assert kpi.average_latency(none).first()[0] is None and kpi.fallback_rate(none).first()[0] is None
    interactions = none.select("user_id", F.lit(1).alias("item_id"))
    total = replay.replay_eval(replay.replay_request(rl.scan_request_log(none), interactions)).first()
    assert (total.hit_rate, total.precision, total.ctr_proxy, total.total_requests) == (0.0, 0.0, 0.0, 0)


def test_simple_figures(log, rows):
    since = T0 + timedelta(minutes=30)
    assert kpi.request_count(log, since, "/recommend").first()[0] == sum(r[1] >= since and r[3] == "/recommend" for r in rows)
    assert [r.request_id for r in kpi.recent_requests(log, 2).collect()] == ["r59", "r58"]
    recommend = [r[7] for r in rows if r[3] == "/recommend"]
    assert kpi.fallback_rate(log).first()[0] == pytest.approx(np.mean(recommend))
    status = kpi.kpi_status(kpi.kpi_latency(log), kpi.kpi_quality(log, 10)).first()
    assert status.latency_status == "High" and status.coverage_status == "Low"
    seen = log.limit(1).select(F.lit(1).alias("item_id"))
    assert {r.item_id for r in kpi.unseen_in_training(log, seen).collect()} == {2, 3, 4}


def test_report(log, tmp_path, spark):
    import json

    report = kpi.kpi_report(log, T0 + timedelta(minutes=60), 1.0, 10)
    data = json.loads(report_json(report).first().value)
    assert data["traffic"]["total_requests"] == 60 and data["traffic"]["requests_per_minute"] == 1.0
    assert data["traffic"]["requests_by_endpoint"] == {"/recommend": 30, "/similar": 15, "/popular": 15}
    assert set(data["latency"]["latency_by_endpoint"]) == {"/recommend", "/similar", "/popular"}
    path = report_sink(report, str(tmp_path), "20260101", "kpi")
    assert json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())) == data
    empty = json.loads(report_json(kpi.kpi_report(log, T0, 1.0)).first().value)
    assert empty["traffic"]["total_requests"] == 0


def seconds(dt):
    return int((dt - datetime(1970, 1, 1)).total_seconds())


@pytest.mark.parametrize("window", [None, 1, 600, 3600])
def test_replay(spark, log, rows, window):
    rng = np.random.default_rng(1)
    acts = [(int(rng.integers(0, 4)), int(rng.integers(1, 6)), seconds(T0) + int(rng.integers(-3600, 7200))) for _ in range(40)]
    acts += [(0, 3, seconds(T0) + 60 * n) for n in range(60)]  # one pair repeated often
    likes = spark.createDataFrame(acts, "user_id bigint, item_id bigint, timestamp bigint")
    per = replay.replay_request(rl.scan_request_log(log), likes, window).cache()
    want, lists = {}, {"[1,2,3]": [1, 2, 3], "[3,4]": [3, 4], "[]": []}
    for r in rows:
        if r[3] == "/recommend" and r[2] is not None and r[5] in lists:
            t = seconds(r[1])
            hit = {i for i in lists[r[5]] if any(u == r[2] and x == i and (window is None or t < s <= t + window) for u, x, s in acts)}
            want[r[0]] = (len(lists[r[5]]), len(hit), r[4] or "unknown")
    assert {r.request_id: (r.n_recs, r.n_hits, r.model_version or "unknown") for r in per.collect()} == want
    total = replay.replay_eval(per).first()
    assert total.total_hits == sum(h for _, h, _ in want.values())
    assert total.precision == pytest.approx(np.mean([h / n if n else 0 for n, h, _ in want.values()]))
    versions = {r.model_version: r.total_requests for r in replay.replay_by_version(per).collect()}
    assert versions == {v: sum(w[2] == v for w in want.values()) for v in {w[2] for w in want.values()}}


def test_promotion(spark):
    new = [
        ("first", {"ndcg@10": 0.1}), ("weak", {"ndcg@10": 0.1005}), ("good", {"ndcg@10": 0.12, "recall@10": 0.5}),
        ("worse", {"ndcg@10": 0.12, "recall@10": 0.4, "mrr": 0.1, "n_users_evaluated": 5}), ("from_zero", {"ndcg@10": 0.2}),
        ("still_zero", {"ndcg@10": 0.0}), ("missing", {"recall@10": 1.0}),
    ]
    old = {"ndcg@10": 0.1, "recall@10": 0.5, "mrr": 0.2, "n_users_evaluated": 100}
    current = {c: old for c, _ in new if c != "first"} | {"from_zero": {"ndcg@10": 0.0}, "still_zero": {"ndcg@10": 0.0}}
    n = [(c, p, m, float(v)) for c, ms in new for p, (m, v) in enumerate(ms.items())]
    k = [(c, m, float(v)) for c, ms in current.items() for m, v in ms.items()]
    got = promotion.should_promote(
        spark.createDataFrame(n, "candidate string, pos int, metric string, value double"),
        spark.createDataFrame(k, "candidate string, metric string, value double"),
    )
    out = {r.candidate: (r.promote, r.reason) for r in got.collect()}
    assert out["first"] == (True, "No existing production model")
    assert out["weak"] == (False, "Insufficient improvement on ndcg@10: 0.50% < 1.00% required")
    assert out["good"] == (True, "Improved ndcg@10 by 20.00%")
    assert out["worse"] == (False, "Regression on recall@10: -20.00% exceeds max allowed -5.00%")
    assert out["from_zero"] == (True, "Improved ndcg@10 by 100.00%")
    assert out["still_zero"][0] is False and out["missing"][0] is False


def test_selection(spark):
    m = spark.createDataFrame(
        [("a", 0, "ndcg@10", 0.3), ("b", 1, "ndcg@10", 0.3), ("c", 2, "mrr", 0.9)], "model string, pos int, metric string, value double"
    )
    assert promotion.best_model(m).first().model == "a"
    runs = spark.createDataFrame(
        [("r1", {"ndcg_at_10": 0.1}), ("r2", {"ndcg_at_10": 0.4}), ("r3", {}), ("r4", {"ndcg_at_10": 0.0})],
        "run_id string, metrics map<string,double>",
    )
    assert promotion.best_run(runs).first().run_id == "r2"
    assert promotion.best_run(runs, higher_is_better=False).first().run_id == "r1"
    assert [r.run_id for r in promotion.compare_runs(runs, top_n=4).collect()] == ["r2", "r1", "r4", "r3"]
    a = spark.createDataFrame([(1, 1, 5), (1, 1, 5)], "user_id int, item_id int, timestamp int")
    assert promotion.merge_interactions(a, a).count() == 1


def test_list_length_does_not_depend_on_ansi_mode(spark):
    from affinis.operators import kpi

    rows = [("1", "/recommend", "[1,2,3]", False), ("2", "/recommend", None, False), ("3", "/recommend", "bad", False)]
    log = spark.createDataFrame(rows, "request_id string, endpoint string, recommendations string, is_fallback boolean")
    was = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            assert kpi.kpi_quality(log).first().avg_recommendations_per_request == 3.0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)
