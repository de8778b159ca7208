from datetime import datetime, timedelta

from affinis.session import stage_count
from affinis.sources.keyed_log import KeyedLog
from affinis.sources.request_log import LOG_SCHEMA
from affinis.streaming.jobs import read_log_stream, stream_keyed_ingest, stream_kpis, stream_log_ingest, window_kpis

T0 = datetime(2026, 1, 1)


def write_log(spark, path, n=400):
    rows = [
        (f"r{i % (n - 50)}", T0 + timedelta(minutes=i % (n - 50)), i % 7, None, ["/recommend", "/similar"][i % 2], "v1",
         "[1]", "[1.0]", float(i % 13), i % 4 == 0, None)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, LOG_SCHEMA)
    df.repartition(4).write.parquet(path)
    return df


def test_ingest_equals_batch(spark, tmp_path):
    df = write_log(spark, str(tmp_path / "in"))
    stream = read_log_stream(spark, str(tmp_path / "in"))
    for _ in range(2):  # a restart from the same checkpoint adds nothing
        stream_log_ingest(stream, str(tmp_path / "out"), str(tmp_path / "c"), once=True).awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == df.select("request_id").distinct().count() == 350
    assert out.select("request_id").distinct().count() == 350 and "date" in out.columns


def log_rows(spark, ids, day, latency):
    rows = [(i, T0 + timedelta(days=day), 1, None, "/recommend", "v1", "[1]", "[1.0]", latency, False, None) for i in ids]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_keyed_ingest_drops_repeats_of_any_age(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=4, fan_in=2)
    log.append(log_rows(spark, ["old", "r0"], 0, 0.0), "stored before")
    source, state = str(tmp_path / "in"), str(tmp_path / "c")
    stages = stage_count()

    def run(checkpoint):
        stream = read_log_stream(spark, source)
        query = stream_keyed_ingest(stream, log, checkpoint, once=True)
        assert query.awaitTermination(120) and query.exception() is None
        return {r.request_id: r.latency_ms for r in log.rows().collect()}

    log_rows(spark, ["r0", "r1", "r2"], 1, 1.0).coalesce(1).write.parquet(source)
    assert run(state) == {"old": 0.0, "r0": 0.0, "r1": 1.0, "r2": 1.0}
    # years after the watermark of any window, and years before it
    log_rows(spark, ["old", "r1", "r3"], 900, 2.0).coalesce(1).write.mode("append").parquet(source)
    log_rows(spark, ["r2", "r4"], -900, 2.0).coalesce(1).write.mode("append").parquet(source)
    expected = {"old": 0.0, "r0": 0.0, "r1": 1.0, "r2": 1.0, "r3": 2.0, "r4": 2.0}
    assert run(state) == expected
    made = log.generations()
    assert run(state) == expected and log.generations() == made  # a restart has nothing to add
    assert run(str(tmp_path / "other")) == expected  # a new checkpoint only repeats
    assert log.rows().count() == 6 and stage_count() == stages


def test_window_figures_equal_batch(spark, tmp_path):
    df = write_log(spark, str(tmp_path / "in"))
    stream = read_log_stream(spark, str(tmp_path / "in"))
    stream_kpis(stream, str(tmp_path / "out"), str(tmp_path / "c"), once=True).awaitTermination(120)
    keyed = lambda d: {r.window_start: (r.total_requests, r.unique_users, r.mean_ms, r.fallback_rate) for r in d.collect()}
    batch, got = keyed(window_kpis(df)), keyed(spark.read.parquet(str(tmp_path / "out")))
    # the last windows stay open until the watermark passes them
    assert len(got) >= len(batch) - 2 and all(batch[k] == v for k, v in got.items())
    assert sum(v[0] for v in batch.values()) == 400
    assert window_kpis(df, "1 hour", "30 minutes").count() > len(batch)
