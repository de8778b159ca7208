import datetime as dt

from pyspark.sql import functions as F

from affinis.sources import keyed_log
from affinis.sources.keyed_log import KeyedLog

SCHEMA = "request_id string, timestamp timestamp, latency_ms double"


def batch_df(spark, ids, day, latency):
    at = dt.datetime(2026, 1, 1) + dt.timedelta(days=day)
    return spark.createDataFrame([(i, at + dt.timedelta(seconds=n), latency) for n, i in enumerate(ids)], SCHEMA)


def test_first_row_stays_over_any_span(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=8, schema=SCHEMA)
    assert log.rows() is None
    assert log.append(batch_df(spark, [f"r{n}" for n in range(50)] + ["r1", None], 0, 1.0), "a")
    assert log.append(batch_df(spark, [f"r{n}" for n in range(40, 70)], 400, 2.0), "b")
    assert not log.append(batch_df(spark, ["other"], 401, 3.0), "b")  # a repeated batch adds nothing
    rows = {r.request_id: r.latency_ms for r in log.rows().collect()}
    assert rows == {f"r{n}": 1.0 if n < 50 else 2.0 for n in range(70)}
    assert log.rows().count() == 70


def test_new_ids_open_few_folders(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=16, schema=SCHEMA)
    log.append(batch_df(spark, [f"r{n}" for n in range(2000)], 0, 1.0), "a")
    log.append(batch_df(spark, ["new-1", "new-2", "new-3"], 1, 1.0), "b")
    assert log.opened == []  # no filter lets them through
    log.append(batch_df(spark, ["r7", "new-4"], 2, 1.0), "c")
    assert len(log.opened) == 1
    assert log.rows().count() == 2004


def test_lost_append_can_run_again(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=4, schema=SCHEMA)
    log.append(batch_df(spark, ["x"], 0, 1.0), "a")
    # files of an append that stopped before its manifest row
    batch_df(spark, ["y"], 1, 9.0).withColumn("date", F.to_date("timestamp")).write.partitionBy("date").parquet(log._folder("rows", 1))
    assert log.rows().count() == 1
    assert log.append(batch_df(spark, ["x", "y"], 1, 2.0), "b")
    assert {(r.request_id, r.latency_ms) for r in log.rows().collect()} == {("x", 1.0), ("y", 2.0)}


def test_empty_batches(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=4, schema=SCHEMA)
    assert log.append(batch_df(spark, [], 0, 1.0), "none")
    assert log.rows().isEmpty()
    assert log.append(batch_df(spark, ["x"], 0, 1.0), "a")
    assert [r.request_id for r in log.rows().collect()] == ["x"]


def test_generations_are_merged(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=4, schema=SCHEMA, fan_in=2)
    for n in range(5):  # every batch repeats half of the one before
        assert log.append(batch_df(spark, [f"r{i}" for i in range(10 * n, 10 * n + 20)], n, float(n)), f"b{n}")
        assert len(log.generations()) <= 3
    assert sorted(log.generations().values()) == [0, 2]
    rows = {r.request_id: r.latency_ms for r in log.rows().collect()}
    assert rows == {f"r{i}": float(max(0, (i - 10) // 10)) for i in range(60)} and log.rows().count() == 60
    assert not log.append(batch_df(spark, ["other"], 9, 9.0), "b0")  # names outlive merges
    assert log.vacuum() == 6 and log.vacuum() == 0
    assert log.rows().count() == 60
    log.append(batch_df(spark, ["r1", "r55", "new"], 9, 9.0), "last")
    assert log.rows().count() == 61


def test_a_lost_merge_is_made_up_for(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=4, schema=SCHEMA, fan_in=2)
    log._merge = lambda live: None
    for n in range(2):
        log.append(batch_df(spark, [f"r{n}", "both"], n, float(n)), f"b{n}")
    assert len(log.generations()) == 2
    again = log.on(spark)
    again.append(batch_df(spark, ["r2"], 2, 2.0), "b2")
    assert len(again.generations()) == 1 and again.rows().count() == 4


def test_filters_are_cut_into_small_blocks(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=1, schema=SCHEMA)
    log.append(batch_df(spark, [f"r{n}" for n in range(5000)], 0, 1.0), "a")
    filters = spark.read.parquet(log._folder("index/filters", 0))
    assert max(r.n for r in filters.select(F.size("words").alias("n")).collect()) <= 64  # of 256 ids, however many there are
    log.append(batch_df(spark, [f"r{n}" for n in range(4000, 6000)], 1, 2.0), "b")
    rows = {r.request_id: r.latency_ms for r in log.rows().collect()}
    assert rows == {f"r{n}": 1.0 if n < 5000 else 2.0 for n in range(6000)} and log.rows().count() == 6000


def test_filters_without_blocks_are_still_read(spark, tmp_path, monkeypatch):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=2, schema=SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(keyed_log, "BLOCK_IDS", 10**9)
        log.append(batch_df(spark, [f"r{n}" for n in range(600)], 0, 1.0), "a")
    whole = spark.read.parquet(log._folder("index/filters", 0)).drop("block", "blocks").collect()
    old = spark.createDataFrame(whole, "gen int, bucket int, bits bigint, words array<bigint>")
    old.write.mode("overwrite").parquet(log._folder("index/filters", 0))
    log.append(batch_df(spark, [f"r{n}" for n in range(500, 700)], 1, 2.0), "b")
    assert log.rows().count() == 700 and log.rows().filter("latency_ms = 1").count() == 600
