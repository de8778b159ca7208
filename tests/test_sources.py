import json
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from helpers import matrix_df
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from affinis.functions.text import GENRES
from affinis.operators.als import als_fit
from affinis.operators.serve import model_status
from affinis.sources import bundle, ratings, runs, tables
from affinis.sources import request_log as rl


def test_ratings_and_items(spark, tmp_path):
    (tmp_path / "u.data").write_text("1\t6\t5\t887431973\n1\t10\t3\t875693118\n")
    r = ratings.scan_ratings(spark, str(tmp_path / "u.data"))
    assert r.dtypes == [("user_id", "int"), ("item_id", "int"), ("rating", "tinyint"), ("timestamp", "bigint")]
    assert [tuple(x) for x in r.orderBy("item_id").collect()] == [(1, 6, 5, 887431973), (1, 10, 3, 875693118)]
    flags = lambda *on: "|".join("1" if g in on else "0" for g in GENRES)
    text = f"1|Misérables, Les (1995)|01-Jan-1995||http://x|{flags('Drama', 'War')}\n2|Piano, The (1993)|||http://y|{flags('Drama')}\n"
    (tmp_path / "u.item").write_bytes(text.encode("latin-1"))
    raw = ratings.scan_items(spark, str(tmp_path / "u.item"))
    assert len(raw.columns) == 22 and len(ratings.scan_items(spark, str(tmp_path / "u.item"), True).columns) == 24
    got = [tuple(x) for x in ratings.item_features(raw).orderBy("item_id").collect()]
    assert got == [(1, "Misérables, Les", 1995, ["Drama", "War"]), (2, "The Piano", 1993, ["Drama"])]
    (tmp_path / "empty").write_text("")
    found = {x.name: x.present for x in ratings.source_manifest(spark, str(tmp_path), ["u.data", "empty", "gone"]).collect()}
    assert found == {"u.data": True, "empty": False, "gone": False}


def test_tables_and_mappings(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "train"), (3, 4, "val")], "user_id int, item_id int, split string")
    tables.write_table(df, str(tmp_path / "split"), partition_by=["split"])
    assert tables.read_split(spark, str(tmp_path / "split"), "val").count() == 1
    tables.write_table(df.drop("split"), str(tmp_path / "csv"), "csv")
    back = tables.read_table(spark, str(tmp_path / "csv"), "csv", "user_id int, item_id int")
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2), (3, 4)]
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "nothing"))
    mapping = {str(i * 7): i for i in range(50)}
    for name, indent in (("flat.json", None), ("tall.json", 2)):
        (tmp_path / name).write_text(json.dumps(mapping, indent=indent))
        got = tables.read_mapping(spark, str(tmp_path / name))
        assert {str(r.id): r.idx for r in got.collect()} == mapping
    tables.write_mapping(got, str(tmp_path / "lines"))
    assert {str(r.id): r.idx for r in tables.read_mapping_lines(spark, str(tmp_path / "lines")).collect()} == mapping


def test_request_log(spark, tmp_path):
    t = datetime(2026, 1, 1, 12)
    base = "request_id string, timestamp timestamp, recommendations array<bigint>, scores array<double>, latency_ms double"
    def rows(tag, n, **extra):
        df = spark.createDataFrame([(f"{tag}{i}", t + timedelta(days=i), [1, 2], [0.5, 0.25], 1.0 + i) for i in range(n)], base)
        return df.withColumns(extra)
    rec = rl.log_recommend(rows("a", 3, user_id=F.lit(5), model_version=F.lit("v1"), is_fallback=F.lit(True), fallback_reason=F.lit("popularity")))
    sim = rows("b", 2, item_id=F.lit(77), model_version=F.lit("v1"))
    pop = rl.log_popular(rows("c", 2, genre=F.when(F.col("request_id") == "c0", "Drama")))
    assert {(r.user_id, r.item_id, r.endpoint) for r in rl.log_similar(sim).collect()} == {(None, 77, "/similar")}
    assert {r.user_id for r in rl.log_similar(sim, True).collect()} == {77}
    assert {r.request_id: r.fallback_reason for r in pop.collect()} == {"c0": "genre=Drama", "c1": None}
    assert rec.columns == pop.columns and json.loads(rec.first().recommendations) == [1, 2]
    path = str(tmp_path / "log")
    rl.append_request_log(rec.unionByName(rec).unionByName(pop), path)
    rl.append_request_log(rl.log_similar(sim).unionByName(pop), path)
    log = rl.read_request_log(spark, path)
    assert log.count() == 7 and log.select("request_id").distinct().count() == 7
    assert rl.read_request_log(spark, path, 2, date(2026, 1, 3)).count() == 4
    got = rl.scan_request_log(log, t, t + timedelta(days=2)).orderBy("timestamp").collect()
    assert [(r.request_id, r.recommendations) for r in got] == [("a0", [1, 2]), ("a1", [1, 2])]


def test_first_of_repeated_ids_stays(spark):
    t = datetime(2026, 1, 1)
    df = spark.createDataFrame([("x", t + timedelta(1), 2.0), ("x", t, 1.0), ("y", t, 3.0)], "request_id string, timestamp timestamp, latency_ms double")
    assert sorted((r.request_id, r.latency_ms) for r in rl.new_rows(df).collect()) == [("x", 1.0), ("y", 3.0)]
    old = spark.createDataFrame([("y",)], "request_id string")
    assert [r.request_id for r in rl.new_rows(df, old).collect()] == ["x"]


def test_bundle(spark, tmp_path):
    x = (np.random.default_rng(0).random((12, 9)) < 0.4).astype(float)
    model = als_fit(matrix_df(spark, x), factors=4, iterations=2)
    ids = lambda n: spark.range(n).select(F.col("id"), F.col("id").alias("idx"))
    features = spark.createDataFrame([(1, "T", 1990, ["a"])], "item_id bigint, title string, year int, genres array<string>")
    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        bundle.load_bundle(spark, path)
    assert bundle.bundle_version(spark, path).count() == 0
    with pytest.raises(ValueError):
        bundle.export_bundle("item-item", None, None, None, {}, path, "v", "")
    for version, stamp in (("v1", "2026-01-01"), ("v2", "2026-01-02")):
        bundle.export_bundle(model, ids(12), ids(9), features, {"ndcg@10": 0.1}, path, version, stamp)
    meta = bundle.load_bundle(spark, path)
    assert bundle.bundle_version(spark, path).first().version == "v2"
    assert bundle.bundle_metrics(spark, path).first().metrics == {"ndcg@10": 0.1}
    assert meta["user_mapping"].count() == 12 and meta["metadata"].first().params["factors"] == "4"
    assert bundle.load_bundle(spark, path, "v1")["metadata"].first().version == "v1"
    done = {r.part: r.present for r in bundle.bundle_complete(spark, path, "v3").collect()}
    assert not any(done.values()) and len(done) == 7
    status = model_status(bundle.bundle_metadata(spark, path), meta["user_mapping"], meta["item_mapping"]).first()
    assert tuple(status) == ("healthy", "v2", 12, 9)
    (tmp_path / "old" / "metadata").mkdir(parents=True)
    (tmp_path / "old" / "metadata" / "m.json").write_text('{"model_version": "test_v1", "created_at": "2026"}')
    assert bundle.bundle_version(spark, str(tmp_path / "old")).first().version == "test_v1"


def test_runs(spark, tmp_path):
    for run, value in (("aa", "0.1"), ("bb", "0.2")):
        for kind, key, text in (("metrics", "ndcg_at_10", f"1 0.05 0\n2 {value} 1\n"), ("params", "k", "50"), ("tags", "mlflow.runName", f"run-{run}")):
            folder = tmp_path / "exp" / run / kind
            folder.mkdir(parents=True)
            (folder / key).write_text(text)
    got = {r.run_id: r for r in runs.runs_scan(spark, str(tmp_path)).collect()}
    assert got["bb"].metrics == {"ndcg_at_10": 0.2} and got["bb"].params == {"k": "50"} and got["aa"].run_name == "run-aa"
    m = spark.createDataFrame([("ndcg@10", 0.3), ("mrr", 0.4)], "metric string, value double")
    path = str(tmp_path / "table")
    runs.runs_append(runs.run_rows(m, "cc", "third", {"factors": 64, "flags": [1, 2]}, {"model": "als"}), path)
    runs.runs_append(runs.run_rows(m, "dd", "fourth", {}), path)
    rows = {r.run_id: r for r in spark.read.parquet(path).collect()}
    assert rows["cc"].metrics == {"ndcg_at_10": 0.3, "mrr": 0.4} and rows["cc"].params == {"factors": "64", "flags": "[1, 2]"}
    assert rows["dd"].params == {}
