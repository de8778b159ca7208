import gzip
import hashlib
import io
import uuid

import pytest

from affinis.llm import warc
from affinis.llm.queries import QUERIES, SQL
from affinis.llm.tables import shared_folder
from oracle import same


def folder(spark):
    return f"{shared_folder(spark)}/test-{uuid.uuid4().hex}"


ROWS = [(5, "http://a/ b\r\nX: y", "<p>é</p>", "z"), (3, None, "<p>é</p>", "z"), (4, "u", None, None), (6, "u", "", "z"),
        (None, "n", "<p>é</p>", "z"), (7, "w", "long " * 200_000, "z"), (3, None, "<p>é</p>", "z"), (2, "x", "only", "z"), (3, "v", "two", "z"), (None, "m", "lone", "z")]


def files(spark, where):
    store, path = warc._open(where)
    found = {}
    for r in spark.read.parquet(f"{where}/manifest").collect():
        with store.open_input_stream(f"{path}/{r.file}", compression=None) as f:
            found[r.file] = (f.read(), r)
    return found


def test_round_trip_and_reruns(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, digest string")
    a, b = folder(spark), folder(spark)
    warc.write_archives(df, a, shard_bytes=300, file_bytes=250)
    got = warc.read_archives(spark, a).collect()
    first = {"<p>é</p>": 3, "": 4}
    want = []
    for i, url, html, _ in ROWS:
        payload = (html or "").encode()
        revisit = first.get(html or "", i) != i
        want.append((i, url and url.replace(" ", "%20").replace("\r\n", "%0D%0A"), len(payload), warc.base32_sha1(payload),
                     "revisit" if revisit else "response", first[html or ""] if revisit else None, None if revisit else payload))
    key = lambda r: tuple(map(repr, r))
    plain = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in got]
    assert sorted(plain, key=key) == sorted(want, key=key)
    # other partitions give the same files, and each is what the manifest says
    warc.write_archives(df.repartition(7), b, shard_bytes=300, file_bytes=250)
    x, y = files(spark, a), files(spark, b)
    assert {k: v[0] for k, v in x.items()} == {k: v[0] for k, v in y.items()} and len(x) > 3
    order = []
    for name in sorted(x):
        data, row = x[name]
        assert len(data) == row.bytes and hashlib.sha1(data).hexdigest() == row.sha1
        records = list(warc.parse(io.BytesIO(gzip.decompress(data))))
        assert records[0][0]["WARC-Type"] == "warcinfo" and len(records) == row.records + 1
        order += [int(h.get("X-Page-Id", 10**9)) for h, _ in records[1:]]
    assert order == sorted(order)


def test_least_bytes_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy")], "page_id long, url string, html string")
    where = folder(spark)
    warc.write_archives(df, where, least=3)
    assert [r.record_type for r in warc.read_archives(spark, where).collect()] == ["response"] * 2
    where = folder(spark)
    warc.write_archives(df.limit(0), where)
    assert warc.read_archives(spark, where).collect() == []


def test_damage_is_noticed():
    record = warc.page_record(1, "u", b"abc", None)
    assert len(list(warc.parse(io.BytesIO(record)))) == 1
    with pytest.raises(ValueError, match="damaged"):
        list(warc.parse(io.BytesIO(record.replace(b"abc", b"abd"))))


def test_a_finished_rename_can_be_repeated(spark, tmp_path):
    import pyarrow as pa

    (tmp_path / "tmp").mkdir()
    (tmp_path / "tmp/x").write_bytes(b"1")
    row = {"temporary": "tmp/x", "file": "f", "shard": 0, "part": 0, "records": 1, "bytes": 1, "sha1": ""}
    batch = pa.RecordBatch.from_pylist([row], warc._MANIFEST)
    for _ in range(2):
        assert list(warc._publish(f"file://{tmp_path}")([batch])) == [batch]
    assert (tmp_path / "f").read_bytes() == b"1"


def test_query_equals_sql(spark, sf_dir):
    same(QUERIES["op2_warc_archives"](spark, sf_dir), SQL["op2_warc_archives"], sf_dir)
