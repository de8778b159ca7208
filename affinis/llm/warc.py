"""Deterministic sharded WARC archives: writing pages and reading them back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.session import cut_lineage

#: Uncompressed bytes of a shard, compressed bytes after which a file ends, steps of the ids from
#: which shards are made, date of all records (pages have none).
SHARD_BYTES, FILE_BYTES, STEPS, DATE = 24 << 20, 8 << 20, 1 << 16, "1970-01-01T00:00:00Z"

_SPACE = uuid.UUID("6f0cf8e6-6b0f-5c1c-9d7e-1d3a5b7c9e11")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"


def _value(text: str) -> str:
    """A header value: characters that would end or break the line are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A response record, or a revisit record (without the payload) if the page has one to refer to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = base32_sha1(payload)
    headers = [("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", _value(url)))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        return _record("response", headers, http + payload)
    headers += [("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page", str(refers_to)), ("WARC-Profile", _PROFILE)]
    return _record("revisit", headers, http)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class _Files:
    """The files of one shard: each record is a gzip member; a file ends once it is large enough.

    Files get names of their own for each attempt of a task, so attempts do not meet.
    """

    def __init__(self, store: fs.FileSystem, path: str, shard: int, limit: int, attempt: int):
        self.store, self.path, self.shard, self.limit, self.attempt = store, path, shard, limit, attempt
        self.number, self.out = 0, None

    def add(self, record: bytes, count: bool = True) -> dict | None:
        if self.out is None:
            self.name = f"tmp/{self.shard:06d}-{self.number:05d}.{self.attempt}"
            self.out = self.store.open_output_stream(f"{self.path}/{self.name}", compression=None)
            self.size, self.records, self.digest = 0, 0, hashlib.sha1()
            info = f"software: affinis\r\nformat: WARC File Format 1.1\r\nshard: {self.shard}\r\npart: {self.number}\r\n".encode()
            name = uuid.uuid5(_SPACE, f"info {self.shard} {self.number}")
            self.add(_record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info), False)
        member = gzip.compress(record, 6, mtime=0)
        self.out.write(member)
        self.digest.update(member)
        self.size += len(member)
        self.records += count
        return self.end() if count and self.size >= self.limit else None

    def end(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        done = {
            "temporary": self.name, "file": f"{self.shard:06d}-{self.number:05d}.warc.gz", "shard": self.shard,
            "part": self.number, "records": self.records, "bytes": self.size, "sha1": self.digest.hexdigest(),
        }
        self.number += 1
        return done


_MANIFEST = pa.schema([("temporary", pa.string()), ("file", pa.string()), ("shard", pa.int32()), ("part", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())])


def _write(folder: str, limit: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        store.create_dir(f"{path}/tmp", recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        files, note, done = None, None, []
        for b in batches:
            shards, kinds, ids, digests, urls, pages, refers = (b.column(i) for i in range(7))
            for i in range(b.num_rows):
                key = (ids[i].as_py(), digests[i].as_py())
                if kinds[i].as_py() == 0:  # stands before the page it is about
                    note = (key, refers[i].as_py())
                    continue
                shard = shards[i].as_py()
                if files is None or files.shard != shard:
                    done.append(files and files.end())
                    files = _Files(store, path, shard, limit, attempt)
                refers_to = note[1] if note and note[0] == key else None
                payload = (pages[i].as_py() or "").encode("utf-8", "replace")
                done.append(files.add(page_record(key[0], urls[i].as_py(), payload, refers_to, date)))
            yield pa.RecordBatch.from_pylist([x for x in done if x], _MANIFEST)
            done = []
        if files and (last := files.end()):
            yield pa.RecordBatch.from_pylist([last], _MANIFEST)

    return run


def _publish(folder: str):
    """Renames finished files; a rename that an earlier attempt did is left as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        for b in batches:
            for row in b.to_pylist():
                if store.get_file_info(f"{path}/{row['temporary']}").type != fs.FileType.NotFound:
                    store.move(f"{path}/{row['temporary']}", f"{path}/{row['file']}")
            yield b

    return run


def _shards(pages: DataFrame, shard_bytes: int) -> tuple[DataFrame, Column, int]:
    """A table ``(step, shard)`` of at most ``STEPS`` + 1 rows, the step of an id, and the number
    of shards: runs of id steps of about ``shard_bytes``.

    Only ids and sizes decide, so the same pages give the same shards on any cluster.
    """
    low, high = pages.agg(F.min("id"), F.max("id")).first()
    width = ((high or 0) - (low or 0)) // STEPS + 1
    step = F.coalesce(F.floor((F.col("id") - (low or 0)) / width).cast("int"), F.lit(STEPS))
    sums = pages.groupBy(step.alias("step")).agg(F.sum("bytes").alias("bytes")).collect()
    shard, size, rows = 0, 0, []
    for r in sorted(sums, key=lambda r: r.step):
        if size and size + r.bytes > shard_bytes:
            shard, size = shard + 1, 0
        rows.append((r.step, shard))
        size += r.bytes
    return pages.sparkSession.createDataFrame(rows, "step int, shard int"), step, shard + 1


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = 0,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Writes every row as a record below ``folder`` and returns the manifest.

    Rows are sorted by id and dealt to shards by runs of ids; a shard is written by one task as a
    stream, in files that end once they have ``file_bytes``. Files get temporary names, are
    listed in a manifest that only finished tasks reach, are then renamed, and the manifest
    is written last, so a reader sees whole files only and lost tasks can be repeated. Headers and
    digests are made anew from the rows; equal tables give equal files.

    The payload is the text in UTF-8, empty for null. Of payloads equal by SHA-1 with at least
    ``least`` bytes, rows with the smallest id are response records, the others revisit it.
    Null ids come last and have no id header; a null URL has no target header; repeated rows are
    records of their own. ``folder`` is a URI that all executors reach. Other columns are ignored.
    """
    text = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), text.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    digests = cut_lineage(rows.select("id", "digest", F.octet_length("html").alias("bytes")))
    table, step, shards = _shards(digests, shard_bytes)
    table = F.broadcast(table)  # STEPS rows at most
    same = cut_lineage(
        digests.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL")
    )
    # both are stored tables, so that Spark can split a payload that very many pages have
    notes = digests.join(same, "digest").filter("id > first OR id IS NULL").select("id", "digest", F.col("first").alias("refers")).distinct()
    null = F.lit(None).cast("string")
    both = rows.select("id", "digest", F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("bigint").alias("refers")).unionByName(
        notes.select("id", "digest", F.lit(0).alias("kind"), null.alias("url"), null.alias("html"), "refers")
    )
    dealt = (
        both.withColumn("step", step)
        .join(table, "step")
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions(F.col("id").asc_nulls_last(), "digest", "kind", "url")
        .select("shard", "kind", "id", "digest", "url", "html", "refers")
    )
    schema = "temporary string, file string, shard int, part int, records bigint, bytes bigint, sha1 string"
    written = cut_lineage(dealt.mapInArrow(_write(folder, file_bytes, date), schema))
    published = written.mapInArrow(_publish(folder), schema).drop("temporary")
    published.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an uncompressed WARC stream; block digests are checked."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if headers.get("WARC-Block-Digest") != f"sha1:{base32_sha1(block)}":
            raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
        yield headers, block


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _page(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged payload {headers['WARC-Record-ID']}")
    number = lambda k: int(headers[k]) if k in headers else None
    return {
        "page_id": number("X-Page-Id"), "url": headers.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": number("X-Refers-To-Page"), "payload": payload if with_payload and kind == "response" else None,
    }


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the files in the manifest, headers and digests checked.

    ``payload`` holds a response's bytes (null for revisits, or if not asked for).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as raw, gzip.open(raw) as stream:
                    for headers, block in parse(stream):
                        if headers["WARC-Type"] in ("response", "revisit"):
                            rows.append(_page(headers, block, with_payload))
                            size += len(block)
                        if len(rows) >= 2000 or size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _READ)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, _READ)

    files = spark.read.parquet(f"{folder}/manifest").select("file")
    tasks = max(1, min(files.count(), 16 * spark.sparkContext.defaultParallelism))
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    return files.repartition(tasks).mapInArrow(run, schema)
