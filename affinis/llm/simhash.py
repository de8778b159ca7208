"""SimHash fingerprints and near-duplicate groups by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.components import components, forest
from affinis.llm.text_batch import releasing, words
from affinis.session import cut_lineage

#: Fingerprints of one cell held in memory while others stream past them.
CELL = 4096
#: Pairs compared at once in a task.
PAIRS = 1 << 21


def _fingerprints(texts: pa.Array, size: int, seed: int) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for w in words(texts):
        if not len(w.start):
            continue
        n = np.diff(w.bounds)
        # one space between the words of a text, none between texts
        keep = np.zeros(len(w.data) + 1, np.int8)
        keep[w.start] += 1
        keep[w.end] -= 1
        keep = np.cumsum(keep, dtype=np.int8)[:-1].astype(bool)
        inner = w.end[:-1][w.row[:-1] == w.row[1:]]
        keep[inner] = True
        data = w.data.copy()
        data[inner] = 0x20
        new = np.cumsum(keep) - 1
        start, end = new[w.start], new[w.end - 1] + 1
        joined = data[keep].tobytes()
        # a text of fewer words is one shingle
        many = np.maximum(n - size + 1, (n > 0).astype(n.dtype))
        row = np.repeat(np.arange(w.rows), many)
        at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + w.bounds[row]
        last = at + np.minimum(size, n[row]) - 1
        spans = zip(start[at].tolist(), end[last].tolist(), strict=True)
        h = np.fromiter((digest(joined[s:e], seed) for s, e in spans), np.uint64, len(at))
        some = np.flatnonzero(many)
        firsts = (np.cumsum(many) - many)[some]
        ones = np.zeros((len(some), 64), np.int64)
        for k in range(8):
            byte = ((h >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
            bits = np.unpackbits(byte[:, None], axis=1, bitorder="little")
            ones[:, 8 * k : 8 * k + 8] = np.add.reduceat(bits, firsts, axis=0, dtype=np.int32)
        on = (2 * ones > many[some][:, None]).astype(np.uint8)
        out[w.first + some] = np.packbits(on, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, seed: int = 42) -> DataFrame:
    """``(id, fp)``: the 64-bit SimHash of every row's whole text, as a signed long.

    A-Z is lower-cased; words are runs without white space; shingles of ``size`` words, repeats
    included, are joined by one space and hashed with XXH64. A bit is set if it is set in more
    than half of the hashes. A text of fewer words is one shingle; an empty or null text has
    fingerprint zero. Null ids and repeated rows are kept; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = _fingerprints(b.column(1), size, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(releasing(run), "id bigint, fp bigint")


def segments(distance: int, count: int = 3, bits: int = 64) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment.

    Two fingerprints within ``distance`` agree up to ``radius`` in at least one segment, as the
    radii plus one add up to more than ``distance``. The narrow segments get the larger radius.
    """
    widths = [bits // count + (i < bits % count) for i in range(count)]
    spare = max(0, distance - count + 1)
    radii = [spare // count + (count - 1 - i < spare % count) for i in range(count)]
    shifts = np.cumsum([0, *widths])[:-1].tolist()
    if distance < count - 1:  # fewer segments are enough
        shifts, widths, radii = (x[: distance + 1] for x in (shifts, widths, radii))
    return list(zip(shifts, widths, radii, strict=True))


def _ball(width: int, radius: int) -> list[int]:
    """All non-zero masks of up to ``radius`` bits."""
    masks = {0}
    for _ in range(radius):
        masks |= {m | (1 << i) for m in masks for i in range(width)}
    return sorted(masks - {0})


def _pairs(group_of: np.ndarray, fps: np.ndarray, own: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between ``own`` rows (indices) and the table rows of the same group.

    ``group_of`` is sorted; rows not in ``own`` are table rows met before.
    """
    table, new = own
    start = np.searchsorted(group_of[table], group_of[new], "left")
    many = np.searchsorted(group_of[table], group_of[new], "right") - start
    done = np.concatenate([[0], np.cumsum(many)])
    at = 0
    while at < len(new):
        to = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, "right")) - 1)
        m = many[at:to]
        left = np.repeat(fps[new[at:to]], m)
        step = np.arange(len(left)) - np.repeat(done[at:to] - done[at], m)
        right = fps[table[np.repeat(start[at:to], m) + step]]
        near = (np.bitwise_count(left ^ right) <= distance) & (left != right)
        if near.any():
            yield left[near], right[near]
        at = to


def _link_cells(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key0 = cell0 = None  # of the group that the last batch ended in
        held = np.zeros(0, np.int64)  # its table rows
        for b in batches:
            if not b.num_rows:
                continue
            key, cell, role, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if key0 is not None and len(held) and (key[0], cell[0]) == (key0, cell0):
                n = len(held)
                key, cell = np.concatenate([np.full(n, key0), key]), np.concatenate([np.full(n, cell0, cell.dtype), cell])
                role, fp = np.concatenate([np.zeros(n, role.dtype), role]), np.concatenate([held, fp])
            else:
                n = 0
            change = np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
            group = np.cumsum(change)
            x = y = np.zeros(0, np.int64)
            for left, right in _pairs(group, fp, (np.flatnonzero(role == 0), np.arange(n, len(fp))), distance):
                x, y = forest(np.concatenate([x, left]), np.concatenate([y, right]))  # no more links than fingerprints
            key0, cell0 = key[-1], cell[-1]
            held = fp[(group == group[-1]) & (role == 0)]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    return run


def near_links(fps: DataFrame, distance: int = 4, segment_count: int = 3) -> DataFrame:
    """Links ``(a, b)`` that join the same fingerprints as all pairs within ``distance`` bits.

    ``fps (fp)`` holds distinct non-null fingerprints in a stored table. Each goes into a table
    by its value in every segment and, as a probe, to all values within the segment's radius;
    rows that meet are verified on all 64 bits, and a task sends on only links enough to join
    what it has joined. Values with more than ``CELL`` table rows are split into cells that each
    hold a part of the table and see all probes, so memory is bounded and no pair is lost.
    """
    def keyed(i: int, value: Column) -> Column:
        return F.lit(i << 32) + value

    values = [
        (i, F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)), width, radius)
        for i, (shift, width, radius) in enumerate(segments(distance, segment_count))
    ]
    own_keys = F.array(*[keyed(i, v) for i, v, _, _ in values])
    ball_keys = F.array(
        *[keyed(i, v.bitwiseXOR(F.lit(m))) for i, v, width, radius in values for m in _ball(width, radius)]
    )
    exact = fps.select(F.explode(own_keys).alias("key"), "fp", F.lit(0).cast("tinyint").alias("role"))
    ball_keys = ball_keys.cast("array<bigint>")
    probes = fps.select(F.explode(ball_keys).alias("key"), "fp", F.lit(1).cast("tinyint").alias("role"))
    spread = exact.unionByName(probes)
    # values with more table rows than a cell holds: at most one for each CELL rows
    hot = cut_lineage(
        exact.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells")).filter("cells > 1")
    )
    placed = spread.join(hot, "key", "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int")
    table, probe = F.lit(0).cast("tinyint"), F.lit(1).cast("tinyint")
    before = F.transform(F.sequence(F.lit(0), own - 1), lambda c: F.struct(c.alias("cell"), probe.alias("role")))
    everywhere = F.transform(F.sequence(F.lit(0), F.col("cells") - 1), lambda c: F.struct(c.alias("cell"), probe.alias("role")))
    mine = F.array(F.struct(own.alias("cell"), table.alias("role")))
    cells = (
        F.when(F.col("role") == 1, everywhere)
        .when(own > 0, F.concat(mine, before))
        .otherwise(mine)
    )
    dealt = placed.select("key", "fp", F.explode(cells).alias("c")).select("key", "c.cell", "c.role", "fp")
    return (
        dealt.repartition("key", "cell")
        .sortWithinPartitions("key", "cell", "role")
        .mapInArrow(releasing(_link_cells(distance)), "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, size: int = 4) -> DataFrame:
    """``(id, fp, component)`` for every row: fingerprint and smallest id reachable over links.

    Documents link when their fingerprints differ in at most ``distance`` bits; equal texts,
    and all empty or null texts, have equal fingerprints and so link. A component with no
    non-null id has a null component. Equal fingerprints are worked on once.
    """
    prints = cut_lineage(fingerprints(docs, id_col, text_col, size))
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("id").alias("low")))
    roots = cut_lineage(components(near_links(distinct.select("fp"), distance)))
    placed = distinct.join(roots.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "low"
    )
    lowest = placed.groupBy("root").agg(F.min("low").alias("component"))
    named = cut_lineage(placed.select("fp", "root").join(lowest, "root").select("fp", "component"))
    return prints.join(named, "fp").select("id", "fp", "component")
