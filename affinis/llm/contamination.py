"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.text_batch import Words, mix, shingle_hashes, word_hashes, words
from affinis.session import cut_lineage

#: Share of an item's words that may be edited, least words of an item, sampled places of a key,
#: share of matches that the keys must reach.
EDITS, LEAST, SAMPLED, RECALL = 0.2, 5, 2, 0.99
#: Windows embedded at once in a task.
AT_ONCE = 1000
#: Bits of the filter that tasks get, whatever the number of items, as a power of two.
FILTER = 24

# words are runs of letters, digits and non-ASCII characters
BREAKS = np.ones(256, bool)
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def edits_allowed(n: int) -> int:
    return int(EDITS * n + 1e-9)


def blocks(n: int) -> tuple[int, list[int]]:
    """(words of a block, offsets): of so many blocks, one must be unedited in any match.

    An item is cut into one part more than edits are allowed, so one part has none; a block is
    the beginning of its part.
    """
    parts = edits_allowed(n) + 1
    return n // parts, [i * n // parts for i in range(parts)]


def embed(tokens: np.ndarray, sizes: np.ndarray, places: np.ndarray, seed: int) -> np.ndarray:
    """Values of the CGK embedding of padded rows of ``tokens`` at ``places`` (row by column).

    The walk writes the token it stands on and steps on if a random bit of that token and step
    is set; three steps a token. Equal stretches keep two walks together and unequal ones drift
    back together, so few edits change few values. ``places`` are sorted in each row.
    """
    rows = np.arange(len(tokens))
    at = np.zeros(len(tokens), np.int64)
    out = np.zeros(places.shape, np.uint64)
    column = np.zeros(len(tokens), np.int64)
    last = int(places.max(initial=-1))
    with np.errstate(over="ignore"):
        for step in range(last + 1):
            inside = at < sizes
            now = np.where(inside, tokens[rows, np.minimum(at, tokens.shape[1] - 1)], np.uint64(0))
            while True:
                due = (column < places.shape[1]) & (places[rows, np.minimum(column, places.shape[1] - 1)] == step)
                if not due.any():
                    break
                out[rows[due], column[due]] = now[due]
                column[due] += 1
            bit = mix(now ^ (np.uint64(seed * 1_000_003 + step) * _GOLD)) & np.uint64(1)
            at += inside & (bit == 1)
    return out


def lsh_keys(tokens: np.ndarray, sizes: np.ndarray, repetitions: int) -> np.ndarray:
    """One key for each row and repetition, each with its own walk and sample of places.

    Rows of equal length have the same places, so that windows of an item's size meet it.
    """
    out = np.zeros((len(tokens), repetitions), np.uint64)
    for r in range(repetitions):
        share = np.sort(mix(np.arange(1, SAMPLED + 1, dtype=np.uint64) * np.uint64(77 + r)) >> np.uint64(11)).astype(float) / (1 << 53)
        places = (share[None, :] * (3 * sizes)[:, None]).astype(np.int64)
        values = embed(tokens, sizes, places, r + 1)
        key = mix(np.full(len(tokens), r + 1, np.uint64) * _GOLD ^ sizes.astype(np.uint64))
        for k in range(SAMPLED):
            key = mix(key * _GOLD + values[:, k])
        out[:, r] = key
    return out


@cache
def repetitions_needed(recall: float = RECALL, size: int = 40, trials: int = 400) -> int:
    """Repetitions that find matches at the largest allowed distance with this probability.

    The chance that one key agrees is measured on random sequences with random substitutions,
    insertions and deletions.
    """
    rng = np.random.default_rng(11)
    x = rng.integers(1, 2**63, (trials, size)).astype(np.uint64)
    y = np.zeros_like(x)
    for i in range(trials):
        row = x[i].tolist()
        for _ in range(edits_allowed(size)):
            at, kind = int(rng.integers(len(row))), int(rng.integers(3))
            if kind == 0:
                row[at] = int(rng.integers(1, 2**63))
            elif kind == 1:
                row.insert(at, int(rng.integers(1, 2**63)))
            else:
                del row[at]
        row = (row + [0] * size)[:size]
        y[i] = np.array(row, np.uint64)
    sizes = np.full(trials, size)
    agree = (lsh_keys(x, sizes, 8) == lsh_keys(y, sizes, 8)).mean()
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def edit_match(item: list[str], text: list[str], limit: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the part of ``text`` nearest to ``item``, if within ``limit``.

    Ties go to the first end, then to the shortest part.
    """
    ids: dict[str, int] = {}
    a = np.array([ids.setdefault(x, len(ids)) for x in item])
    b = np.array([ids.setdefault(x, len(ids)) for x in text])
    ends = _distances(a, b, True)
    end = int(ends.argmin())
    if ends[end] > limit:
        return None
    starts = _distances(a[::-1], b[:end][::-1], False)
    back = int(starts.argmin())
    return int(ends[end]), end - back, end


def _distances(a: np.ndarray, b: np.ndarray, anywhere: bool) -> np.ndarray:
    """Edit distance of ``a`` to parts of ``b`` by their end; parts begin anywhere, or at 0."""
    places = np.arange(len(b) + 1)
    row = np.zeros(len(b) + 1, np.int64) if anywhere else places.copy()
    for i, x in enumerate(a):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (b != x))
        row = np.minimum.accumulate(new - places) + places
    return row


def _tokens(w: Words, at: int, to: int) -> str:
    return " ".join(bytes(w.data[s:e]).decode(errors="replace") for s, e in zip(w.start[at:to].tolist(), w.end[at:to].tolist(), strict=True))


def _item_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["item", "t", "n", "q", "offset", "h"]
    for b in batches:
        out: list[tuple] = []
        for w in words(b.column(1), breaks=BREAKS):
            hashes = word_hashes(w)
            grams = {}
            for r in range(w.rows):
                first, end = int(w.bounds[r]), int(w.bounds[r + 1])
                if (n := end - first) < LEAST:
                    continue
                q, offsets = blocks(n)
                if q not in grams:
                    h, at = shingle_hashes(w, hashes, q)
                    grams[q] = dict(zip(at.tolist(), h.view(np.int64).tolist(), strict=True))
                t = _tokens(w, first, end)
                out += [(b.column(0)[w.first + r].as_py(), t, n, q, o, grams[q][first + o]) for o in offsets]
        if out:
            types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


def _hits(sizes: list[int], bits: np.ndarray, reach: int):
    """Places where a document may hold an unedited block, with the words around them."""
    names = ["doc", "p", "h", "first", "t"]
    mask = np.uint64((1 << FILTER) - 1)

    def marked(h: np.ndarray, shift: int) -> np.ndarray:
        at = (h >> np.uint64(shift)) & mask
        return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in words(b.column(1), breaks=BREAKS):
                hashes = word_hashes(w)
                out: list[tuple] = []
                for q in sizes:
                    h, at = shingle_hashes(w, hashes, q)
                    some = marked(h, 64 - FILTER)
                    h, at = h[some], at[some]
                    some = marked(h, 8)
                    for x, i in zip(h[some].view(np.int64).tolist(), at[some].tolist(), strict=True):
                        row = int(w.row[i])
                        low, high = int(w.bounds[row]), int(w.bounds[row + 1])
                        first, end = max(low, i - reach), min(high, i + reach)
                        out.append((b.column(0)[w.first + row].as_py(), i - low, x, first - low, _tokens(w, first, end)))
                if out:
                    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
        pa.default_memory_pool().release_unused()

    return run


def _padded(rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of rows of words, padded, and the rows' sizes."""
    sizes = np.array([len(r) for r in rows], np.int64)
    out = np.zeros((len(rows), max(1, int(sizes.max(initial=0)))), np.uint64)
    flat = pa.array([" ".join(r) for r in rows])
    for w in words(flat, breaks=BREAKS):
        h = word_hashes(w)
        out[w.first + w.row, np.arange(len(h)) - w.bounds[w.row]] = h
    return out, sizes


def _windows(repetitions: int):
    """Item-sized windows with their keys, and the words that an aligned match can reach."""
    names = ["doc", "start", "region", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(i, AT_ONCE) for x in batches for i in range(0, x.num_rows, AT_ONCE)):
            docs, starts, sizes, firsts, texts = (b.column(i).to_pylist() for i in range(5))
            windows, out = [], []
            for doc, start, n, first, t in zip(docs, starts, sizes, firsts, texts, strict=True):
                parts, d = t.split(" "), edits_allowed(n)
                low, high = max(0, start - d - first), min(len(parts), start + n + d - first)
                window = parts[max(0, start - first) : max(0, start - first) + n]
                if len(window) < n:  # at the end of a text: the last words of the right number
                    window = parts[max(0, len(parts) - n) :]
                window += ["0"] * (n - len(window))
                windows.append(window)
                out.append((doc, first + low, " ".join(parts[low:high])))
            if out:
                keys = lsh_keys(*_padded(windows), repetitions).view(np.int64)
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2]), pa.array(list(keys), pa.list_(pa.int64()))],
                    names,
                )

    return run


def _item_keys(repetitions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(i, AT_ONCE) for x in batches for i in range(0, x.num_rows, AT_ONCE)):
            if b.num_rows:
                keys = lsh_keys(*_padded([t.split(" ") for t in b.column(1).to_pylist()]), repetitions).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(keys), pa.list_(pa.int64()))], ["item", "t", "keys"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "item", "distance", "start", "end"]
    for b in batches:
        out: list[tuple] = []
        for doc, start, region, item, t in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            words_of_item = t.split(" ")
            found = edit_match(words_of_item, region.split(" "), edits_allowed(len(words_of_item)))
            if found:
                out.append((doc, item, found[0], start + found[1], start + found[2]))
        if out:
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
    pa.default_memory_pool().release_unused()


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc, item, distance, start, end)``: every place where a document holds an item.

    Words are runs of letters and digits, A-Z lower-cased. A part of a document matches if it
    is within ``EDITS`` times the item's words by edit distance over words. Places that hold none
    of the item's blocks cannot match (see ``blocks``) and are passed over by a filter of fixed
    size; around the others, item-sized windows and the items are embedded and meet if one of
    their sampled keys agrees, which at the largest distance happens with probability ``RECALL``;
    the edit distance of those that meet is then worked out. A match can be reported at several
    nearby places. Items of under ``LEAST`` words, null texts and null items match nothing; null
    ids are reported as null; repeated rows are reported once; other columns are ignored.
    """
    repetitions = repetitions_needed()
    item_rows = items.select(F.col(item_col).cast("bigint").alias("item"), F.col(item_text_col).cast("string").alias("t"))
    cut = cut_lineage(item_rows.dropna().mapInArrow(_item_blocks, "item bigint, t string, n int, q int, offset int, h bigint"))
    shape = cut.agg(F.collect_set("q").alias("q"), F.max("n").alias("n")).first()  # a few numbers
    mask = (1 << FILTER) - 1
    places = F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(F.lit(mask)) for s in (64 - FILTER, 8)])
    packed = (
        cut.select(F.explode(places).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    )
    bits = np.zeros(1 << (FILTER - 6), np.int64)  # the filter's size does not depend on the items
    for r in packed.collect():
        bits[r.word] = r.bits
    reach = (shape.n or 0) + edits_allowed(shape.n or 0) + 1
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("string").alias("t"))
    hits = cut_lineage(
        rows.filter("t IS NOT NULL").mapInArrow(
            _hits(sorted(shape.q or []), bits.view(np.uint64), reach), "doc bigint, p int, h bigint, first int, t string"
        )
    )
    starts = cut_lineage(cut.select("h", "n", "offset").distinct())
    windows = cut_lineage(
        hits.join(starts, "h")
        .select("doc", (F.col("p") - F.col("offset")).alias("start"), "n", "first", "t")
        .dropDuplicates(["doc", "start", "n", "t"])
        .mapInArrow(_windows(repetitions), "doc bigint, start int, region string, keys array<bigint>")
        .withColumn("window", F.xxhash64("doc", "start", "region"))
    )
    keyed = cut_lineage(cut.select("item", "t").distinct().mapInArrow(_item_keys(repetitions), "item bigint, t string, keys array<bigint>"))
    met = (
        windows.select("window", F.explode("keys").alias("key"))
        .join(keyed.select("item", "t", F.explode("keys").alias("key")), "key")
        .select("window", "item", "t")
        .distinct()
    )
    return (
        windows.select("window", "doc", "start", "region")
        .distinct()
        .join(met, "window")
        .select("doc", "start", "region", "item", "t")
        .mapInArrow(_verify, "doc bigint, item bigint, distance int, start int, end int")
        .distinct()
    )
