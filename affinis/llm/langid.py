"""Language identification by rank-order n-gram profiles and out-of-place distance."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.llm.text_batch import SLICE, releasing
from affinis.session import cut_lineage

#: N-grams in a profile, of a language and of a document.
PROFILE = 300
#: Languages whose profiles travel to the tasks at once; more make more passes.
BLOCK_LANGUAGES = 4096
#: Characters whose n-grams are counted at once; a run ends at the next non-letter.
RUN_CHARS = 1 << 20
#: Counts that a task merges at once.
MERGE = 1 << 20
UNKNOWN = "und"
_BLANK = 0x20
_NO_LETTER = re.compile(r"[\W\d_]")


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _points(text: str) -> np.ndarray:
    """Code points with every run of non-letters as one blank, also at both ends."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[raw]
    if not letter.any():
        return np.zeros(0, np.uint32)
    first = letter.copy()
    first[1:] |= letter[:-1]  # a letter, or the first non-letter after one
    out = np.where(letter, raw, _BLANK)[first]
    head, tail = out[0] != _BLANK, out[-1] != _BLANK
    return np.concatenate([[_BLANK] * bool(head), out, [_BLANK] * bool(tail)]).astype(np.uint32)


def runs(text: str) -> Iterator[str]:
    """The text in runs of about ``RUN_CHARS``, cut between words."""
    at = 0
    while at < len(text):
        cut = _NO_LETTER.search(text, at + RUN_CHARS) if len(text) - at > RUN_CHARS else None
        to = cut.start() if cut else len(text)
        yield text[at:to]
        at = to


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts of equal codes, in ascending order of code."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    start = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[start], np.add.reduceat(counts, start) if len(codes) else counts


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the n-grams of 1 to 3 characters inside blank-padded words.

    A code packs the code points, 21 bits each. In ascending order of code.
    """
    if len(text) <= RUN_CHARS:
        return _run_counts(text)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for run in runs(text):
        held.append(_run_counts(run))
        if sum(len(codes) for codes, _ in held) > MERGE:
            held = [merge(held)]
    return merge(held)


def _run_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    points = _points(text)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    alphabet, x = np.unique(points, return_inverse=True) if points.max() > 4095 else _small(points)
    size = len(alphabet)
    blank = int(np.searchsorted(alphabet, _BLANK))
    wide = alphabet.astype(np.int64)
    codes, counts = [], []
    for n in (1, 2, 3):
        if len(x) < n:
            break
        local = x[: len(x) - n + 1].astype(np.int64)
        for j in range(1, n):
            local = local * size + x[j : len(x) - n + 1 + j]
        if n == 1:
            local = local[x != blank]
        elif n == 3:
            local = local[x[1:-1] != blank]
        if size**n <= max(1 << 16, 4 * len(local)):
            full = np.bincount(local, minlength=1)
            found = np.flatnonzero(full)
            count = full[found]
        else:
            found, count = np.unique(local, return_counts=True)
        code = np.zeros(len(found), np.int64)
        for j in reversed(range(n)):
            code |= wide[found % size] << (21 * (n - 1 - j))
            found = found // size
        codes.append(code)
        counts.append(count)
    return np.concatenate(codes), np.concatenate(counts)


def _small(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    present = np.flatnonzero(np.bincount(points))
    at = np.zeros(4096, np.int64)
    at[present] = np.arange(len(present))
    return present, at[points]


def _top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties in order of code."""
    if len(codes) > size:
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= floor
        codes, counts = codes[keep], counts[keep]
    return codes[np.argsort(-counts, kind="stable")[:size]]


def profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """``(lang, gram, place)``: the ``size`` most frequent n-grams of each language, 0 first.

    All rows with a text and a language count, whole texts. Texts are lower-cased; n-grams have
    1 to 3 letters of a word, with a blank before and after it; ties go to the smaller code.
    Tasks count runs of texts of bounded size, merge the counts of a language, and send them when
    they have ``MERGE`` n-grams or no more texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[str]] = {}  # texts, below RUN_CHARS for each language
        size: dict[str, int] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str) -> None:
            found = ngram_counts("\n".join(waiting.pop(lang)))
            size[lang] = 0
            sums[lang] = merge([sums[lang], found]) if lang in sums else merge([found])

        def send(lang: str) -> pa.RecordBatch:
            codes, counts = sums.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])

        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                for lang, text in zip(part.column(0).to_pylist(), pc.utf8_lower(part.column(1)), strict=True):
                    waiting.setdefault(lang, []).append(text.as_py())
                    size[lang] = size.get(lang, 0) + len(waiting[lang][-1]) + 1
                    if size[lang] > RUN_CHARS:
                        add(lang)
                        if len(sums[lang][0]) > MERGE:
                            yield send(lang)
            if len(waiting) + len(sums) > BLOCK_LANGUAGES or sum(size.values()) > 8 * RUN_CHARS:
                for lang in list(waiting):
                    add(lang)
                for lang in list(sums):
                    yield send(lang)
        for lang in list(waiting):
            add(lang)
        for lang in list(sums):
            yield send(lang)

    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("t"))
    counted = (
        rows.dropna()
        .mapInArrow(releasing(count), "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counted.withColumn("place", place - 1).filter(F.col("place") < size).select("lang", "gram", "place")


class RankOrder:
    """Language profiles held as one table of places: n-gram by language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size = size
        self.langs = sorted({r[0] for r in rows}, key=lambda x: x.encode())
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.place = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)  # last row: unknown
        column = {x: i for i, x in enumerate(self.langs)}
        for lang, gram, place in rows:
            self.place[np.searchsorted(self.grams, gram), column[lang]] = place

    @classmethod
    def learn(cls, labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> RankOrder | ManyLanguages:
        """Profiles are at most ``size`` rows a language; those of very many stay in a table."""
        stored = cut_lineage(profiles(labelled, text_col, lang_col, size))
        count = stored.select("lang").distinct().count()
        if count > BLOCK_LANGUAGES:
            return ManyLanguages(stored, size, -(-count // BLOCK_LANGUAGES))
        return cls([tuple(r) for r in stored.collect()], size)

    def blocks(self) -> Iterator[RankOrder]:
        yield self

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score). The score is 1 for equal places, 0 if no n-gram is shared."""
        codes, counts = ngram_counts(text or "")
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        top = _top(codes, counts, self.size)
        at = np.searchsorted(self.grams, top)
        at[at < len(self.grams)] += (self.grams[at[at < len(self.grams)]] != top[at < len(self.grams)]) * (1 << 40)
        known = self.place[np.minimum(at, len(self.grams))]
        gap = np.abs(known - np.arange(len(top))[:, None])
        distance = np.where(known < 0, self.size, gap).sum(0)
        best = int(distance.argmin())  # ties go to the first language by code point
        return self.langs[best], 1 - float(distance[best]) / (self.size * len(top))


class ManyLanguages:
    """Profiles of more languages than travel to the tasks at once, in blocks by hash."""

    def __init__(self, stored: DataFrame, size: int, count: int):
        self.stored, self.size, self.count = stored, size, count

    def blocks(self) -> Iterator[RankOrder]:
        for b in range(self.count):
            own = self.stored.filter(F.pmod(F.xxhash64("lang"), F.lit(self.count)) == b)
            yield RankOrder([tuple(r) for r in own.collect()], self.size)  # about BLOCK_LANGUAGES languages


def identify(docs: DataFrame, model: RankOrder | ManyLanguages, keep: list[str], text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` of every row with ``names``, language and score (0 to 1) of its whole text.

    A null text, a text without letters, or a model without languages gives ``und`` and 0; ties
    go to the first language by code point. Rows and other columns are not changed; ``keep`` must
    not hold the two ``names``, which a caller can choose. Every further block of a model with
    very many languages is one more pass that keeps the better of two languages.
    """
    own = text_col in keep and dict(docs.dtypes)[text_col] == "string"  # the text need not travel twice
    text = [] if own else [F.col(text_col).cast("string")]
    found = docs.select(*keep, *text, F.lit(UNKNOWN), F.lit(0.0))
    at, n = keep.index(text_col) if own else len(keep), len(found.columns)
    # inside, columns go by number, so that no name of the table is in the way
    plain = [f"c{i}" for i in range(n)]
    found = found.toDF(*plain)

    def better(block: RankOrder):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lang, score = b.column(n - 2).to_pylist(), b.column(n - 1).to_pylist()
                for i, text in enumerate(pc.utf8_lower(b.column(at))):
                    x, s = block.predict(text.as_py())
                    if s > score[i] or x != UNKNOWN and (lang[i] == UNKNOWN or s == score[i] and x.encode() < lang[i].encode()):
                        lang[i], score[i] = x, s
                columns = [*b.columns[: n - 2], pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, plain)

        return run

    for block in model.blocks():
        found = found.mapInArrow(releasing(better(block)), found.schema)
    return found.select(*[F.col(f"c{i}").alias(x) for i, x in enumerate(keep)], F.col(f"c{n - 2}").alias(names[0]), F.col(f"c{n - 1}").alias(names[1]))
