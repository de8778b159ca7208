"""Top-k items per query by inner product, in blocks.

Queries and items are cut into blocks; Spark shuffles a (query block, item slice) grid
and each cell of the grid is streamed: its queries first, then its items batch by batch.
Only each query's best rows leave a task, so no query-item pair ever becomes a row.
With a ``cell`` column on both sides queries only meet items of the same cell, and large
cells get several blocks and slices of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.functions.vectors import _EPS, l2_normalize, norm
from affinis.session import cut_lineage

QUERY_BLOCK = 16_384
ITEM_SLICE = 262_144
ITEM_CHUNK = 8_192
_STEP = 512  # queries scored at a time

_QUERY, _SKIP, _ITEM = 0, 1, 2


def unit(df: DataFrame) -> DataFrame:
    """Rows whose ``vec`` counts as a unit vector in ``block_topk``.

    Single-precision vectors stay as they are and get their length in ``len``, so that they
    need half the room on the way; others are divided by it.
    """
    if df.schema["vec"].dataType.simpleString() != "array<float>":
        return df.withColumn("vec", l2_normalize("vec"))
    return df.withColumn("len", norm("vec") + F.lit(_EPS))


def block_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int | None = None,
    skip: DataFrame | None = None,
    skip_self: bool = False,
    strict_genre: bool = False,
    digits: int = 9,
    query_block: int = QUERY_BLOCK,
    item_slice: int = ITEM_SLICE,
    item_chunk: int = ITEM_CHUNK,
) -> DataFrame:
    """``(query_id, rank, item_id, score)``: each query's ``k`` best items.

    ``queries``: ``query_id, vec`` and optionally ``cell``, ``k`` (own list length; where it is
    null, and as an upper bound, the argument ``k``; without the argument only the column
    counts and null gives no rows), ``genres``, ``year_min``, ``year_max``, ``skip_key``. ``items``: ``item_id,
    vec`` and optionally ``cell``, ``genres``, ``year``. ``skip``: ``(skip_key, item_id)``
    pairs to leave out of the queries with that key (without a ``skip_key`` column on the
    queries: ``(query_id, item_id)``). A side with a column ``len`` has its vectors divided by it (see ``unit``). Genres filter to items sharing one of them; items without genres
    (null) pass unless ``strict_genre``. Unknown years pass. Scores are rounded to
    ``digits`` and equal scores go to the smaller item id.
    """
    spark = queries.sparkSession
    q_type = queries.schema["query_id"].dataType
    parallel = spark.sparkContext.defaultParallelism
    q, i = (df.withColumn("len", F.coalesce("len", F.lit(float("nan")))) if "len" in df.columns else df for df in (queries, items))
    q = _with_defaults(q, {"len": "double", "cell": "bigint", "k": "int", "genres": "array<string>", "year_min": "int", "year_max": "int"})
    i = _with_defaults(i, {"len": "double", "cell": "bigint", "genres": "array<string>", "year": "int"})
    q = q.withColumn("cell", F.coalesce("cell", F.lit(0).cast("bigint")))
    i = i.withColumn("cell", F.coalesce("cell", F.lit(0).cast("bigint")))
    if "skip_key" not in queries.columns:
        q = q.withColumn("skip_key", F.col("query_id"))
        skip = skip if skip is None else skip.withColumnRenamed("query_id", "skip_key")
    key_type = q.schema["skip_key"].dataType

    # one row per cell: how many query blocks and item slices it gets. Enough tasks for
    # the work, arranged so that the rows copied (queries x slices + items x blocks) are few.
    # Written, so that it is counted once, and that its size tells Spark whether the vectors
    # have to be shuffled to meet it.
    tasks = F.least(F.ceil(F.col("nq") * F.col("ni") / 4_000_000), F.lit(4 * parallel))
    slices = F.least(tasks, F.round(F.sqrt(tasks * F.col("ni") / F.col("nq"))), F.col("ni"))
    grid = cut_lineage(
        q.groupBy("cell").agg(F.count(F.lit(1)).alias("nq"))
        .join(i.groupBy("cell").agg(F.count(F.lit(1)).alias("ni")), "cell")
        .withColumn("s_n", F.greatest(F.ceil(F.col("ni") / item_slice), slices, F.lit(1)).cast("int"))
        .withColumn(
            "g_n", F.greatest(F.ceil(F.col("nq") / query_block), F.ceil(tasks / F.col("s_n")), F.lit(1)).cast("int")
        )
        .select(
            "cell", "g_n", "s_n",
            F.greatest(F.ceil(F.col("ni") / item_chunk), F.lit(1)).cast("int").alias("c_n"),
        )
    )
    q = q.join(grid, "cell")
    i = i.join(grid, "cell")

    def spread(id_col: str, n: str, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), F.col(id_col)), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    # single-precision vectors travel as such and are widened inside the task
    narrow = T.ArrayType(T.FloatType())
    is_narrow = all(df.schema["vec"].dataType.simpleString() == narrow.simpleString() for df in (q, i))
    wide_type = "array<float>" if is_narrow else "array<double>"
    none = {
        "query_id": F.lit(None).cast(q_type), "skip_key": F.lit(None).cast(key_type), "item_id": F.lit(None).cast("bigint"),
        "vec": F.lit(None).cast(wide_type), "len": F.lit(None).cast("double"), "k": F.lit(None).cast("int"),
        "genres": F.lit(None).cast("array<string>"), "year_min": F.lit(None).cast("int"),
        "year_max": F.lit(None).cast("int"), "year": F.lit(None).cast("int"),
    }

    def rows(df: DataFrame, kind: int, g: Column, s: Column, chunk: Column, **columns: Column) -> DataFrame:
        body = [columns.get(c, default).alias(c) for c, default in none.items()]
        base = df.withColumn("g", g) if kind != _ITEM else df.withColumn("s", s)
        base = base.withColumn("s", s) if kind != _ITEM else base.withColumn("g", g)
        return base.select("cell", "g", "s", chunk.alias("chunk"), F.lit(kind).alias("kind"), *body)

    wide = F.col("vec").cast(wide_type)
    parts = rows(
        q, _QUERY, spread("query_id", "g_n", 1), every("s_n"), F.lit(-1),
        query_id=F.col("query_id"), skip_key=F.col("skip_key"), vec=wide, len=F.col("len"), k=F.coalesce("k", F.lit(k or 0)).cast("int"), genres=F.col("genres"),
        year_min=F.col("year_min"), year_max=F.col("year_max"),
    ).unionByName(
        rows(
            i, _ITEM, every("g_n"), spread("item_id", "s_n", 2), spread("item_id", "c_n", 3),
            item_id=F.col("item_id").cast("bigint"), vec=wide, len=F.col("len"), genres=F.col("genres"), year=F.col("year"),
        )
    )
    if skip is not None:
        # a skipped pair goes to the item's slice in each query block its key occurs in
        homes = (
            q.filter(F.col("skip_key").isNotNull())
            .select("skip_key", "cell", spread("query_id", "g_n", 1).alias("_g"), "s_n", "c_n")
            .distinct()
        )
        # pairs with items that are not there have nothing to leave out
        there = i.select(F.col("item_id").cast("bigint").alias("item_id")).distinct()
        pairs = skip.select("skip_key", F.col("item_id").cast("bigint").alias("item_id")).join(there, "item_id", "left_semi")
        pairs = pairs.join(homes, "skip_key")
        parts = parts.unionByName(
            rows(
                pairs, _SKIP, F.col("_g"), spread("item_id", "s_n", 2), spread("item_id", "c_n", 3),
                skip_key=F.col("skip_key"), item_id=F.col("item_id"),
            )
        )
    grouped = parts.repartition("cell", "g", "s").sortWithinPartitions("cell", "g", "s", "chunk", "kind")
    out = T.StructType([
        T.StructField("query_id", q_type), T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()), T.StructField("k", T.IntegerType()),
    ])
    found = grouped.mapInArrow(_scorer(skip_self, strict_genre, digits), out)
    if "cell" in queries.columns:
        # a query may visit several cells, and an item may sit in several
        found = found.groupBy("query_id", "item_id").agg(F.max("score").alias("score"), F.max("k").alias("k"))
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
    ranked = found.withColumn("rank", F.row_number().over(w))
    if k is not None:
        ranked = ranked.filter(F.col("rank") <= k)
    return ranked.filter(F.col("rank") <= F.col("k")).select("query_id", "rank", "item_id", "score")


def _with_defaults(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(
        "*", *[F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in df.columns]
    )


def _matrix(rows: pa.RecordBatch) -> np.ndarray:
    vec = rows.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(rows.num_rows, -1)
    if "len" not in rows.schema.names or rows.column("len").null_count == rows.num_rows:
        return vec
    return vec / _numbers(rows.column("len"), 1.0)[:, None]


def _numbers(column: pa.Array, missing: float) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(missing).to_numpy(zero_copy_only=False)


class _GridCell:
    """Queries of one grid cell and the best rows found for them so far."""

    def __init__(self, skip_self: bool, strict_genre: bool, digits: int) -> None:
        self.skip_self, self.strict_genre, self.digits = skip_self, strict_genre, digits
        self.query_parts: list[pa.RecordBatch] = []
        self.index: pd.Index | None = None
        self.skip_chunk = None
        self.skips: list[tuple[np.ndarray, np.ndarray]] = []  # (key number, item id)
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def _prepare(self) -> None:
        if self.index is not None or not self.query_parts:
            return
        t = pa.Table.from_batches(self.query_parts).combine_chunks()
        t = t.sort_by([("year_min", "ascending"), ("year_max", "ascending")])
        self.ids = t.column("query_id").combine_chunks()
        self.index = pd.Index(self.ids.to_pandas())
        self.key_of, keys = pd.factorize(t.column("skip_key").to_pandas())
        self.keys = pd.Index(keys)
        self.vec = _matrix(t.combine_chunks().to_batches()[0])
        self.k = t.column("k").to_numpy()
        self.floor = np.full(len(self.k), -np.inf)
        self.low = _numbers(t.column("year_min").combine_chunks(), -np.inf)
        self.high = _numbers(t.column("year_max").combine_chunks(), np.inf)
        wanted = [tuple(g) if g else None for g in t.column("genres").to_pylist()]
        # queries asking for the same genres and years share one filter
        codes: dict[tuple, int] = {}
        self.filter_of = np.array(
            [codes.setdefault(f, len(codes)) for f in zip(wanted, self.low.tolist(), self.high.tolist())],
            np.int64,
        )
        self.filters = list(codes)
        self.open = codes.get((None, -np.inf, np.inf), -1)

    def add_skips(self, part: pa.RecordBatch) -> None:
        self._prepare()
        chunk = part.column("chunk")[0].as_py()
        if chunk != self.skip_chunk:
            self.skip_chunk, self.skips = chunk, []
        rows = self.keys.get_indexer(part.column("skip_key").to_pandas())
        items = part.column("item_id").to_numpy()
        self.skips.append((rows[rows >= 0], items[rows >= 0]))

    def add_items(self, part: pa.RecordBatch) -> None:
        self._prepare()
        if self.index is None:
            return
        chunk = part.column("chunk")[0].as_py()
        ids = part.column("item_id").to_numpy()
        vec = _matrix(part)
        filtered = (self.filter_of != self.open).any()
        year = _numbers(part.column("year"), np.nan) if filtered else None
        has = self._genre_rows(part) if filtered else None
        skip_r = skip_c = np.zeros(0, np.int64)
        if self.skip_chunk == chunk and self.skips:
            where = pd.Index(ids).get_indexer(np.concatenate([s[1] for s in self.skips]))
            skip_r = np.concatenate([s[0] for s in self.skips])[where >= 0]
            skip_c = where[where >= 0]
            order = np.argsort(skip_r, kind="stable")
            skip_r, skip_c = skip_r[order], skip_c[order]
        for s in range(0, len(self.k), _STEP):
            e = min(s + _STEP, len(self.k))
            score = self.vec[s:e] @ vec.T  # rounded where it may count
            if len(skip_r):
                keys = self.key_of[s:e]
                first = np.searchsorted(skip_r, keys, "left")
                count = np.searchsorted(skip_r, keys, "right") - first
                rows = np.repeat(np.arange(e - s), count)
                run = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
                score[rows, skip_c[np.repeat(first, count) + run]] = -np.inf
            if self.skip_self:
                own = pd.Index(ids).get_indexer(self.index[s:e])
                rows = np.flatnonzero(own >= 0)
                score[rows, own[rows]] = -np.inf
            if filtered:
                used, which = np.unique(self.filter_of[s:e], return_inverse=True)
                masks = np.stack([self._passes(f, year, has) for f in used])
                score[~masks[which]] = -np.inf
            self._keep(score, s, ids)

    def _genre_rows(self, part: pa.RecordBatch) -> tuple[dict[str, np.ndarray], np.ndarray]:
        genres = part.column("genres")
        counts = np.nan_to_num(_numbers(genres.value_lengths(), 0)).astype(np.int64)
        rows = np.repeat(np.arange(len(genres)), counts)
        names = genres.flatten().to_pandas()
        by_name = {name: rows[at] for name, at in names.groupby(names).indices.items()}
        return by_name, genres.is_null().to_numpy(zero_copy_only=False)

    def _passes(self, code: int, year: np.ndarray, has) -> np.ndarray:
        """Items of this batch that pass one filter."""
        if code == self.open:
            return np.ones(len(year), bool)
        wanted, low, high = self.filters[code]
        ok = np.isnan(year) | ((year >= low) & (year <= high))
        if wanted is not None:
            by_name, featureless = has
            match = np.zeros(len(ok), bool) if self.strict_genre else featureless.copy()
            for name in wanted:
                match[by_name.get(name, [])] = True
            ok &= match
        return ok

    def _keep(self, score: np.ndarray, s: int, ids: np.ndarray) -> None:
        top = int(self.k[s : s + len(score)].max())
        if top <= 0:
            return
        bar = self.floor[s : s + len(score)]
        fresh = np.flatnonzero(bar == -np.inf)
        if score.shape[1] > top and len(fresh):
            # the k-th best of this block: rows below it cannot be in the final list; later
            # blocks are held against it without looking for a k-th best of their own
            at = score.shape[1] - top
            part = score[fresh]
            part[np.isnan(part)] = -np.inf  # never counts
            part.partition(at, axis=1)
            bar[fresh] = np.round(part[:, at], self.digits)
        # as low as a score may be that rounds to the bar
        low = bar - 10.0**-self.digits - np.abs(np.where(np.isinf(bar), 0.0, bar)) * 1e-14
        r, c = np.divmod(np.flatnonzero(score >= low[:, None]), score.shape[1])
        v = np.round(score[r, c], self.digits)
        keep = (v >= bar[r]) & (v > -np.inf)
        r, v = r[keep], v[keep]
        self.best.append((r + s, v, ids[c[keep]]))
        self.held += len(r)
        if self.held > 2 * int(self.k.sum()) + 1_000_000:
            self._cut()

    def _cut(self) -> None:
        if not self.best:
            return
        r, v, i = (np.concatenate(x) for x in zip(*self.best))
        order = np.lexsort((i, -v, r))
        r, v, i = r[order], v[order], i[order]
        starts = np.searchsorted(r, np.arange(len(self.k)))
        rank = np.arange(len(r)) - starts[r]
        last = rank == self.k[r] - 1
        self.floor[r[last]] = v[last]
        keep = rank < self.k[r]
        self.best = [(r[keep], v[keep], i[keep])]
        self.held = int(keep.sum())

    def result(self) -> Iterator[pa.RecordBatch]:
        self._prepare()
        self._cut()
        if self.best and self.held:
            r, v, i = self.best[0]
            yield pa.RecordBatch.from_arrays(
                [self.ids.take(pa.array(r)), pa.array(i), pa.array(v), pa.array(self.k[r].astype(np.int32))],
                names=["query_id", "item_id", "score", "k"],
            )


def _scorer(skip_self: bool, strict_genre: bool, digits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            marks = np.stack([batch.column(c).to_numpy() for c in ("cell", "g", "s", "chunk", "kind")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            edges = np.concatenate([[0], cuts, [batch.num_rows]])
            for s, e in zip(edges[:-1], edges[1:]):
                here = tuple(marks[:3, s])
                if here != key:
                    if cell is not None:
                        yield from cell.result()
                    key, cell = here, _GridCell(skip_self, strict_genre, digits)
                part = batch.slice(s, e - s)
                kind = marks[4, s]
                if kind == _QUERY:
                    cell.query_parts.append(part)
                elif kind == _SKIP:
                    cell.add_skips(part)
                else:
                    cell.add_items(part)
        if cell is not None:
            yield from cell.result()

    return run
