"""Item-to-item cosine similarity as a blocked sparse product.

``X'X`` is computed over pairs of item blocks. A user's items are grouped by block and
a user's blocks, not its items, are paired up; Spark shuffles those block cells to
(block, block, user chunk) groups. A group is streamed batch by batch and adds into one
fixed-size array, so neither a long history nor a popular item makes any task hold an
unbounded group: histories are cut by block, popular blocks are cut into user chunks.

Where users have few items in a block, as with many items and short histories, the blocks
would be nearly empty and their pairs grow with the square of the items. Then each user's
pairs of items become rows, which Spark sums: as many as the histories have pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.session import cut_lineage

BLOCK_ITEMS = 2048
CHUNK_ROWS = 4_000_000
_PAIR_STEP = 2_000_000  # item pairs expanded at a time inside a task
#: Longest history whose pairs may become rows, and how many such rows a pair of block cells is worth.
PAIRED_HISTORY, CELL_ROWS = 4096, 8
#: Neighbours of an item that travel in one row.
LIST_EDGES = 256

_PARTIAL_SCHEMA = "item_i bigint, item_j bigint, dot double, norm2 double"


def item_item_fit(
    matrix: DataFrame,
    k_neighbors: int | None = 50,
    min_similarity: float = 0.0,
    user: str = "user_idx",
    item: str = "item_idx",
    value: str = "value",
    block_items: int = BLOCK_ITEMS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Neighbour edges ``(item_i, item_j, sim)`` of a long-form interaction matrix.

    ``sim`` is the cosine of the two item columns; self pairs and zero similarities give
    no edge, similarities below ``min_similarity`` are dropped when it is positive, and
    each item keeps its ``k_neighbors`` best (ties: smaller id first; None keeps all).
    The matrix must hold one row per (user, item).
    """
    cells = matrix.select(
        F.col(user).cast("bigint").alias("u"),
        F.col(item).cast("bigint").alias("i"),
        F.col(value).cast("double").alias("v"),
    )
    # one row per item, used by every later step
    norms = cut_lineage(_item_norms(cells))
    blocks = max(1, -(-norms.count() // block_items))
    if _sparse(cells, blocks):
        sims = _pair_sims(cells, norms)
        if min_similarity > 0:
            sims = sims.filter(F.col("sim") >= min_similarity)
        return sims if k_neighbors is None else topk_neighbors(sims, k_neighbors)
    placed = cut_lineage(_place_items(norms, blocks, chunk_rows))
    whole = placed.filter("chunks > 1").isEmpty()
    entries = (
        cells.join(placed, "i")
        .groupBy("u", "block")
        .agg(
            # at most `block_items`-ish entries: one user, one block of items
            F.collect_list(F.struct("local", "i", "v", "n2")).alias("cell"),
            F.first("chunks").alias("chunks"),
        )
    )
    # one number per block a user touches; never longer than the number of blocks
    touched = entries.groupBy("u").agg(F.collect_list(F.struct("block", "chunks")).alias("touched"))
    # pairs of blocks as numbers first; the cells then come by user and block, so that the
    # blocks of a user with a long history are spread over tasks
    both = touched.select("u", F.explode("touched.block").alias("block"), "touched").select(
        "u", "block", F.explode("touched").alias("t")
    )
    pairs = both.join(entries, ["u", "block"]).select("u", "block", "chunks", "cell", "t")
    chunk_count = F.greatest(F.col("chunks"), F.col("t.chunks"))
    pairs = pairs.select(
        F.least("block", "t.block").alias("a"),
        F.greatest("block", "t.block").alias("b"),
        chunk_count.alias("s_n"),
        F.pmod(F.xxhash64("u"), chunk_count).cast("int").alias("s"),
        "u",
        # 0: the cell belongs to block a; 1: to block b; 0 also on the diagonal
        F.when(F.col("block") <= F.col("t.block"), 0).otherwise(1).alias("side"),
        "cell",
    )
    grouped = pairs.repartition("a", "b", "s").sortWithinPartitions("a", "b", "s", "u", "side")
    partial = grouped.mapInArrow(_block_products(k_neighbors, min_similarity), _PARTIAL_SCHEMA)
    if not whole:
        # blocks cut into user chunks left partial sums
        partial = partial.groupBy("item_i", "item_j").agg(
            F.sum("dot").alias("dot"), F.first("norm2").alias("norm2")
        )
    sims = (
        partial.select("item_i", "item_j", (F.col("dot") / F.sqrt("norm2")).alias("sim"))
        .filter(F.col("sim") != 0)
    )
    if min_similarity > 0:
        sims = sims.filter(F.col("sim") >= min_similarity)
    return sims if k_neighbors is None else topk_neighbors(sims, k_neighbors)


def topk_neighbors(sims: DataFrame, k: int) -> DataFrame:
    """The ``k`` most similar neighbours of each item (Spark prunes before the shuffle)."""
    w = W.partitionBy("item_i").orderBy(F.desc("sim"), "item_j")
    return sims.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def _item_norms(cells: DataFrame) -> DataFrame:
    return cells.groupBy("i").agg(
        F.sum(F.col("v") * F.col("v")).alias("n2"), F.count(F.lit(1)).alias("rows")
    )


def _sparse(cells: DataFrame, blocks: int) -> bool:
    """Whether rows for pairs of items are fewer than the work on pairs of block cells."""
    lengths = cells.filter("u IS NOT NULL AND i IS NOT NULL").groupBy("u").agg(F.count(F.lit(1)).cast("double").alias("n"))
    touched = F.least("n", F.lit(float(blocks)))
    row = lengths.agg(
        F.max("n").alias("longest"), F.sum(F.col("n") * F.col("n")).alias("pairs"), F.sum(touched * touched).alias("met")
    ).first()
    return row.longest is not None and row.longest <= PAIRED_HISTORY and row.pairs <= CELL_ROWS * row.met


def _pair_sims(cells: DataFrame, norms: DataFrame) -> DataFrame:
    """Nonzero similarities in both directions, from one row for each pair of a user's items."""
    known = cells.join(norms.select("i", "n2"), "i")
    left = known.select("u", F.col("i").alias("item_i"), F.col("v").alias("a"), F.col("n2").alias("n_i"))
    right = known.select("u", F.col("i").alias("item_j"), F.col("v").alias("b"), F.col("n2").alias("n_j"))
    dots = (
        left.join(right, "u")
        .filter(F.col("item_i") < F.col("item_j"))
        .groupBy("item_i", "item_j")
        .agg(F.sum(F.col("a") * F.col("b")).alias("dot"), F.first("n_i").alias("n_i"), F.first("n_j").alias("n_j"))
        .filter(F.col("dot") != 0)
    )
    half = dots.select("item_i", "item_j", (F.col("dot") / F.sqrt(F.col("n_i") * F.col("n_j"))).alias("sim"))
    # both directions of a row at once, so that the sums are made once
    ends = F.array(F.struct("item_i", "item_j"), F.struct(F.col("item_j").alias("item_i"), F.col("item_i").alias("item_j")))
    return half.select(F.explode(ends).alias("e"), "sim").select("e.item_i", "e.item_j", "sim").filter(F.col("sim") != 0)


def _place_items(norms: DataFrame, blocks: int, chunk_rows: int) -> DataFrame:
    """Per item: block, place inside the block, squared norm, and user chunks of the block."""
    by_block = W.partitionBy("block")
    return (
        norms.withColumn("block", F.pmod(F.xxhash64("i"), F.lit(blocks)).cast("int"))
        .withColumn("local", (F.row_number().over(by_block.orderBy("i")) - 1).cast("int"))
        .withColumn("load", F.sum("rows").over(by_block))
        .select(
            "i", "block", "local", "n2",
            F.greatest(F.ceil(F.col("load") / chunk_rows), F.lit(1)).cast("int").alias("chunks"),
        )
    )


class _Side:
    """Ids and squared norms of one block's items, filled as they are met."""

    def __init__(self) -> None:
        self.ids = np.zeros(0, np.int64)
        self.n2 = np.zeros(0)

    def note(self, local: np.ndarray, ids: np.ndarray, n2: np.ndarray) -> None:
        if len(local):
            short = int(local.max()) + 1 - len(self.ids)
            if short > 0:
                self.ids = np.concatenate([self.ids, np.zeros(short, np.int64)])
                self.n2 = np.concatenate([self.n2, np.zeros(short)])
            self.ids[local] = ids
            self.n2[local] = n2


class _BlockPair:
    """Running ``X_a' X_b`` of one (block, block, user chunk) group."""

    def __init__(self, diagonal: bool) -> None:
        self.diagonal = diagonal
        self.a = _Side()
        self.b = self.a if diagonal else _Side()
        self.acc = np.zeros((0, 0))

    def add(self, left, right) -> None:
        """``left``/``right``: (lengths per user, local, ids, v, n2) with users aligned."""
        self.a.note(left[1], left[2], left[4])
        if not self.diagonal:
            self.b.note(right[1], right[2], right[4])
        self._grow()
        per_user = left[0] * right[0]
        width = max(1, self.acc.shape[0] * self.acc.shape[1])
        if per_user.sum() > len(per_user) * width / 200:
            self._add_dense(left, right)
        else:
            self._add_sparse(left, right, per_user)

    def _grow(self) -> None:
        shape = (len(self.a.ids), len(self.b.ids))
        if self.acc.shape != shape:
            bigger = np.zeros(shape)
            bigger[: self.acc.shape[0], : self.acc.shape[1]] = self.acc
            self.acc = bigger

    def _add_dense(self, left, right) -> None:
        step = 512
        l_end, r_end = np.cumsum(left[0]), np.cumsum(right[0])
        for s in range(0, len(left[0]), step):
            e = min(s + step, len(left[0]))
            xa = _densify(left, l_end, s, e, self.acc.shape[0])
            xb = xa if self.diagonal else _densify(right, r_end, s, e, self.acc.shape[1])
            self.acc += xa.T @ xb

    def _add_sparse(self, left, right, per_user: np.ndarray) -> None:
        l_end, r_end, p_end = np.cumsum(left[0]), np.cumsum(right[0]), np.cumsum(per_user)
        s = 0
        while s < len(per_user):
            base = p_end[s - 1] if s else 0
            e = max(s + 1, int(np.searchsorted(p_end, base + _PAIR_STEP, "right")))
            l0 = l_end[s - 1] if s else 0
            r0 = r_end[s - 1] if s else 0
            # every left entry of a user meets every right entry of the same user
            reps = np.repeat(right[0][s:e], left[0][s:e])
            starts = np.repeat((r_end - right[0])[s:e], left[0][s:e])
            li = np.repeat(np.arange(l0, l_end[e - 1]), reps)
            run = np.cumsum(reps) - reps
            ri = np.arange(len(li)) - np.repeat(run, reps) + np.repeat(starts, reps)
            assert r0 <= ri.min() and ri.max() < r_end[e - 1]
            flat = left[1][li].astype(np.int64) * self.acc.shape[1] + right[1][ri]
            self.acc += np.bincount(
                flat, weights=left[3][li] * right[3][ri], minlength=self.acc.size
            ).reshape(self.acc.shape)
            s = e

    def edges(self, k: int | None, min_sim: float, complete: bool) -> Iterator[pa.RecordBatch]:
        """Nonzero cells in both directions. A complete group keeps only each item's best ``k``."""
        if self.acc.size == 0:
            return
        if self.diagonal:
            np.fill_diagonal(self.acc, 0.0)
        yield from _emit(self.acc, self.a, self.b, k if complete else None, min_sim if complete else 0.0)
        if not self.diagonal:
            yield from _emit(self.acc.T, self.b, self.a, k if complete else None, min_sim if complete else 0.0)


def _densify(side, ends: np.ndarray, s: int, e: int, width: int) -> np.ndarray:
    first = ends[s - 1] if s else 0
    rows = np.repeat(np.arange(e - s), side[0][s:e])
    x = np.zeros((e - s, width))
    x[rows, side[1][first : ends[e - 1]]] = side[3][first : ends[e - 1]]
    return x


def _emit(acc, rows: _Side, cols: _Side, k: int | None, min_sim: float) -> Iterator[pa.RecordBatch]:
    step = max(1, 1_000_000 // max(1, acc.shape[1]))
    for s in range(0, acc.shape[0], step):
        part = acc[s : s + step]
        r, c = np.nonzero(part)
        d = part[r, c]
        i, j = rows.ids[s + r], cols.ids[c]
        norm2 = rows.n2[s + r] * cols.n2[c]
        if k is not None and len(d):
            sim = d / np.sqrt(norm2)
            order = np.lexsort((j, -sim, r))
            starts = np.searchsorted(r[order], np.arange(part.shape[0]))
            rank = np.arange(len(order)) - starts[r[order]]
            keep = order[(rank < k) & (sim[order] >= min_sim if min_sim > 0 else True)]
            i, j, d, norm2 = i[keep], j[keep], d[keep], norm2[keep]
        if len(d):
            yield pa.RecordBatch.from_arrays(
                [pa.array(i), pa.array(j), pa.array(d), pa.array(norm2)],
                names=["item_i", "item_j", "dot", "norm2"],
            )


def _take(cells: pa.Array, wanted: np.ndarray):
    """Flatten the chosen rows' cells: lengths per row, then aligned entry columns."""
    part = cells.take(pa.array(wanted))
    flat = part.flatten()
    lengths = np.diff(part.offsets.to_numpy())
    return (
        lengths,
        flat.field("local").to_numpy(),
        flat.field("i").to_numpy(),
        flat.field("v").to_numpy(),
        flat.field("n2").to_numpy(),
    )


def _block_products(k: int | None, min_sim: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pair, complete = None, None, True
        carry: pa.RecordBatch | None = None
        for batch in batches:
            if carry is not None:
                # a user's second cell may open the next batch
                batch = pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
                carry = None
            if batch.num_rows == 0:
                continue
            a, b, s, s_n, side = (
                batch.column(c).to_numpy() for c in ("a", "b", "s", "s_n", "side")
            )
            n = len(a)
            if a[-1] != b[-1] and side[-1] == 0:
                carry, n = batch.slice(n - 1), n - 1
            cells = batch.column("cell")
            change = (a[1:n] != a[: n - 1]) | (b[1:n] != b[: n - 1]) | (s[1:n] != s[: n - 1])
            cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [n]]) if n else [0]
            for s0, e0 in zip(cuts[:-1], cuts[1:]):
                here = (a[s0], b[s0], s[s0])
                if here != key:
                    if pair is not None:
                        yield from pair.edges(k, min_sim, complete)
                    key, pair, complete = here, _BlockPair(a[s0] == b[s0]), s_n[s0] == 1
                at = np.arange(s0, e0)
                left = _take(cells, at[side[s0:e0] == 0])
                right = left if pair.diagonal else _take(cells, at[side[s0:e0] == 1])
                pair.add(left, right)
        if pair is not None:
            yield from pair.edges(k, min_sim, complete)

    return run


def liked_scores(edges: DataFrame, history: DataFrame, user: str = "user_idx", item: str = "item_idx") -> DataFrame:
    """``(user, item, score)``: similarity of each reachable item summed over the history.

    ``history`` has one row per (user, item), as the interaction matrix does. Scores are
    rounded to 9 digits so that equal sums tie whatever the order of addition.
    """
    h = history.select(user, F.col(item).alias("item_i"))
    return (
        h.join(edges, "item_i")
        .groupBy(user, F.col("item_j").alias(item))
        .agg(F.round(F.sum("sim"), 9).alias("score"))
    )


def _open_scores(edges: DataFrame, history: DataFrame, skip: DataFrame | None, user: str, item: str) -> DataFrame:
    """``liked_scores`` without the pairs of ``skip``, left partitioned by user.

    A row for each liked item travels with the item's neighbours, and the pairs to skip come the
    same way, so one shuffle by user serves the sums, the exclusion and the ranking after it.
    """
    own = history.select(user, F.col(item).alias("item_i"))
    lists = own.join(_neighbor_lists(edges), "item_i").select(user, "_items", "_sims", F.lit(False).alias("_skip"))
    if skip is not None:
        kind = edges.schema["item_j"].dataType
        pairs = skip.filter(F.col(user).isNotNull() & F.col(item).isNotNull())
        lists = lists.unionByName(pairs.select(
            user, F.array(F.col(item).cast(kind)).alias("_items"), F.array(F.lit(0.0)).alias("_sims"), F.lit(True).alias("_skip")
        ))
    rows = lists.repartition(user).select(user, F.posexplode("_items").alias("_at", item), "_sims", "_skip")
    sums = rows.select(user, item, F.get("_sims", "_at").alias("_sim"), "_skip").groupBy(user, item).agg(
        F.round(F.sum("_sim"), 9).alias("score"), F.max("_skip").alias("_skip")
    )
    return sums.filter("NOT _skip").drop("_skip")


def _neighbor_lists(edges: DataFrame) -> DataFrame:
    """``(item_i, _items, _sims)``: neighbours of an item and their similarities, ``LIST_EDGES`` a row."""
    w = W.partitionBy("item_i").orderBy("item_j")
    part = F.floor((F.row_number().over(w) - 1) / LIST_EDGES)
    pair = F.struct(F.col("item_j").alias("j"), F.col("sim").cast("double").alias("s"))
    return (
        edges.filter("item_i IS NOT NULL")
        .withColumn("_part", part)
        .groupBy("item_i", "_part").agg(F.collect_list(pair).alias("_l"))
        .select("item_i", F.col("_l.j").alias("_items"), F.col("_l.s").alias("_sims"))
    )


def rank_scores(scores: DataFrame, n: int, user: str = "user_idx", item: str = "item_idx") -> DataFrame:
    """Best ``n`` items per user with ``rank`` 1..n (ties: smaller id first)."""
    w = W.partitionBy(user).orderBy(F.desc("score"), item)
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def item_item_recommend(
    edges: DataFrame,
    history: DataFrame,
    n: int = 10,
    exclude_liked: bool = True,
    excluded: DataFrame | None = None,
    allowed: DataFrame | None = None,
    fill_zero: bool = False,
    catalog: DataFrame | None = None,
    user: str = "user_idx",
    item: str = "item_idx",
) -> DataFrame:
    """``(user, rank, item, score)`` for every user with a history (one row per user and item).

    ``excluded`` holds further (user, item) pairs to skip, ``allowed`` the only items to
    score. With ``fill_zero`` users short of ``n`` items are padded with zero-score items
    of ``catalog`` (dense indices 0..m-1) in index order.
    """
    if allowed is not None:
        edges = edges.join(allowed.select(F.col(item).alias("item_j")), "item_j", "left_semi")
    liked = history.select(user, item)
    skip = liked if exclude_liked else None
    if excluded is not None:
        extra = excluded.select(user, item)
        skip = extra if skip is None else skip.unionByName(extra)
    scores = _open_scores(edges, history, skip, user, item)
    top = rank_scores(scores, n, user, item).select(user, "rank", item, "score")
    if not fill_zero:
        return top
    if catalog is None:
        raise ValueError("fill_zero needs the item catalog")
    # read several times below
    return _pad(cut_lineage(top), liked, skip, allowed, catalog, n, user, item)


def _pad(top, liked, skip, allowed, catalog, n, user, item) -> DataFrame:
    """Append zero-score items for users with fewer than ``n`` scored ones, all of which are in ``top``.

    A user with s blocked items finds its padding among the first n + s allowed catalog
    positions, so the candidates grow with the history, not with users x items.
    """
    short = (
        liked.select(user).distinct()
        .join(top.groupBy(user).agg(F.count(F.lit(1)).alias("_have")), user, "left")
        .fillna(0, ["_have"])
        .filter(F.col("_have") < n)
    )
    blocked = top.select(user, item).join(short.select(user), user, "left_semi")
    if skip is not None:
        blocked = blocked.unionByName(skip.join(short.select(user), user, "left_semi"))
    blocked = blocked.distinct()
    pool = catalog.select(F.col(item).cast("bigint").alias(item))
    if allowed is not None:
        from affinis.operators.prefix import dense_ids

        pool = pool.join(allowed.select(item), item, "left_semi")
        places = dense_ids(pool, item, "_pos").withColumnRenamed("id", item)
    else:
        places = pool.withColumn("_pos", F.col(item))
    size = pool.agg(F.count(F.lit(1)).alias("m")).scalar()
    reach = (
        short.join(blocked.groupBy(user).agg(F.count(F.lit(1)).alias("_s")), user, "left")
        .fillna(0, ["_s"])
        .withColumn("_last", F.least(F.col("_s") + n, size) - 1)
        .filter(F.col("_last") >= 0)
    )
    step = 1024  # positions come in short runs, so no row carries a long array
    runs = reach.select(
        user, "_have", "_last",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_last") / step))).alias("_run"),
    )
    spots = runs.select(
        user, "_have",
        F.explode(
            F.sequence(F.col("_run") * step, F.least(F.col("_run") * step + step - 1, F.col("_last")))
        ).alias("_pos"),
    )
    free = spots.join(places, "_pos").join(blocked, [user, item], "left_anti")
    w = W.partitionBy(user).orderBy("_pos")
    filler = (
        free.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= n)
        .filter(F.col("_rn") + F.col("_have") <= n)
        .select(user, (F.col("_rn") + F.col("_have")).cast("int").alias("rank"), item, F.lit(0.0).alias("score"))
    )
    return top.unionByName(filler)


def item_item_similar(edges: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Best ``n`` positive neighbours of each requested item: ``(item_i, rank, item_j, sim)``."""
    wanted = items.select(F.col("item_idx").alias("item_i")).distinct()
    w = W.partitionBy("item_i").orderBy(F.desc("sim"), "item_j")
    return (
        edges.filter(F.col("sim") > 0)
        .join(wanted, "item_i", "left_semi")
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= n)
        .select("item_i", "rank", "item_j", "sim")
    )


def item_item_score(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Similarity of each given ``(item_i, item_j)`` pair, 0 when there is no edge."""
    return pairs.join(edges, ["item_i", "item_j"], "left").withColumn(
        "sim", F.coalesce("sim", F.lit(0.0))
    )
