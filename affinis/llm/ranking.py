"""Ranked lexical search: each item's best documents by exact dual-tree search."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.llm.spread import LAST
from affinis.llm.text_batch import word_hashes, words
from affinis.session import cut_lineage

#: Documents returned for an item.
BEST = 10
#: Children of a node of either tree.
ARITY = 8
#: (item, term) pairs handled at once; more make more blocks of items, an item stays whole.
BLOCK_PAIRS = 1 << 18
#: (document, term) entries of one document tree; a single document may have more.
TREE_ENTRIES = 1 << 20
#: One in so many documents gives every item a first bound; this saves work and changes no result.
LOOK = 64

#: Bytes that end a term: ASCII other than letters and digits.
BREAKS = np.zeros(256, bool)
BREAKS[:128] = [not chr(c).isalnum() for c in range(128)]


def _pick(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of ``rows``, and where each row's entries begin among them."""
    size = ptr[rows + 1] - ptr[rows]
    begin = np.cumsum(size) - size
    return np.repeat(ptr[rows] - begin, size) + np.arange(size.sum()), begin


@dataclass
class Tree:
    """Vectors (rows of at least one entry) under nodes of ``ARITY`` children each.

    Level 0 holds the rows in the order ``rows``; node i of a level covers nodes i * ARITY and
    following of the level below. A level is (ptr, term, value, low): the greatest value of each
    term below the node, and the least ``rank`` below it.
    """

    rows: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def build(cls, ptr: np.ndarray, term: np.ndarray, value: np.ndarray, rank: np.ndarray, n_terms: int) -> Tree:
        rows = arrange(ptr, term, value, n_terms)
        at, begin = _pick(ptr, rows)
        levels = [(np.append(begin, len(at)), term[at], value[at], rank[rows])]
        while len(levels[-1][3]) > 1:
            ptr, term, value, low = levels[-1]
            node = np.repeat(np.arange(len(low)) // ARITY, np.diff(ptr))
            key = node * n_terms + term
            order = np.argsort(key, kind="stable")
            key = key[order]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            top = np.maximum.reduceat(value[order], start)
            key = key[start]
            parents = np.arange(-(-len(low) // ARITY))
            levels.append((
                np.append(np.searchsorted(key // n_terms, parents), len(key)),
                key % n_terms, top, np.minimum.reduceat(low, parents * ARITY),
            ))
        return cls(rows, levels)

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Nodes of the level below."""
        below = (nodes[:, None] * ARITY + np.arange(ARITY)).ravel()
        return below[below < len(self.levels[level - 1][3])]

    def bounds(self, level: int, nodes: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Greatest inner product of ``weight`` with any row below each node; exact at level 0."""
        ptr, term, value, _ = self.levels[level]
        if len(nodes) == len(ptr) - 1:
            return np.add.reduceat(value * weight[term], ptr[:-1])
        at, begin = _pick(ptr, nodes)
        return np.add.reduceat(value[at] * weight[term[at]], begin)


def arrange(ptr: np.ndarray, term: np.ndarray, value: np.ndarray, n_terms: int) -> np.ndarray:
    """The rows in an order in which neighbours are alike.

    Rows are halved by which of two unlike rows they share more with, down to ``ARITY`` rows.
    """
    scratch = np.zeros(n_terms)
    weight = value.astype(np.float64)
    norm = np.sqrt(np.add.reduceat(weight * weight, ptr[:-1])) if len(ptr) > 1 else np.zeros(0)
    norm[norm == 0] = 1
    out, todo = [], [np.arange(len(ptr) - 1)]
    while todo:
        rows = todo.pop()
        if len(rows) <= ARITY:
            out.append(rows)
            continue
        at, begin = _pick(ptr, rows)
        terms, weights = term[at], weight[at]

        def likeness(row: int) -> np.ndarray:
            own = slice(ptr[row], ptr[row + 1])
            scratch[term[own]] = weight[own]
            dot = np.add.reduceat(weights * scratch[terms], begin)
            scratch[term[own]] = 0
            return dot / norm[rows]

        one = rows[likeness(rows[0]).argmin()]
        to_one = likeness(one)
        other = rows[to_one.argmin()]
        order = np.argsort(likeness(other) / norm[other] - to_one / norm[one], kind="stable")
        unit = ARITY
        while unit * ARITY <= len(rows) // 2:
            unit *= ARITY
        half = max(1, round(len(rows) / 2 / unit)) * unit  # whole nodes
        todo += [rows[order[half:]], rows[order[:half]]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


class Search:
    """The best rows for each item seen so far; ``floor`` are scores that all results reach."""

    def __init__(self, items: Tree, n_items: int, n_terms: int, floor: np.ndarray, best: int):
        self.items, self.floor = items, floor
        self.score = np.zeros((n_items, best), np.int64)
        self.doc = np.full((n_items, best), LAST, np.int64)
        self.weight = np.zeros(n_terms, np.int64)
        self.compared = 0  # rows scored exactly

    def add(self, docs: Tree, ids: np.ndarray) -> None:
        """Searches a tree of documents for all items."""
        top = len(docs.levels) - 1
        self._visit(len(self.items.levels) - 1, 0, docs, ids, top, np.zeros(1, np.int64))

    def _visit(self, level: int, node: int, docs: Tree, ids: np.ndarray, depth: int, nodes: np.ndarray) -> None:
        """Compares a node of items with nodes of documents at one depth; leaves out the nodes
        whose bound is below the weakest last score of the items."""
        ptr, term, value, _ = self.items.levels[level]
        own = slice(ptr[node], ptr[node + 1])
        span = ARITY**level
        members = self.items.rows[node * span : (node + 1) * span]
        while True:
            last = np.maximum(self.score[members, -1], self.floor[members])
            need = max(1, int(last.min()))
            self.weight[term[own]] = value[own]
            bound = docs.bounds(depth, nodes, self.weight)
            self.weight[term[own]] = 0
            live = bound >= need
            if level == 0 and self.score[members[0], -1] == need:  # equal scores go to the smaller id
                live &= (bound > need) | (docs.levels[depth][3][nodes] < self.doc[members[0], -1])
            if level == 0 and depth == 0:
                self.compared += len(nodes)
                if live.any():
                    self._offer(int(members[0]), bound[live], ids[docs.rows[nodes[live]]])
                return
            nodes, bound = nodes[live], bound[live]
            if not len(nodes):
                return
            if level == 0 and len(nodes) > ARITY:  # the most promising nodes first, which raises the item's last score
                order = np.argsort(-bound, kind="stable")
                self._visit(level, node, docs, ids, depth - 1, docs.children(depth, nodes[order[:ARITY]]))
                rest = order[ARITY:]
                nodes = np.sort(nodes[rest[bound[rest] >= self.score[members[0], -1]]])
                if not len(nodes):
                    return
            if level and depth <= level + 1:  # nodes of documents stay the larger ones until the items are single
                break
            nodes, depth = docs.children(depth, nodes), depth - 1
        for child in self.items.children(level, np.array([node])):
            self._visit(level - 1, int(child), docs, ids, depth, nodes)

    def _offer(self, item: int, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.append(self.score[item], score), np.append(self.doc[item], doc)
        keep = np.lexsort((doc, -score))[: self.score.shape[1]]
        self.score[item], self.doc[item] = score[keep], doc[keep]


def _tokens(batches: Iterator[pa.RecordBatch], type_: pa.DataType) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w in words(b.column(1), breaks=BREAKS):
            at = pa.array(w.first + w.row)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at).cast(type_), pa.array(word_hashes(w).view(np.int64))], ["item", "term"])


def _vectors(vocabulary: np.ndarray):
    """One row for each text with terms: how many, and which of the vocabulary how often."""
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for w in words(b.column(1), breaks=BREAKS):
                h = word_hashes(w).view(np.int64)
                at = np.minimum(np.searchsorted(vocabulary, h), size - 1)
                hit = vocabulary[at] == h
                key, tf = np.unique(w.row[hit] * size + at[hit], return_counts=True)
                n = np.diff(w.bounds)
                rows = np.flatnonzero(n)
                edges = np.append(np.searchsorted(key // size, rows), len(key)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x)) for x in ((key % size).astype(np.int32), tf)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(w.first + rows)), pa.array(n[rows]), *lists], ["doc", "n", "terms", "tfs"])

    return run


@dataclass
class Block:
    """A block of items: ids, and the weights of their terms."""

    ids: pa.Array
    tree: Tree
    n_terms: int
    documents: int
    total: int  # terms of all documents

    def values(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        m = 10 + (90 * n * self.documents) // self.total
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _search(block: Block, floor: np.ndarray, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(block.tree, len(block.ids), block.n_terms, floor, best)
        for b in batches:
            doc, n, terms, tfs = b.columns
            edges, ids = terms.offsets.to_numpy().astype(np.int64), doc.to_numpy(zero_copy_only=False)
            n, base = n.to_numpy(zero_copy_only=False), edges[0]
            term, tf = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (terms, tfs))
            at = 0
            while at < len(ids):
                to = max(at + 1, int(np.searchsorted(edges, edges[at] + TREE_ENTRIES, "right")) - 1)
                own = slice(edges[at] - base, edges[to] - base)
                value = block.values(np.repeat(n[at:to], np.diff(edges[at : to + 1])), tf[own])
                search.add(Tree.build(edges[at : to + 1] - edges[at], term[own], value, ids[at:to], block.n_terms), ids[at:to])
                at = to
        item, place = np.nonzero(search.score)
        columns = [block.ids.take(pa.array(item)), pa.array(search.doc[item, place]), pa.array(search.score[item, place])]
        yield pa.RecordBatch.from_arrays([pa.array(item), *columns], ["number", "item", "doc", "score"])

    return run


def _rank_block(pairs: pa.Table, vocabulary: np.ndarray, vectors: DataFrame, item_type: str, best: int) -> DataFrame:
    items = pairs.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
    number, term = items.indices.to_numpy(zero_copy_only=False), pairs.column("term").to_numpy()
    order = np.lexsort((term, number))
    number, term = number[order].astype(np.int64), np.searchsorted(vocabulary, term[order])
    ptr = np.searchsorted(number, np.arange(len(items.dictionary) + 1))
    counts = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = np.zeros(len(vocabulary), np.int64)
    for r in held.collect():  # one row for each term of the block at most
        df[r.term] = r.df
    weight = np.array([math.floor(1000 * math.log((2 * counts.documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    tree = Tree.build(ptr, term, weight[term], np.zeros(len(items.dictionary), np.int64), len(vocabulary))
    block = Block(items.dictionary, tree, len(vocabulary), counts.documents, counts.total or 1)
    scored = vectors.filter(F.size("terms") > 0)
    schema = f"number bigint, item {item_type}, doc bigint, score bigint"
    first = W.partitionBy("number").orderBy(F.desc("score"), "doc")

    def top(rows: DataFrame, floor: np.ndarray) -> DataFrame:
        found = rows.mapInArrow(_search(block, floor, best), schema)
        return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= best)

    floor = np.zeros(len(items.dictionary), np.int64)
    few = scored.filter(F.pmod(F.xxhash64("doc", "n"), F.lit(LOOK)) == 0)
    for r in top(few, floor).filter(F.col("rank") == best).select("number", "score").collect():  # a row an item of the block
        floor[r.number] = r.score
    return cut_lineage(top(scored, floor).select("item", "rank", "doc", "score"))


def rank(docs: DataFrame, items: DataFrame, best: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``(item, rank, doc, score)``: the ``best`` documents with the highest scores for each item.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
    lower-cased. With N documents that have a term, L terms in all, n in one document and df
    documents with a term, a term weighs floor(1000 ln((2N + 2) / (2 df + 1))), and a document's
    score is the sum of weight * (10**9 tf // (1000 tf + 8 m)) over the item's terms, with
    m = 10 + 90 n N // L. All documents and whole texts count; terms are compared by 64-bit hashes.

    So a score is an inner product of an item's weights and a document's values. Items go in
    blocks of bounded size (one hash bucket of ids each). A scan turns documents into vectors over
    the block's terms, which are stored; every task arranges its documents in trees of up to
    ``TREE_ENTRIES`` entries and descends them together with the tree over the items. A node holds the
    greatest value of each term below it, so the product of two nodes is no less than any score
    below them; it is dropped if it is below the last score of all its items, or equal to it with
    larger ids only. First bounds come from the exact scores of one in ``LOOK`` documents. A task
    sends at most ``best`` rows an item.

    Equal scores go by ascending id; a null id comes last. Rows that share a document id are
    documents of their own; rows that share an item id, null too, are one item with the terms of
    all its texts. Texts that are null or without terms match nothing. Other columns are ignored.
    """
    item_type = items.schema[item_col].dataType.simpleString()
    arrow = items.select(item_col).limit(0).toArrow().schema.field(0).type
    pairs = cut_lineage(
        items.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("t"))
        .mapInArrow(lambda batches: _tokens(batches, arrow), f"item {item_type}, term bigint")
        .distinct()
    )
    blocks = -(-pairs.count() // BLOCK_PAIRS)
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("doc"), F.col(text_col).cast("string").alias("t"))
    found = None
    for b in range(blocks):
        own = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow()  # about BLOCK_PAIRS rows
        if not own.num_rows:
            continue
        vocabulary = np.unique(own.column("term").to_numpy())
        vectors = cut_lineage(rows.mapInArrow(_vectors(vocabulary), "doc bigint, n bigint, terms array<int>, tfs array<bigint>"))
        part = _rank_block(own, vocabulary, vectors, item_type, best)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return items.limit(0).select(F.col(item_col).alias("item"), F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc"), F.lit(0).cast("bigint").alias("score"))
    return found.withColumn("doc", F.when(F.col("doc") < LAST, F.col("doc")))
