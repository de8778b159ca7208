import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.llm import ranking
from affinis.llm.queries import QUERIES, SQL
from affinis.llm.ranking import Search, Tree, rank
from oracle import same

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, best=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    total, n_docs = sum(sizes), sum(s > 0 for s in sizes)
    df = Counter(t for _, b in bags for t in b)
    want, wanted = [], {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    for item, ts in wanted.items():
        scored = []
        for (doc, bag), n in zip(bags, sizes, strict=True):
            s = 0
            for t in ts & set(bag):
                m = 10 + 90 * n * n_docs // total
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if s > 0:
                scored.append((-s, math.inf if doc is None else doc, doc))
        want += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scored, key=lambda x: x[:2])[:best], 1)]
    return sorted(want, key=repr)


def made_up(seed, n_docs, n_items, words=60):
    rng = np.random.default_rng(seed)

    def text(n):
        return " ".join(f"w{x}" for x in (words * rng.random(n) ** 3).astype(int))

    docs = [(i, text(rng.integers(0, 40))) for i in range(n_docs)]
    docs += [(None, docs[3][1]), (None, "W0 w0, É-w1"), (5, docs[5][1]), (5, "w2 w3"), (7000, None), (7001, ""), (7002, "?!"), (7003, docs[3][1]), (7004, "w1 " * 20000)]
    items = [(i, text(rng.integers(1, 12))) for i in range(n_items)]
    items += [(900, None), (901, "!"), (902, "nowhere"), (3, "w9 é w1"), (None, "w1 w2"), (None, "w4"), (903, "w50 " * 30)]
    return docs, items


@pytest.mark.parametrize("pairs, entries", [(1 << 18, 1 << 20), (40, 1 << 20), (1 << 18, 500)])
def test_ranks_like_by_hand(spark, monkeypatch, pairs, entries):
    monkeypatch.setattr(ranking, "BLOCK_PAIRS", pairs)
    docs, items = made_up(pairs + entries, 700, 20)
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("doc", F.lit(1)).repartition(3)
    wanted = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit("clash")).withColumn("item", F.lit(1))
    if entries < 1 << 20:
        whole = ranking._search
        monkeypatch.setattr(ranking, "_search", lambda *a: _small_trees(whole(*a), entries))
    assert sorted(map(tuple, rank(rows, wanted).collect()), key=repr) == by_hand(docs, items)


def _small_trees(run, entries):
    def small(batches):
        ranking.TREE_ENTRIES = entries
        yield from run(batches)

    return small


def test_equal_scores_and_short_lists(spark):
    docs = [(i, "one two three" if i % 2 else "four") for i in range(40, 0, -1)] + [(50, "one")]
    items = [("a", "one TWO"), ("b", "four"), ("c", "one")]
    got = rank(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id string, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(docs, items)
    few = rank(spark.createDataFrame(docs[:3], "doc_id int, text string"), spark.createDataFrame(items, "item_id string, text string"), best=2)
    assert sorted(map(tuple, few.collect()), key=repr) == by_hand(docs[:3], items, 2)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    names = ["item", "rank", "doc", "score"]
    for found in (rank(docs.limit(0), items), rank(docs, items.limit(0)), rank(docs, items.withColumn("text", F.lit("?")))):
        assert found.columns == names and found.collect() == []


def vectors(rng, n, n_terms, groups):
    """Rows of terms around the centres of groups."""
    rows = []
    for i in range(n):
        base = (i % groups) * (n_terms // groups)
        own = np.unique(np.append(base + rng.integers(0, n_terms // groups, 12), rng.integers(0, n_terms, 2)))
        rows.append(own)
    ptr = np.append(0, np.cumsum([len(r) for r in rows]))
    return ptr, np.concatenate(rows)


def test_trees_bound_and_prune():
    rng = np.random.default_rng(5)
    n_docs, n_items, n_terms = 3000, 60, 400
    weight = rng.integers(1, 9000, n_terms)
    dp, dt = vectors(rng, n_docs, n_terms, 20)
    dv = rng.integers(1, 10**6, len(dt))
    ip, it = vectors(rng, n_items, n_terms, 20)
    ids = rng.permutation(n_docs).astype(np.int64)
    docs = Tree.build(dp, dt, dv, ids, n_terms)
    assert sorted(docs.rows) == list(range(n_docs))
    for level in range(1, len(docs.levels)):  # a node is above all below it
        for node in range(len(docs.levels[level][3])):
            w = rng.integers(0, 100, n_terms)
            below = docs.children(level, np.array([node]))
            assert docs.bounds(level, np.array([node]), w)[0] >= docs.bounds(level - 1, below, w).max()
    items = Tree.build(ip, it, weight[it], np.zeros(n_items, np.int64), n_terms)
    search = Search(items, n_items, n_terms, np.zeros(n_items, np.int64), 10)
    search.add(docs, ids)
    for i in range(n_items):
        w = np.zeros(n_terms, np.int64)
        w[it[ip[i] : ip[i + 1]]] = weight[it[ip[i] : ip[i + 1]]]
        score = np.add.reduceat(dv * w[dt], dp[:-1])
        order = np.lexsort((ids, -score))[:10]
        assert search.score[i].tolist() == score[order].tolist()
        assert search.doc[i].tolist() == ids[order].tolist()
    assert search.compared < 0.3 * n_docs * n_items


def test_query_equals_sql(spark, sf_dir):
    same(QUERIES["op13_lexical_ranking"](spark, sf_dir), SQL["op13_lexical_ranking"], sf_dir)
