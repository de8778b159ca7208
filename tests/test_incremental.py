"""Item-item state kept up by batches, and search in steps of falling norm."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.operators import block_topk, item_item
from affinis.operators.incremental import IncrementalItemItem
from affinis.operators import pruned
from affinis.operators.pruned import PrunedSearch


def rows_of(df, *columns):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect())


def matrix(spark, cells):
    return spark.createDataFrame([(u, i, v) for (u, i), v in cells.items()], "user_id long, item_id long, value double")


@pytest.mark.parametrize("compact", [2, 16])
def test_batch_after_batch_equals_one_fit(spark, tmp_path, compact):
    rng = np.random.default_rng(compact)
    state = IncrementalItemItem(spark, str(tmp_path / "state"), buckets=4, compact=compact)
    assert state.edges().collect() == [] and state.batches() == []
    cells: dict[tuple[int, int], float] = {}
    for b in range(4):
        users, items = rng.integers(0, 30, 60) + 10 * b, rng.integers(0, 25, 60)
        fresh = {(int(u), int(i)): float(rng.integers(1, 6)) for u, i in zip(users, items, strict=True)}
        if b == 2:  # values change, pairs go, pairs repeat
            old = list(cells)
            fresh |= {old[0]: cells[old[0]] + 1, old[1]: 0.0, old[2]: cells[old[2]]}
        batch = matrix(spark, fresh)
        batch = batch.unionByName(batch.limit(1)).unionByName(spark.sql("SELECT null user_id, 1L item_id, 2D value"))
        assert state.add(batch, f"b{b}")
        assert not state.add(batch, f"b{b}")  # a retried job
        cells = {k: v for k, v in (cells | fresh).items() if v}
        whole = matrix(spark, cells)
        names = ("item_i", "item_j", "sim")
        want = item_item.item_item_fit(whole, 5, user="user_id", item="item_id")
        assert rows_of(state.edges(5), *names) == rows_of(want, *names)
        want = item_item.item_item_fit(whole, None, 0.3, user="user_id", item="item_id")
        assert rows_of(state.edges(None, 0.3), *names) == rows_of(want, *names)
        assert rows_of(state.popularity(), "item_id", "users") == rows_of(whole.groupBy("item_id").agg(F.count("*").alias("users")), "item_id", "users")
    seen = {u for u, _ in cells}
    ids = {r.id: r.idx for r in state.ids("user").collect()}
    assert seen <= set(ids) and sorted(ids.values()) == list(range(len(ids)))
    assert rows_of(state.interactions(), "u", "i", "v") == sorted((u, i, v) for (u, i), v in cells.items())
    assert state.batches() == ["b0", "b1", "b2", "b3"]


def test_a_batch_writes_only_what_it_changes(spark, tmp_path):
    state = IncrementalItemItem(spark, str(tmp_path / "state"))
    state.add(matrix(spark, {(u, i): 1.0 for u in range(40) for i in range(20)}), "all")
    state.add(matrix(spark, {(3, 99): 1.0}), "one")
    second = [spark.read.parquet(state._folder(1, x)).count() for x in ("interactions", "cells", "items", "user_ids", "item_ids")]
    assert second == [1, 20, 1, 0, 1]


def test_an_unfinished_generation_does_not_count(spark, tmp_path):
    state = IncrementalItemItem(spark, str(tmp_path / "state"))
    cells = {(u, i): 1.0 for u in range(5) for i in range(4)}
    state.add(matrix(spark, cells), "a")
    commit, state._commit = state._commit, lambda *x: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        state.add(matrix(spark, {(9, 9): 1.0, (9, 1): 1.0}), "b")
    state._commit = commit
    assert state.batches() == ["a"] and state.items().count() == 4
    assert state.add(matrix(spark, {(9, 8): 1.0, (9, 1): 1.0}), "b")
    want = item_item.item_item_fit(matrix(spark, cells | {(9, 8): 1.0, (9, 1): 1.0}), None, user="user_id", item="item_id")
    assert rows_of(state.edges(None), "item_i", "item_j", "sim") == rows_of(want, "item_i", "item_j", "sim")


def vectors(spark, x, name="item_id"):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], f"{name} long, vec array<double>")


@pytest.mark.parametrize("growth, spread", [(2, 60.0), (4, 1.0)])
def test_pruned_search_equals_exact_search(spark, growth, spread):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((900, 12)) * np.linspace(spread, 1, 900)[rng.permutation(900), None] ** 4
    x[5] = x[6]  # ties
    x[7] = 0
    queries, items = vectors(spark, rng.standard_normal((40, 12)), "query_id"), vectors(spark, x)
    skip = spark.createDataFrame([(q, i) for q in range(40) for i in range(q * 20, q * 20 + 30)], "query_id long, item_id long")
    index = PrunedSearch(items, first=32, growth=growth)
    assert sum(n for _, _, n in index.steps) == 900 and index.steps[0][2] == 32
    for pairs, own in ((None, False), (skip, False), (None, True)):
        got = index.search(queries, 10, pairs, own)
        want = block_topk.block_topk(queries, items, 10, skip=pairs, skip_self=own)
        assert rows_of(got, "query_id", "rank", "item_id", "score") == rows_of(want, "query_id", "rank", "item_id", "score")
    if spread > 1:
        assert index.comparisons < 0.5 * 40 * 900
    assert index.search(queries.limit(0), 10).collect() == []
    assert index.search(queries, 1000).count() == 40 * 900


def test_pruned_search_of_no_items(spark):
    none = spark.createDataFrame([], "item_id long, vec array<double>")
    queries = vectors(spark, np.ones((2, 3)), "query_id")
    assert PrunedSearch(none).search(queries, 3).collect() == []


def test_pruned_search_takes_the_rest_at_once_where_norms_are_equal(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    queries, items = vectors(spark, rng.standard_normal((20, 12)), "query_id"), vectors(spark, x)
    skip = spark.createDataFrame([(q, i) for q in range(20) for i in range(q, 600, 7)], "query_id long, item_id long")
    calls, search = [], block_topk.block_topk
    monkeypatch.setattr(pruned, "block_topk", lambda *a, **k: calls.append(1) or search(*a, **k))
    index = PrunedSearch(items, first=32)
    got = index.search(queries, 10, skip)
    assert len(index.steps) > 4 and len(calls) == 2 and index.comparisons <= 20 * 600
    want = search(queries, items, 10, skip=skip)
    assert rows_of(got, "query_id", "rank", "item_id", "score") == rows_of(want, "query_id", "rank", "item_id", "score")
