import numpy as np
import pyarrow as pa
import pytest
from helpers import SIMPLE, cosine, matrix_df, top_edges
from pyspark.sql import functions as F

from affinis.operators import als, item_item, knn
from affinis.operators.block_topk import _GridCell, block_topk
from affinis.operators.item_item import (
    item_item_fit,
    item_item_recommend,
    item_item_score,
    item_item_similar,
)
from affinis.operators.popularity import edge_density


def skewed_matrix(users=220, items=90, seed=0):
    """One user likes everything, one item is liked by everyone."""
    rng = np.random.default_rng(seed)
    x = (rng.random((users, items)) < 0.06).astype(float) * rng.integers(1, 4, (users, items))
    x[5, :] = 1.0
    x[:, 11] = 2.0
    return x


def as_array(edges, n):
    out = np.zeros((n, n))
    for r in edges.collect():
        out[r.item_i, r.item_j] = r.sim
    return out


@pytest.mark.parametrize("block,chunk", [(2048, 10**6), (16, 10**6), (16, 40), (7, 25)])
def test_similarity_matches_plain_cosine(spark, block, chunk):
    x = skewed_matrix()
    s = cosine(x)
    m = matrix_df(spark, x)
    full = as_array(item_item_fit(m, None, block_items=block, chunk_rows=chunk), x.shape[1])
    assert np.abs(full - s).max() < 1e-12
    some = item_item_fit(m, 5, 0.05, block_items=block, chunk_rows=chunk)
    assert {(r.item_i, r.item_j) for r in some.collect()} == top_edges(s, 5, 0.05)


def test_dense_histories_use_the_dense_product(spark):
    x = np.ones((40, 30)) * np.arange(1, 31)
    full = as_array(item_item_fit(matrix_df(spark, x), None, block_items=10), 30)
    assert np.abs(full - cosine(x)).max() < 1e-12


def test_short_histories_make_rows_for_pairs_instead_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = (rng.random((150, 120)) < 0.04) * rng.integers(1, 4, (150, 120)).astype(float)
    s, m = cosine(x), matrix_df(spark, x)

    def no_blocks(*_):
        raise AssertionError("blocks were used")

    monkeypatch.setattr(item_item, "_place_items", no_blocks)
    full = as_array(item_item_fit(m, None, block_items=4), 120)
    assert np.abs(full - s).max() < 1e-12
    some = item_item_fit(m, 5, 0.05, block_items=4)
    assert {(r.item_i, r.item_j) for r in some.collect()} == top_edges(s, 5, 0.05)


def test_simple_matrix(spark):
    edges = item_item_fit(matrix_df(spark, SIMPLE), 2).cache()
    s = as_array(edges, 6)
    assert np.all(np.diag(s) == 0) and (s > 0).sum(1).max() <= 2
    near = item_item_similar(edges, spark.createDataFrame([(2,)], "item_idx bigint"), 5).orderBy("rank").collect()
    assert [r.sim for r in near] == sorted((r.sim for r in near), reverse=True)
    pairs = spark.createDataFrame([(0, 1), (0, 5)], "item_i bigint, item_j bigint")
    got = {(r.item_i, r.item_j): r.sim for r in item_item_score(edges, pairs).collect()}
    assert got[(0, 1)] == pytest.approx(0.5) and got[(0, 5)] == 0.0
    n = spark.createDataFrame([(6,)], "n bigint")
    assert edge_density(edges, n).first().n_edges == (s > 0).sum()


def brute_recommend(x, s, n, exclude_liked, banned=(), allowed=None, fill=True):
    out = {}
    for u in range(len(x)):
        liked = np.flatnonzero(x[u])
        if not len(liked):
            continue
        score = np.round(s[liked].sum(0), 9)
        ok = [j for j in range(x.shape[1])
              if not (exclude_liked and x[u, j]) and (u, j) not in banned and (allowed is None or j in allowed)
              and (fill or score[j] > 0)]
        out[u] = [(j, score[j]) for j in sorted(ok, key=lambda j: (-score[j], j))[:n]]
    return out


@pytest.mark.parametrize("exclude,limited", [(True, False), (False, True), (True, True)])
@pytest.mark.parametrize("fill", [True, False])
def test_recommend_matches_plain_scoring(spark, exclude, limited, fill):
    x = skewed_matrix(60, 40, 2)
    x[7, :] = 0  # no history
    m = matrix_df(spark, x).cache()
    edges = item_item_fit(m, 4)
    s = as_array(edges, 40)
    allowed = list(range(0, 40, 3)) if limited else None
    banned = {(1, 0), (1, 3), (2, 9)} if limited else set()
    got = item_item_recommend(
        edges, m, 30, exclude,
        excluded=spark.createDataFrame(list(banned), "user_idx bigint, item_idx bigint") if limited else None,
        allowed=spark.createDataFrame([(a,) for a in allowed], "item_idx bigint") if limited else None,
        fill_zero=fill, catalog=spark.range(40).select(F.col("id").alias("item_idx")),
    ).collect()
    lists = {}
    for r in sorted(got, key=lambda r: (r.user_idx, r.rank)):
        lists.setdefault(r.user_idx, []).append((r.item_idx, pytest.approx(r.score)))
        assert r.rank == len(lists[r.user_idx])
    want = {u: v for u, v in brute_recommend(x, s, 30, exclude, banned, allowed, fill).items() if v}
    assert lists == want


def test_scored_items_of_a_user_meet_by_one_shuffle(spark, monkeypatch):
    monkeypatch.setattr(item_item, "LIST_EDGES", 3)  # lists of neighbours in several rows
    m = matrix_df(spark, skewed_matrix(60, 40, 2))
    edges = item_item_fit(m, 10)
    got = item_item_recommend(edges, m, 7)
    # nothing is shuffled once the pairs of user and item are rows
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString().split("Generate posexplode")[0]
    scores = item_item.liked_scores(edges, m).join(m, ["user_idx", "item_idx"], "left_anti")
    want = item_item.rank_scores(scores, 7)
    names = ("user_idx", "rank", "item_idx", "score")
    assert sorted(got.select(*names).collect()) == sorted(want.select(*names).collect())


def test_unlikable_rows_keep_their_scores(spark):
    edges = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5), (2, 3, 0.25), (None, 3, 1.0)], "item_i bigint, item_j bigint, sim double")
    history = spark.createDataFrame([(7, 1), (7, 9), (None, 2), (8, None)], "user_idx bigint, item_idx bigint")
    got = item_item_recommend(edges, history, 5, excluded=history.limit(0))
    # a null user has nothing to exclude
    assert {tuple(r) for r in got.select("user_idx", "rank", "item_idx", "score").collect()} == {(7, 1, 2, 0.5), (None, 1, 1, 0.5), (None, 2, 3, 0.25)}


def test_als_scores_carry_vectors_only_to_known_items(spark):
    users = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "idx bigint, vec array<double>")
    items = spark.createDataFrame([(5, [3.0, 4.0]), (6, None)], "idx bigint, vec array<double>")
    pairs = spark.createDataFrame([(u, i, "x") for u in (1, 2, 3, None) for i in (5, 6, 7, None)] + [(1, 5, "y")], "user_idx bigint, item_idx bigint, tag string")
    got = als.als_score(als.AlsFactors(users, items), pairs)
    assert got.columns == ["item_idx", "user_idx", "tag", "score"] and got.count() == 17
    assert {(r.user_idx, r.item_idx, r.tag, r.score) for r in got.filter("score IS NOT NULL").collect()} == {(1, 5, "x", 11.0), (1, 5, "y", 11.0)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN _known" in plan


def test_block_topk_matches_plain_scoring(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(400, 6))
    v[10] = v[20]
    genre = lambda j: [["a", "b", "c"][j % 3]] if j % 7 else None
    year = lambda j: 1950 + j % 50 if j % 5 else None
    items = spark.createDataFrame(
        [(j, [float(x) for x in r], genre(j), year(j)) for j, r in enumerate(v)],
        "item_id bigint, vec array<double>, genres array<string>, year int",
    )
    q = rng.normal(size=(60, 6))
    asked = spark.createDataFrame(
        [(f"q{i}", [float(x) for x in r], 3 + i % 4, ["a", "c"] if i % 2 else None, 1960 if i % 3 == 0 else None, i % 5)
         for i, r in enumerate(q)],
        "query_id string, vec array<double>, k int, genres array<string>, year_min int, skip_key int",
    )
    # one key is to skip half of the catalog
    skip_rows = [(0, j) for j in range(0, 400, 2)] + [(key, j) for key in range(1, 5) for j in range(key * 9)]
    skip = spark.createDataFrame(skip_rows, "skip_key int, item_id bigint")
    banned = set(skip_rows)
    for strict in (False, True):
        for sizes in ({}, dict(query_block=10, item_slice=100, item_chunk=30)):
            got = {}
            for r in block_topk(asked, items, 10, skip=skip, strict_genre=strict, **sizes).collect():
                got.setdefault(r.query_id, []).append((r.rank, r.item_id))
            for i in range(60):
                score = np.round(v @ q[i], 9)

                def ok(j):
                    if (i % 5, j) in banned:
                        return False
                    if i % 2 and (genre(j) is None and strict or genre(j) is not None and genre(j)[0] == "b"):
                        return False
                    return not (i % 3 == 0 and year(j) is not None and year(j) < 1960)

                want = [j for _, j in sorted((-score[j], j) for j in range(400) if ok(j))[: 3 + i % 4]]
                assert [j for _, j in sorted(got.get(f"q{i}", []))] == want


def test_block_topk_looks_for_a_kth_best_in_the_first_block_only(monkeypatch):
    rng = np.random.default_rng(4)
    cell = _GridCell(False, False, 9)
    cell.query_parts = [_part(asked := np.arange(20), rng.normal(size=(20, 6)))]
    cell._prepare()
    v = rng.normal(size=(900, 6))
    v[5] = v[700]
    v[3] = np.nan  # scores that are no numbers take no place
    blocks = [_part(np.arange(s, s + 100), v[s : s + 100]) for s in range(0, 900, 100)]
    cell.add_items(blocks[0])
    assert (cell.floor > -np.inf).all()
    for b in blocks[1:]:
        cell.add_items(b)
    assert cell.held < 20 * 900 // 4
    got = pa.Table.from_batches(list(cell.result())).to_pandas()
    score = np.round(cell.vec @ v.T, 9)
    for q in asked:
        want = sorted((-x, j) for j, x in enumerate(score[q]) if not np.isnan(x))[:10]
        found = got[got.query_id == q]
        assert sorted(zip(-found.score, found.item_id)) == want


def _part(ids, vec):
    n = len(ids)
    column = pa.FixedSizeListArray.from_arrays(pa.array(vec.ravel()), vec.shape[1]).cast(pa.list_(pa.float64()))
    none = {"genres": pa.list_(pa.string()), "year": pa.int32(), "year_min": pa.int32(), "year_max": pa.int32()}
    columns = {"query_id": pa.array(ids), "skip_key": pa.array(ids), "item_id": pa.array(ids), "vec": column, "k": pa.array([10] * n, pa.int32()),
               "chunk": pa.array([0] * n, pa.int32())} | {c: pa.nulls(n, t) for c, t in none.items()}
    return pa.RecordBatch.from_pydict(columns)


def test_filled_lists_are_scored_once(spark):
    edges = spark.range(977).select((F.col("id") % 30).alias("item_i"), ((F.col("id") + 7) % 31).alias("item_j"), F.lit(0.5).alias("sim")).dropDuplicates(["item_i", "item_j"])
    history = spark.createDataFrame([(u, i) for u in range(4) for i in range(u, 9)], "user_idx long, item_idx long")
    catalog = spark.range(40).select(F.col("id").alias("item_idx"))
    lists = item_item_recommend(edges, history, 35, fill_zero=True, catalog=catalog)
    assert "Range (0, 977" not in lists._jdf.queryExecution().executedPlan().toString()
    assert {r["count"] for r in lists.groupBy("user_idx").count().collect()} == {31, 32, 33, 34}


def clustered(spark, n=600, seed=5):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, 16)) * 3
    v = centers[rng.integers(0, 12, n)] + rng.normal(size=(n, 16))
    v[: n // 3] = v[0]  # a third of the rows are copies
    return v, spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "item_id bigint, vec array<double>")


def test_knn_exact_and_approximate(spark):
    v, items = clustered(spark)
    unit = v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-10)
    queries = items.withColumnRenamed("item_id", "query_id")

    def lists(df):
        out = {}
        for r in df.collect():
            out.setdefault(r.query_id, {})[r.rank] = r.item_id
        return {q: [d[k] for k in sorted(d)] for q, d in out.items()}

    exact = lists(knn.knn_exact(queries, items, 10))
    for i in (0, 1, 250, 599):
        score = np.round(unit @ unit[i], 9)
        assert exact[i] == sorted(range(600), key=lambda j: (-score[j], j))[:10]
    assert lists(knn.knn_ivf(queries, items, 10, nlist=15, nprobe=15)) == exact

    def recall(found):
        return np.mean([len(set(found.get(i, [])) & set(exact[i])) / 10 for i in exact])

    assert recall(lists(knn.knn_ivf(queries, items, 10, nlist=30, nprobe=10))) > 0.8
    assert recall(lists(knn.knn_lsh(queries, items, 10, tables=40, hashes=4))) > 0.8
    own = knn.knn_exact(queries, items, 5, skip_self=True)
    assert own.filter("query_id = item_id").count() == 0
    few = knn.IvfIndex(items.limit(5))
    assert few.nlist == 1
    checked = knn.dim_check(items, 16)
    assert checked.filter("valid").count() == 600 and knn.dim_check(items, 8).filter("valid").count() == 0
    ask = spark.createDataFrame([(3,), (9999,)], "item_id bigint")
    assert {r.item_id: r.vec is None for r in knn.vector_by_idx(items, ask).collect()} == {3: False, 9999: True}



def test_single_precision_vectors_travel_as_they_are(spark):
    _, wide = clustered(spark, 120)
    items = wide.withColumn("vec", F.col("vec").cast("array<float>"))
    queries = items.withColumnRenamed("item_id", "query_id")
    for index in (knn.IvfIndex(items, nlist=5), knn.LshIndex(items, tables=3)):
        assert index.items.schema["vec"].dataType.simpleString() == "array<float>"  # not twice as wide
        # as from vectors that are divided beforehand
        unit = index.items.withColumn("vec", F.transform("vec", lambda x: x.cast("double") / F.col("len"))).drop("len")
        found = sorted(map(tuple, index.search(queries, 4).collect()))
        index.items = unit
        assert found == sorted(map(tuple, index.search(queries, 4).collect())) and len(found) > 400
    exact = knn.knn_exact(queries, items, 4).collect()
    doubled = items.withColumn("vec", F.col("vec").cast("array<double>"))
    assert sorted(map(tuple, exact)) == sorted(map(tuple, knn.knn_exact(doubled.withColumnRenamed("item_id", "query_id"), doubled, 4).collect()))


def test_als(spark):
    x = skewed_matrix(60, 40, 3)
    m = matrix_df(spark, x).cache()
    model = als.als_fit(m, factors=8, iterations=4)
    users = m.select("user_idx").distinct()
    recs = als.als_recommend(model, users, 5, m).cache()
    assert recs.join(m, ["user_idx", "item_idx"], "left_semi").count() == 0
    # a user who has seen everything gets nothing, the others full lists
    sizes = {r.user_idx: r["count"] for r in recs.groupBy("user_idx").count().collect()}
    assert 5 not in sizes and set(sizes.values()) == {5}
    scored = als.als_score(model, recs.select("user_idx", "item_idx", F.col("score").alias("was")))
    assert scored.filter(F.abs(F.col("was") - F.col("score")) > 1e-6).count() == 0
    only = spark.createDataFrame([(1,), (2,)], "item_idx bigint")
    kept = als.als_recommend(model, users, 5, allowed=only)
    assert {r.item_idx for r in kept.collect()} <= {1, 2}
    near = als.als_similar(model, m.select("item_idx"), 3)
    assert near.filter("item_i = item_j").count() == 0
    assert near.filter(F.abs("sim") > 1 + 1e-6).count() == 0
    one = als.embeddings_get(model.users, spark.createDataFrame([(3,)], "idx bigint"))
    assert [len(r.vec) for r in one.collect()] == [8]
    assert als.model_params(spark, "als", model.params).first().params["factors"] == "8"


def test_als_drops_its_shuffles_every_iteration(spark, monkeypatch):
    seen = {}

    class Noted(als.ALS):
        def __init__(self, **settings):
            seen.update(settings)
            super().__init__(**settings)

    monkeypatch.setattr(als, "ALS", Noted)
    model = als.als_fit(matrix_df(spark, SIMPLE), factors=4, iterations=2)
    assert seen["checkpointInterval"] == 1 and model.users.count() == 5
