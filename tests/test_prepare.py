import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from affinis.operators import filters, ids, popularity, prefix, split
from affinis.operators.kcore import kcore_filter


def brute_kcore(df, mu, mi):
    while True:
        u = df.groupby("user_id").size()
        i = df.groupby("item_id").size()
        kept = df[df.user_id.isin(u[u >= mu].index) & df.item_id.isin(i[i >= mi].index)]
        if len(kept) == len(df):
            return kept
        df = kept


def skewed_pairs(n=3000, seed=1):
    """A third of the rows belong to one user and a third to one item."""
    rng = np.random.default_rng(seed)
    u = np.where(rng.random(n) < 1 / 3, 7, rng.integers(0, 300, n))
    i = np.where(rng.random(n) < 1 / 3, 3, rng.integers(0, 200, n))
    return pd.DataFrame({"user_id": u, "item_id": i, "timestamp": rng.integers(0, 50, n)})


@pytest.mark.parametrize("mu,mi", [(5, 10), (3, 3), (1, 1), (60, 60), (8, 2)])
def test_kcore_matches_plain_iteration(spark, mu, mi):
    pdf = skewed_pairs()
    got = kcore_filter(spark.createDataFrame(pdf), mu, mi).toPandas()
    want = brute_kcore(pdf, mu, mi)
    key = ["user_id", "item_id", "timestamp"]
    assert sorted(map(tuple, got[key].values)) == sorted(map(tuple, want[key].values))


def test_kcore_edges(spark):
    empty = spark.createDataFrame([], "user_id bigint, item_id bigint, timestamp bigint")
    assert kcore_filter(empty).count() == 0
    chain = spark.createDataFrame([(i, i, 0) for i in range(6)] + [(i, i + 1, 0) for i in range(5)], "user_id bigint, item_id bigint, timestamp bigint")
    assert kcore_filter(chain, 2, 2).count() == 0  # unravels from both ends
    long = spark.createDataFrame([(i, i + d, 0) for i in range(25) for d in (0, 1)], "user_id long, item_id long, timestamp long")
    assert kcore_filter(long.filter("NOT (user_id = 0 AND item_id = 0)"), 2, 2).count() == 0  # a link at each end a round


def test_implicit(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (1, 3, None), (2, 1, 4)], "user_id int, item_id int, rating int")
    assert sorted(tuple(r) for r in filters.to_implicit(df).collect()) == [(1, 1), (2, 1)]


def test_cutoffs_and_ties(spark):
    ts = [1] * 5 + [2] * 2 + [3] * 3
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(ts)], "user_id int, item_id int, timestamp bigint")
    cut = split.split_cutoffs(df).first()
    s = sorted(ts)
    assert (cut.train_cutoff, cut.val_cutoff) == (s[7], s[8])
    got = {r.split: r["count"] for r in split.time_split(df).groupBy("split").count().collect()}
    assert got == {"train": 7, "test": 3}  # rows tied with both cutoffs go to the later split
    with pytest.raises(ValueError):
        split.split_cutoffs(df, 0.7, 0.2, 0.2)
    assert tuple(split.split_cutoffs(df.limit(0)).first()) == (None, None)


def test_split_stats(spark):
    rows = [(1, 1, 1, "train"), (2, 1, 2, "train"), (1, 2, 3, "val"), (3, 1, 4, "val"), (3, 2, 5, "test"), (4, 5, 6, "test")]
    df = spark.createDataFrame(rows, "user_id int, item_id int, timestamp bigint, split string")
    s = {r.split: r for r in split.split_stats(df).collect()}
    assert (s["val"].n_users, s["val"].new_users, s["val"].n_items, s["val"].new_items) == (2, 1, 2, 1)
    assert (s["test"].n_users, s["test"].new_users, s["test"].n_items, s["test"].new_items) == (2, 1, 2, 1)
    assert s["train"].share == pytest.approx(1 / 3)


def test_positions_folds_and_holdout(spark):
    pdf = skewed_pairs(500).assign(row=lambda d: np.arange(len(d)))
    ordered = pdf.sort_values(["timestamp", "row"]).reset_index(drop=True)
    placed = prefix.row_positions(spark.createDataFrame(pdf), ["timestamp", "row"]).toPandas().sort_values("pos")
    assert placed.pos.tolist() == list(range(500)) and placed.row.tolist() == ordered.row.tolist()
    df = spark.createDataFrame(ordered.assign(pos=np.arange(500)))
    folds = split.fold_split(df, 5).groupBy("fold").agg(F.min("pos"), F.max("pos")).orderBy("fold").collect()
    assert [tuple(r) for r in folds] == [(i + 1, 100 * i, 100 * i + 99) for i in range(5)]
    for cap in (0, 40):
        taken, seen, want = 0, {}, []
        for u in ordered.user_id:
            seen[u] = seen.get(u, 0) + 1
            hit = (cap <= 0 or taken < cap) and 2 <= seen[u] <= 4
            taken += hit
            want.append(bool(hit))
        got = split.holdout_n_per_user(df, 2, 4, cap).orderBy("pos").toPandas().is_test.tolist()
        assert got == want


def test_dense_ids_and_lookups(spark):
    df = spark.createDataFrame([(10, 3), (2, 3), (100, 1), (10, 1), (None, 2)], "user_id bigint, item_id bigint")
    users, items = ids.build_mappings(df)
    assert sorted(tuple(r) for r in users.collect()) == [(2, 0), (10, 1), (100, 2)]
    mapped = ids.map_ids(spark.createDataFrame([(2,), (5,)], "user_id bigint"), users, "user_id", "u")
    assert {(r.user_id, r.u) for r in mapped.collect()} == {(2, 0), (5, None)}
    back = ids.unmap_ids(spark.createDataFrame([(2,), (9,)], "u bigint"), users, "u", "user_id")
    assert {(r.u, r.user_id) for r in back.collect()} == {(2, 100), (9, None)}
    m = ids.interaction_matrix(df.unionByName(df), users, items).collect()
    assert sorted((r.user_idx, r.item_idx, r.value) for r in m) == [(0, 2, 2), (1, 0, 2), (1, 2, 2), (2, 0, 2)]
    checked = filters.check_ids(spark.createDataFrame([(-1,), (0,), (2,), (3,), (None,)], "idx bigint"), users)
    assert [r.valid for r in checked.collect()] == [False, True, True, False, False]


def test_prefix_sums_with_negative_and_sparse_keys(spark):
    rng = np.random.default_rng(3)
    keys = np.concatenate([rng.integers(-(2**60), 2**60, 400), np.full(300, 5), rng.integers(0, 20, 300)])
    got = prefix.prefix_sums(spark.createDataFrame(pd.DataFrame({"k": keys})), "k").toPandas().sort_values("k")
    want = pd.Series(keys).value_counts().sort_index()
    assert got.k.tolist() == want.index.tolist() and got.cum.tolist() == want.cumsum().tolist()


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 900), "v": np.where(rng.random(900) < 0.4, 2.5, rng.random(900) * 100)})
    got = prefix.quantiles(spark.createDataFrame(pdf), "v", {"a": 0.5, "b": 0.95, "c": 0.99}, ["g"]).toPandas()
    for r in got.itertuples():
        want = np.percentile(pdf.v[pdf.g == r.g], [50, 95, 99])
        assert [r.a, r.b, r.c] == pytest.approx(want)


def test_popularity(spark):
    counts = {1: 4, 2: 4, 3: 1, 4: 7, 5: 1, 6: 1}
    df = spark.createDataFrame([(i,) for i, n in counts.items() for _ in range(n)], "item_id bigint")
    s = pd.Series(counts)
    got = popularity.popularity(df).toPandas().set_index("item_id").sort_index()
    assert got.interaction_count.to_dict() == counts
    assert got.popularity_rank.tolist() == s.rank(method="min", ascending=False).astype(int).tolist()
    assert got.popularity_percentile.tolist() == (s.rank(pct=True) * 100).round(1).tolist()
    stats = popularity.popularity_stats(popularity.popularity(df)).first()
    assert tuple(stats) == (1, 2.5, 7)
    assert popularity.density(df.limit(0).withColumn("user_id", F.lit(1))).first().density_pct is None
