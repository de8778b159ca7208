"""End-to-end run on the public ML-100K ratings.

Set ML100K_DIR to a folder with the five disjoint fold files u1.test .. u5.test, whose
union is the whole rating set. Skipped otherwise.
"""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from affinis.operators.filters import to_implicit
from affinis.operators.split import split_cutoffs, split_stats
from affinis.plans.prepare import prepare
from affinis.plans.training import AlsModel, ItemItemModel, evaluate
from affinis.sources.ratings import scan_ratings

FOLDER = os.environ.get("ML100K_DIR")
pytestmark = pytest.mark.skipif(not FOLDER, reason="ML100K_DIR is not set")


@pytest.fixture(scope="module")
def ratings(spark):
    return scan_ratings(spark, [str(Path(FOLDER) / f"u{i}.test") for i in range(1, 6)]).cache()


@pytest.fixture(scope="module")
def data(ratings):
    return prepare(ratings)


def values(metrics):
    return {(r.metric, r.k): r.value for r in metrics.collect()}


def test_filtering(ratings, data):
    assert ratings.count() == 100_000
    assert to_implicit(ratings).count() == 55_375
    assert data.split.count() == 53_164
    sizes = data.split.agg(F.countDistinct("user_id"), F.countDistinct("item_id")).first()
    assert tuple(sizes) == (938, 824)


def test_split(data):
    cut = split_cutoffs(data.split).first()
    assert (cut.train_cutoff, cut.val_cutoff) == (886759441, 891037276)
    stats = {r.split: r for r in split_stats(data.split).collect()}
    assert (stats["train"].n, stats["val"].n, stats["test"].n) == (37_214, 7_974, 7_976)
    assert (stats["val"].n_users, stats["val"].new_users) == (250, 145)
    assert (stats["val"].n_items, stats["val"].new_items) == (806, 5)
    assert (stats["test"].n_users, stats["test"].new_users) == (208, 132)
    assert (stats["test"].n_items, stats["test"].new_items) == (783, 1)


def test_ids_and_popularity(data):
    assert data.users.count() == 661
    assert data.items.count() == 818
    assert data.items.agg(F.max("idx")).first()[0] == 817
    top = data.popularity.orderBy("popularity_rank").limit(2).collect()
    assert [tuple(r) for r in top] == [(50, 365, 1, 100.0), (100, 303, 2, 99.9)]


def test_item_item_quality(data):
    model = ItemItemModel.fit(data)
    assert model.edges.count() == 40_885
    val = values(evaluate(model, data, data.val))
    assert val[("n_users_evaluated", None)] == 104
    expect = {
        ("ndcg", 5): 0.1200, ("ndcg", 10): 0.1065, ("ndcg", 20): 0.1080, ("precision", 10): 0.0913,
        ("recall", 10): 0.0511, ("hit", 10): 0.3462, ("mrr", None): 0.2125,
    }
    for key, want in expect.items():
        assert val[key] == pytest.approx(want, abs=6e-5), key
    test = values(evaluate(model, data, data.test))
    assert test[("n_users_evaluated", None)] == 50
    assert test[("ndcg", 10)] == pytest.approx(0.1294, abs=6e-5)
    assert test[("recall", 20)] == pytest.approx(0.1003, abs=6e-5)


def test_als_quality(data):
    default = values(evaluate(AlsModel.fit(data), data, data.val))
    assert default[("n_users_evaluated", None)] == 104
    assert default[("ndcg", 10)] >= 0.065
    stronger = values(evaluate(AlsModel.fit(data, regularization=0.1), data, data.val))
    assert stronger[("ndcg", 10)] >= 0.085


def test_popularity_file(spark, data):
    """Every row of the published popularity table, when it is at hand."""
    path = os.environ.get("ML100K_POPULARITY")
    if not path:
        pytest.skip("ML100K_POPULARITY is not set")
    schema = "item_id int, interaction_count bigint, popularity_rank int, popularity_percentile double"
    want = spark.read.schema(schema).option("header", True).csv(path)
    got = data.popularity.select(*want.columns)
    assert got.count() == want.count() == 818
    assert got.join(want, want.columns, "left_anti").count() == 0
