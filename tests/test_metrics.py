import math
import re

import pytest
from pyspark.sql import functions as F

from affinis.operators.rank_metrics import (
    catalog_coverage,
    evaluate_model,
    metrics_table,
    user_metrics,
)


def recs(spark, lists):
    rows = [(u, r + 1, i) for u, items in lists.items() for r, i in enumerate(items)]
    return spark.createDataFrame(rows, "user_id bigint, rank int, item_id bigint")


def pairs(spark, sets):
    rows = [(u, i) for u, items in sets.items() for i in items]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint")


def by_user(df):
    return {(r.user_id, r.k): r for r in df.collect()}


def test_hand_computed_lists(spark):
    lists = {1: [1, 2, 3, 4, 5], 2: [1, 2, 3], 3: [1, 2, 3, 4, 5], 4: [9, 8]}
    relevant = {1: [2, 4], 2: [1, 2], 3: [3, 5]}
    m = by_user(user_metrics(recs(spark, lists), pairs(spark, relevant), [0, 1, 2, 3, 5, 10]))
    assert m[(1, 5)].ndcg == pytest.approx(0.651, abs=1e-3)
    assert m[(1, 5)].precision == pytest.approx(0.4) and m[(1, 5)].recall == 1.0
    assert m[(1, 5)].reciprocal_rank == 0.5 and m[(1, 1)].hit == 0.0 and m[(1, 2)].hit == 1.0
    # the divisor is k even when the list is shorter
    assert m[(2, 10)].precision == pytest.approx(0.2) and m[(2, 10)].recall == 1.0
    assert [m[(3, k)].recall for k in (2, 3, 5)] == [0.0, 0.5, 1.0]
    assert m[(3, 5)].ndcg == pytest.approx((1 / 2 + 1 / math.log2(6)) / (1 + 1 / math.log2(3)))
    # nothing relevant, and k = 0
    assert tuple(m[(4, 5)])[2:] == (0.0, 0.0, 0.0, 0.0, 0.0)
    assert m[(1, 0)].precision == 0.0 and m[(1, 0)].hit == 0.0
    assert (5, 5) not in m


def test_means_and_counts(spark):
    lists = {1: [1, 2, 3], 2: [4, 5, 6], 3: [7]}
    relevant = {1: [2], 2: [9], 4: [1]}
    got = {(r.metric, r.k): r.value for r in evaluate_model(recs(spark, lists), pairs(spark, relevant), [2, 3]).collect()}
    assert got[("n_users_evaluated", None)] == 2  # user 3 has nothing relevant, user 4 no list
    assert got[("mrr", None)] == pytest.approx(0.25)
    assert got[("precision", 2)] == pytest.approx(0.25) and got[("hit", 3)] == 0.5
    first = {(r.metric, r.k): r.value for r in evaluate_model(recs(spark, lists), pairs(spark, relevant), [2], max_users=1).collect()}
    assert first[("n_users_evaluated", None)] == 1 and first[("hit", 2)] == 1.0
    table = metrics_table(evaluate_model(recs(spark, lists), pairs(spark, relevant), [2, 3]))
    assert set(table.columns) == {"metric", "at_2", "at_3"} and table.count() == 4


def test_nobody_to_evaluate(spark):
    empty = pairs(spark, {1: [1]}).limit(0)
    got = {(r.metric, r.k): r.value for r in evaluate_model(recs(spark, {1: [1]}), empty, [5]).collect()}
    assert set(got.values()) == {0.0} and len(got) == 6


def test_coverage(spark):
    r = catalog_coverage(recs(spark, {1: [1, 2], 2: [2, 3]}), pairs(spark, {0: [1, 2, 3, 4]}), top=1)
    assert tuple(r.first()) == (2, 4, 0.5)


def test_lists_are_scored_once_for_all_figures(spark):
    lists = spark.range(977).select((F.col("id") % 50).alias("user_id"), (F.col("id") % 7 + 1).cast("int").alias("rank"), F.col("id").alias("item_id"))
    plan = evaluate_model(lists, pairs(spark, {1: [1]}))._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"Range \(0, 977.*", plan))) == 1 and plan.split("Initial Plan")[0].count("Range (0, 977") == 1
