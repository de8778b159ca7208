"""Ranking metrics over recommendation lists, all k in one aggregation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K_VALUES = (5, 10, 20)


def _ideal(n: Column, k: int) -> Column:
    """Best possible DCG with ``n`` relevant items in the first ``k`` places."""
    sums, total = [], 0.0
    for pos in range(1, k + 1):
        total += 1.0 / math.log2(pos + 1)
        sums.append(F.lit(total))
    return F.element_at(F.array(*sums), F.least(n, F.lit(k)).cast("int"))


def user_metrics(
    recs: DataFrame,
    relevance: DataFrame,
    k_values: Sequence[int] = K_VALUES,
    user: str = "user_id",
    item: str = "item_id",
) -> DataFrame:
    """``(user, k, precision, recall, ndcg, hit, reciprocal_rank)``.

    ``recs`` holds ``(user, rank, item)`` with ranks from 1, ``relevance`` the relevant
    (user, item) pairs. Users without recommendations are left out; users without
    relevant items score 0. Precision divides by k even for shorter lists. The
    reciprocal rank looks at the whole given list.
    """
    relevant = relevance.select(user, item).distinct()
    n_rel = relevant.groupBy(user).agg(F.count(F.lit(1)).alias("n_rel"))
    good = [int(k) for k in k_values if k > 0]
    marked = recs.join(relevant.withColumn("_hit", F.lit(1)), [user, item], "left").select(
        user, "rank", F.coalesce("_hit", F.lit(0)).alias("hit")
    )
    sums = [F.min(F.when(F.col("hit") == 1, F.col("rank"))).alias("first")]
    for k in good:
        inside = (F.col("hit") == 1) & (F.col("rank") <= k)
        sums.append(F.sum(F.when(inside, 1).otherwise(0)).alias(f"hits_{k}"))
        sums.append(F.sum(F.when(inside, 1.0 / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias(f"dcg_{k}"))
    per_user = (
        marked.groupBy(user).agg(*sums).join(n_rel, user, "left").fillna(0, ["n_rel"])
    )
    zero, n = F.lit(0.0), F.col("n_rel")
    rows = [
        F.struct(
            F.lit(k).alias("k"),
            (F.col(f"hits_{k}") / k).alias("precision"),
            F.when(n > 0, F.col(f"hits_{k}") / n).otherwise(zero).alias("recall"),
            F.when(n > 0, F.col(f"dcg_{k}") / _ideal(n, k)).otherwise(zero).alias("ndcg"),
            F.when(F.col(f"hits_{k}") > 0, 1.0).otherwise(zero).alias("hit"),
        )
        for k in good
    ]
    # k <= 0 is an empty list: every cut-off metric is 0
    rows += [
        F.struct(F.lit(int(k)).alias("k"), *[zero.alias(m) for m in ("precision", "recall", "ndcg", "hit")])
        for k in k_values if k <= 0
    ]
    reciprocal = F.when(F.col("first").isNotNull(), 1.0 / F.col("first")).otherwise(zero)
    return per_user.select(
        user, reciprocal.alias("reciprocal_rank"), F.explode(F.array(*rows)).alias("m")
    ).select(user, "m.k", "m.precision", "m.recall", "m.ndcg", "m.hit", "reciprocal_rank")


def evaluate_model(
    recs: DataFrame,
    relevance: DataFrame,
    k_values: Sequence[int] = K_VALUES,
    max_users: int | None = None,
    user: str = "user_id",
    item: str = "item_id",
) -> DataFrame:
    """Mean metrics as ``(metric, k, value)``, plus ``mrr`` and ``n_users_evaluated`` (k null).

    Only users with at least one relevant item and one recommendation count;
    ``max_users`` takes the first of them by id. Lists are cut at the largest k.
    """
    tested = relevance.select(user).distinct()
    if max_users is not None:
        tested = tested.orderBy(user).limit(max_users)
    top = max(k_values)
    lists = recs.filter(F.col("rank") <= top).join(tested, user, "left_semi")
    per_user = user_metrics(lists, relevance, k_values, user, item)
    names = ("precision", "recall", "ndcg", "hit")
    means = per_user.groupBy("k").agg(
        *[F.avg(m).alias(m) for m in names],
        F.avg("reciprocal_rank").alias("mrr"), F.count(F.lit(1)).alias("n"),
    )
    # one row per requested k, also when nobody could be evaluated
    ks = recs.sparkSession.createDataFrame([(int(k),) for k in k_values], "k int")
    filled = ks.join(means, "k", "left")

    def figure(name: str, value: Column, k: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), k.alias("k"), F.coalesce(value.cast("double"), F.lit(0.0)).alias("value"))

    # both kinds from the same rows, so that the lists are scored once
    no_k = F.lit(None).cast("int")
    cut = F.array(*[figure(m, F.col(m), F.col("k")) for m in names])
    overall = F.array(figure("mrr", F.col("mrr"), no_k), figure("n_users_evaluated", F.col("n"), no_k))
    first = F.col("k") == int(k_values[0])
    return filled.select(F.explode(F.when(first, F.concat(cut, overall)).otherwise(cut)).alias("f")).select("f.*")


def evaluate_model_df(
    recs: DataFrame, test: DataFrame, users: DataFrame, items: DataFrame,
    k_values: Sequence[int] = K_VALUES, max_users: int | None = None,
) -> DataFrame:
    """As ``evaluate_model`` with raw-id test rows: unmapped users and items are dropped.

    ``recs`` holds ``(user_idx, rank, item_idx)``.
    """
    u = users.select(F.col("id").alias("user_id"), F.col("idx").alias("user_idx"))
    i = items.select(F.col("id").alias("item_id"), F.col("idx").alias("item_idx"))
    relevance = test.select("user_id", "item_id").distinct().join(u, "user_id").join(i, "item_id")
    return evaluate_model(recs, relevance, k_values, max_users, "user_idx", "item_idx")


def metric_name(metric: Column | str = "metric", k: Column | str = "k") -> Column:
    """``ndcg@10`` style name; metrics without k keep their plain name."""
    m = F.col(metric) if isinstance(metric, str) else metric
    c = F.col(k) if isinstance(k, str) else k
    return F.when(c.isNull(), m).otherwise(F.concat(m, F.lit("@"), c))


def metrics_table(metrics: DataFrame) -> DataFrame:
    """One row per metric family, one column per k (``at_5``, ...)."""
    ks = F.concat(F.lit("at_"), F.col("k").cast("string"))
    return (
        metrics.filter(F.col("k").isNotNull())
        .withColumn("_c", ks)
        .groupBy("metric")
        .pivot("_c")
        .agg(F.first("value"))
    )


def catalog_coverage(recs: DataFrame, catalog: DataFrame, top: int = 100, item: str = "item_id") -> DataFrame:
    """One row: distinct items within the first ``top`` places, catalog size and their ratio."""
    shown = recs.filter(F.col("rank") <= top).agg(F.countDistinct(item).alias("n_items"))
    size = catalog.agg(F.countDistinct(item).alias("catalog_size"))
    return shown.join(F.broadcast(size)).withColumn(
        "coverage", F.coalesce(F.try_divide("n_items", "catalog_size"), F.lit(0.0))
    )
