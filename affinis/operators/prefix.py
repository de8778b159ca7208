"""Prefix sums, dense numbering and exact quantiles without a global sort in one task.

Keys are first reduced to one row per distinct value, so a value that holds a large
share of the rows is already summed map-side. The distinct values are cut into
buckets by approximate quantiles (a bounded, one-row subquery), each bucket is summed
on its own, and the bucket totals give every bucket its starting offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.session import cut_lineage, fix_partitions

#: Distinct values of a bucket, which one window task adds up.
BUCKET_ROWS = 200_000


def _with_bucket(values: DataFrame, key: str, buckets: int) -> DataFrame:
    """Add ``_b``, a bucket number; boundaries only steer balance, never the result.

    The boundaries are written once, so every use of ``_b`` sees the same ones. A value finds
    its bucket by every so-manieth boundary first and then among the few between two of them.
    """
    if buckets == 1:
        return values.withColumn("_b", F.lit(0))
    probs = [i / buckets for i in range(1, buckets)]
    step = max(1, round(buckets**0.5))
    bounds = cut_lineage(values.agg(F.percentile_approx(F.col(key), probs, max(1000, 10 * buckets)).alias("_bounds")))
    coarse = F.filter("_bounds", lambda _, i: i % step == step - 1)
    one_row = F.broadcast(bounds.select("_bounds", coarse.alias("_coarse"), F.lit(0).alias("_one")))  # always a single row

    def below(c: Column) -> Column:
        return F.size(F.filter(c, lambda b: b < F.col(key)))

    whole = below(F.col("_coarse")) * step
    return (
        values.withColumn("_one", F.lit(0))
        .join(one_row, "_one")
        .withColumn("_whole", F.coalesce(whole, F.lit(0)))
        .withColumn("_b", F.col("_whole") + F.coalesce(below(F.slice("_bounds", F.col("_whole") + 1, F.lit(step))), F.lit(0)))
        .drop("_bounds", "_coarse", "_one", "_whole")
    )


def prefix_sums(
    df: DataFrame,
    key: str,
    weight: Column | None = None,
    group: list[str] | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Running total of ``weight`` (row count by default) over ascending ``key``.

    Returns ``group..., key, w, cum``: one row per distinct key, ``cum`` inclusive. The distinct
    values are written once; their number decides how many buckets there are.
    """
    group = list(group or [])
    weight = F.lit(1) if weight is None else weight
    values = cut_lineage(
        df.filter(F.col(key).isNotNull())
        .groupBy(*group, key)
        .agg(F.sum(weight).cast("bigint").alias("w"))
    )
    placed = _with_bucket(values, key, -(-max(1, values.count()) // bucket_rows))
    # one row per (group, bucket)
    totals = placed.groupBy(*group, "_b").agg(F.sum("w").alias("_t"))
    before = W.partitionBy(*(group or [F.lit(0)])).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*group, "_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inside = W.partitionBy(*group, "_b").orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    running = placed.withColumn("_c", F.sum("w").over(inside))
    joined = running.alias("r").join(
        offsets.alias("o"),
        [F.col(f"r.{g}").eqNullSafe(F.col(f"o.{g}")) for g in group]
        + [F.col("r._b") == F.col("o._b")],
    )
    return joined.select(
        *[F.col(f"r.{g}").alias(g) for g in group],
        F.col(f"r.{key}").alias(key),
        "w",
        (F.col("_c") + F.col("_o")).cast("bigint").alias("cum"),
    )


def order_statistics(df: DataFrame, key: str, positions: dict[str, float], cap: bool = False) -> DataFrame:
    """One row with, per name, the value at 0-based index ``int(n * share)`` of the sorted keys.

    An index equal to ``n`` (share 1) gives null; with ``cap`` it reads the last value.
    """
    sums = prefix_sums(df, key)
    total = df.filter(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("n")).scalar()
    picks = []
    for name, share in positions.items():
        at = F.floor(total * F.lit(float(share)))
        if cap:
            at = F.least(at, total - 1)
        picks.append(
            F.max(F.when((F.col("cum") > at) & (F.col("cum") - F.col("w") <= at), F.col(key))).alias(name)
        )
    return sums.agg(*picks)


def dense_ids(df: DataFrame, key: str, idx: str = "idx") -> DataFrame:
    """Distinct non-null ids in numeric order, numbered 0..n-1: ``(id, idx)``."""
    ids = df.select(F.col(key).cast("bigint").alias("id")).distinct()
    return prefix_sums(ids, "id").select("id", (F.col("cum") - 1).alias(idx))


def row_positions(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """Number all rows 0..n-1 by ``order``, which should identify a row.

    The rows are range-partitioned on the whole key (a hot first column does not
    matter), written once so that partition numbers are fixed, and each partition
    adds the row counts of the partitions before it.
    """
    ordered = fix_partitions(df.repartitionByRange(*order).sortWithinPartitions(*order))
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = ordered.withColumn("_p", F.spark_partition_id()).withColumn("_i", in_part)
    sizes = placed.groupBy("_p").agg((F.max("_i") + 1).alias("_n"))
    # one row per partition
    before = W.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return (
        placed.join(offsets, "_p")
        .withColumn(name, (F.col("_i") + F.col("_o")).cast("bigint"))
        .drop("_p", "_i", "_o")
    )


def quantiles(
    df: DataFrame, value: str, probs: dict[str, float], group: list[str] | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Equals ``numpy.percentile``'s default method. Works from the running counts of the
    distinct values, so no task has to hold a whole group's values.
    """
    group = list(group or [])
    sums = prefix_sums(df, value, group=group)
    counts = (
        df.filter(F.col(value).isNotNull()).groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    )
    if group:
        # one row per group on the right side
        rows = sums.alias("s").join(
            counts.alias("c"), [F.col(f"s.{g}").eqNullSafe(F.col(f"c.{g}")) for g in group]
        ).select(*[F.col(f"s.{g}").alias(g) for g in group], value, "w", "cum", "_n")
        n = F.col("_n")
    else:
        rows, n = sums, counts.scalar()
    lo_hi, out = [], []
    for name, p in probs.items():
        h = (n - 1) * F.lit(float(p))
        for end, at in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            inside = (F.col("cum") > at) & (F.col("cum") - F.col("w") <= at)
            lo_hi.append(F.max(F.when(inside, F.col(value))).alias(f"_{name}_{end}"))
        lo_hi.append(F.max(h - F.floor(h)).alias(f"_{name}_f"))
        lo, hi, f = (F.col(f"_{name}_{e}") for e in ("lo", "hi", "f"))
        out.append((lo + (hi - lo) * f).alias(name))
    return rows.groupBy(*group).agg(*lo_hi).select(*group, *out)
