"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for every id in ``links (a, b)``; the root is the smallest id reachable.

    Each round joins links with one row per id and writes the new links to the shared
    checkpoint folder, so lineage stays short and hot ids can be split by Spark. Null ends and
    self-links are ignored. The number of rounds is logarithmic in a component's size.
    """
    a, b = F.col("a"), F.col("b")
    edges = cut_lineage(
        links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not mark[0] or mark == seen:
            break
        seen = mark
        # large star: larger neighbours of u go to the smallest in u's neighbourhood
        lowest = cut_lineage(edges.groupBy(a.alias("u")).agg(F.min("b").alias("m")))
        moved = edges.select(b.alias("u"), a.alias("v")).join(lowest, "u", "left")
        large = cut_lineage(
            moved.select(F.col("v").alias("a"), F.coalesce("m", "u").alias("b")).distinct()
        )
        # small star: smaller neighbours of u, and u itself, go to the smallest of them
        least = cut_lineage(large.groupBy(a.alias("u")).agg(F.min("b").alias("m")))
        near = large.select(a.alias("u"), b.alias("v")).join(least, "u")
        small = near.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        edges = cut_lineage(small.unionByName(own).distinct())
    roots = edges.select(a.alias("id"), b.alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct())


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same ids as ``a``-``b``, fewer than there are ids."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y, label[x], label[y]):
            np.minimum.at(new, side, low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[moved], ids[label[moved]]
