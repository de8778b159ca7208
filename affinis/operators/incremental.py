"""Item-item similarities kept up to date batch by batch.

The state is a folder of generations, one a batch. Each holds what its batch changed: the
interactions, cells of ``X'X``, squared norms and counts of items, and new ids. Sums over the
generations are the state; a batch reads only the histories of its own users, and writes only
cells that it changes. A generation counts once its row in the manifest is written, so a lost
job leaves nothing half done and is simply run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.operators.item_item import topk_neighbors
from affinis.operators.prefix import dense_ids
from affinis.session import cut_lineage

#: Folders that histories are dealt to by user, so that a batch opens only those of its users.
BUCKETS = 64
#: Generations that are merged into one.
COMPACT = 16

_TABLES = {
    "interactions": "u bigint, i bigint, v double, bucket int",
    "cells": "item_i bigint, item_j bigint, dot double",
    "items": "i bigint, n2 double, users bigint",
    "user_ids": "id bigint, idx bigint",
    "item_ids": "id bigint, idx bigint",
}


class IncrementalItemItem:
    """Co-occurrence, norms, popularity and id maps under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, compact: int = COMPACT):
        self.spark, self.path, self.buckets, self.compact_at = spark, path, buckets, compact

    # --- generations ---

    def _manifest(self) -> list[tuple[int, str, list[int]]]:
        """(generation, batch, generations it replaces); one row for each batch since the last merge."""
        try:
            rows = self.spark.read.schema("gen int, batch string, replaces array<int>").parquet(f"{self.path}/manifest").collect()
        except Exception as e:  # nothing yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        return sorted((r.gen, r.batch, r.replaces or []) for r in rows)

    def _live(self) -> list[int]:
        rows = self._manifest()
        gone = {g for _, _, old in rows for g in old}
        return [g for g, _, _ in rows if g not in gone]

    def batches(self) -> list[str]:
        """Batches added so far."""
        return sorted({b for _, b, _ in self._manifest() if b})

    def _commit(self, gen: int, batch: str | None, replaces: list[int]) -> None:
        row = self.spark.createDataFrame([(gen, batch, replaces)], "gen int, batch string, replaces array<int>")
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def _folder(self, gen: int, name: str) -> str:
        return f"{self.path}/gen-{gen:06d}/{name}"

    def _write(self, gen: int, name: str, df: DataFrame) -> None:
        writer = df.write.mode("overwrite")  # of an unfinished try only
        if name == "interactions":
            writer = writer.partitionBy("bucket")
        writer.parquet(self._folder(gen, name))

    def _table(self, name: str) -> DataFrame:
        live = self._live()
        read = self.spark.read.schema(_TABLES[name])
        parts = [read.parquet(self._folder(g, name)) for g in live]
        if not parts:
            return self.spark.createDataFrame([], _TABLES[name])
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # --- state ---

    def interactions(self) -> DataFrame:
        """``(u, i, v)``: the current value of every pair."""
        return self._table("interactions").groupBy("u", "i").agg(F.sum("v").alias("v")).filter("v <> 0")

    def cooccurrence(self) -> DataFrame:
        """``(item_i, item_j, dot)`` with ``item_i < item_j``."""
        return self._table("cells").groupBy("item_i", "item_j").agg(F.sum("dot").alias("dot")).filter("dot <> 0")

    def items(self) -> DataFrame:
        """``(i, n2, users)``: squared norm and number of users of each item."""
        return self._table("items").groupBy("i").agg(F.sum("n2").alias("n2"), F.sum("users").alias("users")).filter("users > 0")

    def popularity(self) -> DataFrame:
        """``(item_id, users)`` of all items that someone has."""
        return self.items().select(F.col("i").alias("item_id"), "users")

    def ids(self, side: str) -> DataFrame:
        """``(id, idx)`` of ``user`` or ``item``; ids keep their index, new ones follow."""
        return self._table(f"{side}_ids")

    def edges(self, k_neighbors: int | None = 50, min_similarity: float = 0.0) -> DataFrame:
        """What ``item_item_fit`` gives for all interactions added so far."""
        items = cut_lineage(self.items())
        both = self.cooccurrence().join(items.select(F.col("i").alias("item_i"), F.col("n2").alias("a")), "item_i")
        both = both.join(items.select(F.col("i").alias("item_j"), F.col("n2").alias("b")), "item_j")
        sims = both.select("item_i", "item_j", (F.col("dot") / F.sqrt(F.col("a") * F.col("b"))).alias("sim"))
        if min_similarity > 0:
            sims = sims.filter(F.col("sim") >= min_similarity)
        pairs = F.array(F.struct("item_i", "item_j"), F.struct(F.col("item_j").alias("item_i"), F.col("item_i").alias("item_j")))
        sims = sims.select(F.explode(pairs).alias("p"), "sim").select("p.item_i", "p.item_j", "sim")
        return sims if k_neighbors is None else topk_neighbors(sims, k_neighbors)

    # --- changes ---

    def add(self, batch: DataFrame, name: str, user: str = "user_id", item: str = "item_id", value: str = "value") -> bool:
        """Adds a batch of interactions; False if a batch of that name was added before.

        A pair that is there already takes the batch's value (zero takes it away); of several values
        in the batch the greatest counts. Rows with a null are left out.
        """
        if name in self.batches():
            return False
        gen = max((g for g, _, _ in self._manifest()), default=-1) + 1
        rows = batch.select(
            F.col(user).cast("bigint").alias("u"), F.col(item).cast("bigint").alias("i"), F.col(value).cast("double").alias("v")
        ).dropna()
        fresh = cut_lineage(
            rows.groupBy("u", "i").agg(F.max("v").alias("new")).withColumn("bucket", F.pmod(F.xxhash64("u"), F.lit(self.buckets)).cast("int"))
        )
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # BUCKETS at most
        users = fresh.select("u").distinct()
        history = (
            self._table("interactions").filter(F.col("bucket").isin(touched)).join(users, "u", "left_semi")
            .groupBy("u", "i").agg(F.sum("v").alias("old"))
        )
        # the whole history of the batch's users, before and after
        state = cut_lineage(
            history.join(fresh, ["u", "i"], "full").select(
                "u", "i", F.coalesce("old", F.lit(0.0)).alias("old"), F.coalesce("new", "old").alias("new")
            )
        )
        changed = cut_lineage(state.filter("old <> new"))
        bucket = F.pmod(F.xxhash64("u"), F.lit(self.buckets)).cast("int")
        self._write(gen, "interactions", changed.select("u", "i", (F.col("new") - F.col("old")).alias("v"), bucket.alias("bucket")))
        # (i, j) with a changed i; a pair of two changed ones counts once
        x, y = changed.alias("x"), state.alias("y")
        moved = F.col("y.old") != F.col("y.new")
        gain = F.col("x.new") * F.col("y.new") - F.col("x.old") * F.col("y.old")
        pairs = x.join(y, F.col("x.u") == F.col("y.u")).filter((F.col("x.i") != F.col("y.i")) & (~moved | (F.col("x.i") < F.col("y.i"))))
        cells = pairs.select(F.least("x.i", "y.i").alias("item_i"), F.greatest("x.i", "y.i").alias("item_j"), gain.alias("dot"))
        self._write(gen, "cells", cells.groupBy("item_i", "item_j").agg(F.sum("dot").alias("dot")).filter("dot <> 0"))
        squares = F.sum(F.col("new") * F.col("new") - F.col("old") * F.col("old")).alias("n2")
        count = F.sum((F.col("new") != 0).cast("bigint") - (F.col("old") != 0).cast("bigint")).alias("users")
        self._write(gen, "items", changed.groupBy("i").agg(squares, count))
        for side, column in (("user", "u"), ("item", "i")):
            known = self.ids(side)
            new_ids = changed.select(F.col(column).alias("id")).distinct().join(known, "id", "left_anti")
            start = known.agg(F.coalesce(F.max("idx") + 1, F.lit(0))).first()[0]
            numbered = dense_ids(new_ids, "id").select("id", (F.col("idx") + start).cast("bigint").alias("idx"))
            self._write(gen, f"{side}_ids", numbered)
        self._commit(gen, name, [])
        if len(self._live()) >= self.compact_at:
            self.compact()
        return True

    def compact(self) -> None:
        """Merges all generations into one; the old ones stay until ``path`` is cleaned up."""
        live = self._live()
        gen = max(live) + 1
        bucket = F.pmod(F.xxhash64("u"), F.lit(self.buckets)).cast("int")
        self._write(gen, "interactions", self.interactions().withColumn("bucket", bucket))
        self._write(gen, "cells", self.cooccurrence())
        self._write(gen, "items", self.items())
        for side in ("user", "item"):
            self._write(gen, f"{side}_ids", self.ids(side))
        self._commit(gen, None, live)
