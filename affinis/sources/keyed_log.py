"""A request log that keeps the first row of every request id, over any span of time.

Beside the rows, each append leaves an index generation: the ids it added, dealt to ``buckets``
folders by hash, and a Bloom filter for each bucket, cut into blocks of a bounded number of ids. An
append looks each id up in one block of its bucket's filter and opens only id folders whose filter
lets one of them through, so what it reads grows with the batch. A generation counts once its manifest row is written; an append
that was lost is simply run again under the same name. ``fan_in`` generations of a level are
merged into one of the next, so that their number stays logarithmic in the number of appends.
One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.session import cut_lineage, drop_stages, stage_count
from affinis.sources.request_log import LOG_SCHEMA, new_rows

#: Bits for each id and places set for it: about one id in 2000 passes a filter by chance.
BITS_PER_ID, HASHES = 16, 8
#: Ids of a filter's block, on average. Blocks are what ids are joined with, so they stay small.
BLOCK_IDS = 256

_MANIFEST = "gen int, batch string, level int, replaces array<int>"
_FILTER = "gen int, bucket int, bits bigint, words array<bigint>, blocks bigint, block bigint"


def _places(request_id, bits):
    """The places of an id in a filter of ``bits`` bits."""
    first, step = (F.pmod(F.xxhash64(request_id, F.lit(salt)), F.lit(2**31)) for salt in (1, 2))
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda n: F.pmod(first + n * step, bits))


def _block(request_id, blocks):
    """The block of an id in a filter of that many."""
    return F.pmod(F.xxhash64(request_id, F.lit(3)), blocks)


def _one_at(place):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))


class KeyedLog:
    """Rows under ``path/rows`` by generation and date, ids and filters under ``path/index``."""

    def __init__(
        self, spark: SparkSession, path: str, buckets: int = 64, schema: str = LOG_SCHEMA, fan_in: int = 8
    ) -> None:
        self.spark, self.path, self.buckets, self.schema, self.fan_in = spark, path, buckets, schema, fan_in
        self.opened: list[tuple[int, int]] = []  # (generation, bucket) read by the last append

    def on(self, spark: SparkSession) -> KeyedLog:
        """The same log in another session, such as that of a stream's batches."""
        return KeyedLog(spark, self.path, self.buckets, self.schema, self.fan_in)

    def _manifest(self) -> DataFrame:
        read = self.spark.read.schema(_MANIFEST)
        try:
            return read.parquet(f"{self.path}/manifest")
        except Exception as e:  # nothing yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], _MANIFEST)

    def generations(self) -> dict[int, int]:
        """Level of each generation that no merge replaced: fewer than ``fan_in`` a level."""
        made = self._manifest()
        merged = made.select(F.explode("replaces").alias("gen"))
        live = made.join(merged, "gen", "left_anti").select("gen", F.coalesce("level", F.lit(0)).alias("level"))
        return {r.gen: r.level for r in live.collect()}

    def holds(self, name: str) -> bool:
        """Whether a batch of that name was added."""
        return not self._manifest().filter(F.col("batch") == name).isEmpty()

    def _folder(self, part: str, gen: int) -> str:
        return f"{self.path}/{part}/gen={gen:06d}"

    def _read(self, part: str, folders: list[str], schema: str) -> DataFrame:
        """The folders of a part as one scan."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(f"{schema}, gen int").option("basePath", f"{self.path}/{part}")
        return read.parquet(*folders).drop("gen")

    def _part(self, part: str, gens, schema: str) -> DataFrame:
        return self._read(part, [self._folder(part, g) for g in gens], schema)

    def rows(self) -> DataFrame | None:
        """All rows logged so far; None before the first append."""
        gens = sorted(self.generations())
        return self._part("rows", gens, f"{self.schema}, date date") if gens else None

    def append(self, batch: DataFrame, name: str) -> bool:
        """Adds the rows of new ids; False if a batch of that name was added before.

        Of repeated ids in a batch the earliest row stays. Rows without an id are left out.
        """
        self.opened = []
        if self.holds(name):
            return False
        mark = stage_count()
        bucket = F.pmod(F.xxhash64("request_id", F.lit(7)), F.lit(self.buckets)).cast("int")
        first = cut_lineage(new_rows(batch.filter("request_id IS NOT NULL")).withColumn("bucket", bucket))
        live = self.generations()
        if live:
            first = first.join(self._known(first.select("request_id", "bucket"), sorted(live)), "request_id", "left_anti")
        fresh = cut_lineage(first)
        rows = fresh.drop("bucket").withColumn("date", F.to_date("timestamp"))
        gen = max(live, default=-1) + 1
        self._write(gen, rows, fresh.select("request_id", "bucket"), name, 0, [])
        drop_stages(self.spark, mark)
        self._merge({**live, gen: 0})
        return True

    def _write(self, gen: int, rows: DataFrame, ids: DataFrame, name: str | None, level: int, replaces: list[int]) -> None:
        """Rows, ids and filters, and last the manifest row that makes them count."""
        rows.write.mode("overwrite").partitionBy("date").parquet(self._folder("rows", gen))
        ids.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._folder("index/ids", gen))
        written = self._part("index/ids", [gen], "request_id string, bucket int")
        self._filters(written, gen).write.mode("overwrite").parquet(self._folder("index/filters", gen))
        manifest = self.spark.createDataFrame([(gen, name, level, replaces)], _MANIFEST)
        manifest.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def _merge(self, live: dict[int, int]) -> None:
        """Merges levels with ``fan_in`` generations. Their folders stay for readers that opened them, until ``vacuum``."""
        level = 0
        while len(gens := sorted(g for g, at in live.items() if at == level)) >= self.fan_in:
            gen = max(live) + 1
            rows = self._part("rows", gens, f"{self.schema}, date date")
            ids = self._part("index/ids", gens, "request_id string, bucket int")
            self._write(gen, rows, ids, None, level + 1, gens)
            live = {g: at for g, at in live.items() if g not in gens} | {gen: level + 1}
            level += 1

    def vacuum(self) -> int:
        """Deletes the folders of merged generations; returns the number of generations deleted.

        Folders above the last live generation may belong to an append that is still writing and stay.
        """
        live, sc = self.generations(), self.spark.sparkContext
        gone = set()
        for part in ("rows", "index/ids", "index/filters"):
            root = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
            fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
            for status in fs.listStatus(root) if live else []:
                gen = int(status.getPath().getName().removeprefix("gen="))
                if gen < max(live) and gen not in live and fs.delete(status.getPath(), True):
                    gone.add(gen)
        return len(gone)

    def _filters(self, ids: DataFrame, gen: int) -> DataFrame:
        blocks = F.ceil(F.col("n") / BLOCK_IDS)
        bits = (F.ceil(F.col("n") * BITS_PER_ID / blocks / 64) * 64).cast("bigint")
        # one row a bucket
        sizes = cut_lineage(ids.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select("bucket", blocks.cast("bigint").alias("blocks"), bits.alias("bits")))
        key = ["bucket", "blocks", "bits", "block"]
        placed = ids.join(sizes, "bucket").withColumn("block", _block("request_id", F.col("blocks")))
        set_bits = placed.select(*key, F.explode(_places("request_id", F.col("bits"))).alias("p"))
        word = F.bit_or(_one_at(F.col("p"))).alias("word")
        words = set_bits.groupBy(*key, F.floor(F.col("p") / 64).alias("at")).agg(word)
        # the words of a block that are not zero, put in their places
        held = words.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("m"))
        all_words = F.transform(
            F.sequence(F.lit(0).cast("bigint"), (F.col("bits") / 64 - 1).cast("bigint")),
            lambda n: F.coalesce(F.try_element_at("m", n), F.lit(0).cast("bigint")),
        )
        return held.select(F.lit(gen).alias("gen"), "bucket", "bits", all_words.alias("words"), "blocks", "block")

    def _known(self, ids: DataFrame, gens: list[int]) -> DataFrame:
        """Ids of the batch that the log holds."""
        # the filters bring their own generation, beside the folder's
        filters = self.spark.read.schema(_FILTER).parquet(*[self._folder("index/filters", g) for g in gens])
        # a filter written before there were blocks is one block
        filters = filters.withColumns({"blocks": F.coalesce("blocks", F.lit(1)), "block": F.coalesce("block", F.lit(0))})
        # one row a bucket and live generation
        sizes = cut_lineage(filters.select("gen", "bucket", "blocks").distinct())
        sought = ids.join(sizes, "bucket").withColumn("block", _block("request_id", F.col("blocks")))

        def is_set(place):
            word = F.element_at(F.col("words"), (F.floor(place / 64) + 1).cast("int"))
            return word.bitwiseAND(_one_at(place)) != 0

        passed = sought.join(filters.drop("blocks"), ["gen", "bucket", "block"]).filter(F.forall(_places("request_id", F.col("bits")), is_set))
        maybe = cut_lineage(passed.select("request_id", "gen", "bucket"))
        # at most buckets x live generations
        self.opened = sorted((r.gen, r.bucket) for r in maybe.select("gen", "bucket").distinct().collect())
        folders = [f"{self._folder('index/ids', g)}/bucket={b}" for g, b in self.opened]
        held = self._read("index/ids", folders, "request_id string, bucket int")
        return maybe.select("request_id").distinct().join(held.select("request_id"), "request_id", "left_semi")
