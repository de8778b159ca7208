"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.llm.tables import SPACES
from affinis.session import cut_lineage

#: Steps into which the rank keys of a source are cut to find where its sample ends.
STEPS = 4096
#: Bits of the random number of a document.
BITS = 48


def n_words(text: Column) -> Column:
    """Words of a whole text; 0 for null."""
    t = F.coalesce(text, F.lit(""))
    blank = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
    ends = F.substring(t, 1, 1).isin(blank).cast("int") + F.substring(t, -1, 1).isin(blank).cast("int")
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACES)) - ends).cast("bigint")


def targets(sizes: DataFrame, weights: Column, max_copies: int = 3) -> DataFrame:
    """``(source, source_size, target)`` for ``sizes (source, source_size, number)``.

    The sources share the sum of all sizes by weight. No target is above ``max_copies`` times
    its source's size; what is above goes to the others by weight, until none is above. A
    source's cap over its weight decides the order in which caps are met, so one running sum
    over the sources finds the common level. One row per source is worked on, no documents.
    """
    cap = F.col("source_size") * max_copies
    ranked = sizes.withColumn("w", weights.cast("bigint")).withColumn("ratio", cap / F.col("w"))
    order = W.partitionBy(F.lit(0)).orderBy("ratio", "number")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    )
    stepped = ranked.withColumn("level", level)
    # the first source in order that its level does not lift above its cap sets the level of the rest
    found = stepped.withColumn("common", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "number", "level"))).over(every))
    share = F.col("w") * F.col("common.level")
    return found.select("source", "source_size", "number", F.least(cap.cast("double"), share).alias("target"))


def pareto_key(text: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds, put on the scale 0 to 1.

    ``u`` comes from a hash of ``text``, so reruns agree. With q the random odds divided by the
    odds of inclusion, the value is q / (1 + q), which keeps the order of q.
    """
    u = (F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint") + 0.5) / float(1 << BITS)
    top, low = u * (1 - inclusion), (1 - u) * inclusion
    return F.when(inclusion <= 0, F.lit(1.0)).when(inclusion >= 1, F.lit(0.0)).otherwise(top / (top + low))


#: Repeated rows that are numbered together.
REPEATS = 1 << 16


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number for each of several equal rows, in ``again``, from 1.

    Equal rows are counted map-side and made again from the count, a bounded number in a task.
    """
    counted = cut_lineage(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")))
    once = counted.filter("n = 1").withColumn("again", F.lit(1).cast("bigint"))
    parts = counted.filter("n > 1").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / REPEATS))))
    first = F.col("part") * REPEATS + 1
    several = parts.repartition(*rows.columns, "part").withColumn(
        "again", F.explode(F.sequence(first, F.least(F.col("n"), first + (REPEATS - 1))))
    )
    return once.drop("n").unionByName(several.drop("n", "part"))


def inclusion_levels(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """``(number, level, certain)``: a document of ``size`` words is taken with probability
    ``level * size``, and for certain if it has more words than ``certain``.

    Probabilities go with size as far as they stay below 1, and expect ``rest`` words from a
    source. Larger documents become certain one size after the other; one row per source and
    size is worked on.
    """
    sizes = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    placed = sizes.join(goal, sizes.source.eqNullSafe(goal.source)).select("number", "rest", "source_size", "size", "n")
    upto = W.partitionBy("number").orderBy("size")
    words = F.col("size") * F.col("n")
    above = F.col("source_size") - F.sum(words).over(upto)
    squares = F.sum(words * F.col("size")).over(upto)
    level = F.when(squares > 0, (F.col("rest") - above) / squares)
    fits = placed.withColumn("level", level).filter(F.col("level") * F.col("size") <= 1)
    return fits.groupBy("number").agg(F.max(F.struct("size", "level")).alias("x")).select("number", F.col("x.level").alias("level"), F.col("x.size").alias("certain"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", cycle: int = 3, max_copies: int = 3, seed: int = 0) -> DataFrame:
    """How often the mix takes every document: ``(id, source, size, source_size, target, copies, inclusion)``.

    Sources by code point, null last, weigh 1, 2, ..., ``cycle``, repeating. Each document of a
    source is taken for certain as many whole times as the target holds the source. The rest is
    a sample by Pareto order: a document is to be taken once more with probability ``inclusion``,
    in proportion to its size, certain for those that would be above 1 (``inclusion_levels``);
    documents are ranked by random odds over inclusion odds, and those before the point nearest
    the remaining number of words are taken. So a source's words miss its target by half a document
    at most, and no document is taken more than ``max_copies`` times. Ranking needs no sort of a
    whole source: words are summed in ``STEPS`` steps of the key, and only the step in which the
    sample ends is sorted.

    The random number comes from ``seed``, id, text and, for equal rows, their number, so reruns
    agree and rows without an id or with the same one have numbers of their own. Null and empty
    texts have size 0 and count no words. Repeated rows are documents of their own. Other columns
    are ignored.
    """
    text = F.col(text_col).cast("string")
    rows = cut_lineage(
        _numbered(
            docs.select(
                F.col(id_col).cast("bigint").alias("id"),
                F.col(source_col).cast("string").alias("source"),
                n_words(text).alias("size"),
                F.md5(F.coalesce(text, F.lit(""))).alias("digest"),
            )
        ).withColumn("name", F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")), "digest", F.col("again").cast("string")))
        .drop("digest", "again")
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())  # one row per source
    numbered = sizes.withColumn("number", F.row_number().over(by_name) - 1)
    goal = targets(numbered, F.col("number") % cycle + 1, max_copies)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio).cast("bigint")
    goal = cut_lineage(goal.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    goal = cut_lineage(goal.join(inclusion_levels(rows, goal), "number", "left"))
    # both sides are stored tables, so that Spark can split a hot source
    same = F.col("r.source").eqNullSafe(F.col("g.source"))
    placed = rows.alias("r").join(goal.alias("g"), same).select("r.*", *[f"g.{x}" for x in ("source_size", "number", "target", "whole", "rest", "level", "certain")])
    share = F.coalesce(F.col("level") * F.col("size"), F.lit(0.0))
    placed = placed.withColumn("inclusion", F.when(F.col("size") > F.col("certain"), F.lit(1.0)).otherwise(share))
    keyed = placed.withColumn("key", pareto_key(F.col("name"), F.col("inclusion"))).withColumn(
        "step", F.least(F.floor(F.col("key") * STEPS), F.lit(STEPS - 1)).cast("int")
    )
    # at most STEPS rows a source
    steps = keyed.groupBy("number", "step", "rest").agg(F.sum("size").alias("words"))
    running = W.partitionBy("number").orderBy("step")
    before = F.coalesce(F.sum("words").over(running.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edge = cut_lineage(
        steps.withColumn("before", before)
        .filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
        .select("number", F.col("step").alias("edge"), "before")
    )
    joined = keyed.join(edge, "number", "left")
    # without an edge the source has no words
    sure = F.coalesce(F.col("step") < F.col("edge"), F.lit(True))
    inside = F.coalesce(F.col("step") == F.col("edge"), F.lit(False))
    order = W.partitionBy("number").orderBy("key", F.col("id").asc_nulls_last(), "size").rowsBetween(W.unboundedPreceding, -1)
    at_edge = joined.filter(inside)
    cut = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("size") / 2
    columns = ["id", "source", "size", "source_size", "target", (F.col("whole") + F.col("more")).alias("copies"), "inclusion"]
    return (
        at_edge.withColumn("more", ((cut <= F.col("rest")) & (F.col("inclusion") > 0)).cast("bigint"))
        .select(*columns)
        .unionByName(joined.filter(~inside).withColumn("more", (sure & (F.col("inclusion") > 0)).cast("bigint")).select(*columns))
    )
