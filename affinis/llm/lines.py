"""Line de-duplication: lines that several documents hold stay in the first of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.spread import LAST, join_spread, wide_hash
from affinis.llm.tables import let
from affinis.session import cut_lineage

#: Least code points of a line's key, and documents that must hold it, for the line to be dropped.
LEAST_CHARS, LEAST_DOCS = 10, 2

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased and no other letters."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """``(id, n_lines, n_dropped, kept)`` of every row: its text without repeated lines.

    Texts are split at line feeds. Of a key (see ``line_key``) with at least ``least_chars`` code
    points that at least ``least_docs`` documents hold, all lines go but those of the document
    with the smallest id, which keeps all of its own. Other lines stay, in order.

    Lines travel as hashes of 128 bits with document and position, never as text. Documents are
    counted for each hash after map-side sums; the rows of a very frequent line stay in place
    while the line's document is broadcast (``join_spread``). The positions that go meet the
    texts again in one shuffle.

    A null or empty text is one empty line. Rows that share an id are one document to the counts,
    and each gives a row of its own; null ids are one document after all others. Other columns,
    whatever their names, are ignored. No rows give no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")
    )
    # equal rows have equal results, so id and text tell a row
    texts = rows.select("id", F.coalesce("id", F.lit(LAST)).alias("doc"), "t", *[h.alias(n) for h, n in zip(wide_hash(F.col("t")), ("t1", "t2"), strict=True)])
    exploded = texts.select("doc", "t1", "t2", F.posexplode(F.split("t", "\n")).alias("pos", "line"))
    keyed = exploded.withColumn("line", line_key(F.col("line"))).filter(F.char_length("line") >= least_chars)
    lines = cut_lineage(keyed.select(*wide_hash(F.col("line")), "doc", "t1", "t2", "pos"))
    held = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first"), F.max("doc").alias("last"))
    shared = held.filter("first < last").drop("last")  # at least two documents
    if least_docs > 2:
        counted = lines.select("h1", "h2", "doc").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"))
        shared = shared.join(counted.filter(F.col("docs") >= least_docs).drop("docs"), ["h1", "h2"])
    later = join_spread(lines, cut_lineage(shared), ["h1", "h2"], "n").filter("doc > first")
    # at most as many positions as the text has lines
    gone = cut_lineage(later.groupBy("doc", "t1", "t2").agg(F.collect_set("pos").alias("gone")))
    parts = F.split("t", "\n")
    left = let(
        parts,
        lambda p: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), F.col("gone")), lambda i: F.get(p, i)), "\n"),
    )
    return texts.join(gone, ["doc", "t1", "t2"], "left").select(
        "id",
        F.size(parts).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("t")).otherwise(left).alias("kept"),
    )
