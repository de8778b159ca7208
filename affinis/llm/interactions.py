"""How filters interact: what each step of every filter order removes, and what was gone before."""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.mixing import n_words
from affinis.llm.spread import LAST, join_spread, wide_hash
from affinis.llm.tables import SPACES
from affinis.session import cut_lineage

#: Filters that can be audited: orders grow with the factorial, and recursion is bounded.
MOST_FILTERS = 6
#: The letter of the filter for repeated texts, the last one.
REPEATED = "E"


def text_failures(text: Column) -> list[tuple[str, Column]]:
    """Letters and failure conditions that depend on the text alone."""
    parts = F.split(text, SPACES)
    words = n_words(text)
    distinct = F.size(F.array_distinct(parts)) - F.array_contains(parts, "").cast("int")
    upper = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        ("A", words < 50),
        ("B", 100 * distinct < 65 * words),
        ("C", 100 * upper > 5 * F.char_length(text)),
        ("D", text.rlike("[#$%&*|]")),
    ]


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by source and by the set of filters they fail.

    Bit i of the mask stands for filter i of ``text_failures``; the bit after those for a text
    that a row with a smaller id has too, in any source. Null texts are empty ones, null sources
    ''. A null id comes after all others, has no label, and does not repeat another null id;
    rows that share an id count each and do not repeat each other. Of several labels of an
    id, one with the value 1 is enough. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("t")
    )
    failed = text_failures(F.col("t"))
    bits = [F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, fails) in enumerate(failed)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    marked = cut_lineage(
        rows.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "part", mask.alias("mask"), *wide_hash(F.col("t")))
    )
    texts = marked.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first")).filter("n > 1")
    repeats = (F.coalesce("first", "doc") < F.col("doc")).cast("int") * (1 << len(failed))
    placed = join_spread(marked, cut_lineage(texts), ["h1", "h2"], "n", "left").select(
        "doc_id", "part", F.col("mask").bitwiseOR(repeats).alias("mask")
    )
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality", "toxic").filter("doc_id IS NOT NULL")
    is_one = [F.max(F.coalesce(F.col(x) == 1, F.lit(False)).cast("int")).alias(y) for x, y in (("quality", "good"), ("toxic", "toxic"))]
    marks = cut_lineage(known.groupBy("doc_id").agg(*is_one))
    placed = cut_lineage(placed)
    none = F.lit(0)
    labelled = placed.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left").select(
        "part", "mask", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic")
    )
    unknown = placed.filter("doc_id IS NULL").select("part", "mask", none.alias("good"), none.alias("toxic"))
    return labelled.unionByName(unknown).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )


#: Every prefix of every order with every mask; one level of recursion adds one letter.
WALK = """
WITH RECURSIVE walk (prefix, applied, bit, mask) AS (
  SELECT CAST('' AS STRING), 0, 0, mask FROM {masks}
  UNION ALL
  SELECT concat(prefix, letter), applied | bit, CAST(shiftleft(1, locate(letter, '%(letters)s') - 1) AS INT), mask
  FROM walk LATERAL VIEW explode(filter(split('%(letters)s', ''), x -> locate(x, prefix) = 0)) AS letter
)
SELECT prefix, mask,
       CAST(mask & (applied | bit) = 0 AS BIGINT) AS kept,
       CAST(mask & bit <> 0 AND mask & applied = 0 AS BIGINT) AS removed,
       CAST(mask & bit <> 0 AND mask & applied <> 0 AS BIGINT) AS redundant,
       CAST(mask = bit AS BIGINT) AS unique_fails
FROM walk WHERE prefix <> ''
"""


def interactions(cells: DataFrame, letters: str) -> DataFrame:
    """For every order of the filters, step and part, what the step does.

    ``cells (part, mask, n, good, toxic)`` counts documents by the filters they fail, bit i for
    ``letters[i]``. A recursive query extends prefixes of filters by unused letters and carries
    the applied bits along with the masks; each level gives its step's effect on every mask. As
    masks and prefixes depend on the filters only (at most 2**filters times the prefixes),
    recursion works on a fixed number of rows, and the parts' counts are joined to them by mask.
    A prefix is worked out once for all orders that begin with it.

    ``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley)``; a part has a row for every order and step, zeros included. No cells, no rows.
    """
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"1 to {MOST_FILTERS} different letters, not {letters!r}")
    spark = cells.sparkSession
    cells = cut_lineage(cells)
    # 2 ** filters rows at most
    masks = cut_lineage(cells.select("mask").distinct().coalesce(1))
    walk = cut_lineage(spark.sql(WALK % {"letters": letters}, masks=masks).coalesce(1))
    sums = {"kept": "kept", "removed": "removed", "redundant": "redundant", "unique_fails": "unique_fails"}
    steps = cut_lineage(
        cells.join(F.broadcast(walk), "mask")  # a fixed number of rows for each filter count
        .groupBy("part", "prefix")
        .agg(
            *[F.sum(F.col("n") * F.col(x)).alias(y) for x, y in sums.items()],
            *[F.sum(F.col(x) * F.col("removed")).alias(f"{x}_lost") for x in ("good", "toxic")],
        )
        .withColumn("letter", F.substring("prefix", -1, 1))
    )
    # a prefix of k filters begins (filters - k)! orders
    begun = F.element_at(F.array(*[F.lit(factorial(len(letters) - k)) for k in range(1, len(letters) + 1)]), F.length("prefix"))
    shares = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * begun).alias("shapley"))
    orders = walk.filter(F.length("prefix") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
    numbered = orders.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters))))).withColumn(
        "prefix", F.expr("substring(filter_order, 1, step)")
    )
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return steps.join(F.broadcast(numbered), "prefix").join(shares, ["part", "letter"]).select(*names)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``interactions`` of the filters of ``failure_cells`` on whole documents."""
    letters = "".join(x for x, _ in text_failures(F.lit(""))) + REPEATED
    return interactions(failure_cells(docs, labels), letters)
