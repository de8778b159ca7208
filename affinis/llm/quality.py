"""Quality rules: text statistics and a decision list learned from labels by sequential covering."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.tables import let, word_array
from affinis.session import cut_lineage

#: Quantiles of each feature that can be thresholds.
THRESHOLDS = 32
#: Parameters of learning: conditions of a rule, rules of a list, least precision, least rows.
MAX_CONDITIONS, MAX_RULES, PRECISION, MIN_ROWS = 4, 16, 0.9, 5


def features() -> dict[str, Column]:
    """Features of the rules, from the statistics of a text with words."""
    n = F.col("n_words")
    return {
        "words": n.cast("double"),
        "word_length": F.col("word_chars") / n,
        "symbols": F.col("n_symbols") / n,
        "dup_lines": F.col("n_dup_lines") / n,
        "repeated": F.col("n_repeat_words") / n,
        "distinct": F.col("n_distinct_words") / n,
        "upper": F.col("n_upper") / F.col("word_chars"),
    }


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more.

    Windows are compared by 64-bit hashes, sorted with their places, so that the cost is
    n log n for any text.
    """

    def covered(found: Column) -> Column:
        again = F.filter(
            found,
            lambda x, i: F.coalesce(F.get(found, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(found, i + 1)["h"] == x["h"], F.lit(False)),
        )
        places = F.flatten(F.transform(again, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
        return F.size(F.array_distinct(places))

    def windows(h: Column) -> Column:
        made = F.transform(
            F.sequence(F.lit(0), F.size(h) - 3),
            lambda i: F.struct(F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)).alias("h"), i.alias("p")),
        )
        return let(F.sort_array(made), covered)

    hashed = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(words) >= 4, hashed).otherwise(F.lit(0))


def statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` and the statistics of every whole text, as longs.

    ``n_words``; ``word_chars``, code points in words; ``n_symbols``, characters of
    ``#*$%&|<>``; ``n_dup_lines``, lines with a word equal to an earlier line;
    ``n_repeat_words``, words in 3-word windows found twice or more, the first included;
    ``n_distinct_words``; ``n_upper``, upper-case letters. A null text is like an empty one: all 0.
    """
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*keep, t.alias("_t"), word_array(t).alias("_w"))
    text, words = F.col("_t"), F.col("_w")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    made = {
        "n_words": F.size(words),
        "word_chars": F.length(F.concat_ws("", words)),
        "n_symbols": F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeat_words(words),
        "n_distinct_words": F.size(F.array_distinct(words)),
        "n_upper": F.length(text) - F.length(F.regexp_replace(text, "\\p{Lu}+", "")),
    }
    return rows.select(*keep, *[c.cast("bigint").alias(k) for k, c in made.items()])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``feature <= threshold`` or ``feature > threshold``."""

    feature: str
    above: bool
    threshold: float
    bin: int

    def on_bins(self) -> Column:
        place = F.col("bins")[self.feature]
        return place > self.bin if self.above else place <= self.bin

    def expression(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


def _all(conditions: list[Condition], how) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & how(c)
    return out


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the thresholds are below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts or [0.0])), lambda c: c < value))


class DecisionList:
    """An ordered list of rules; the first that holds rejects a document, else it is kept."""

    def __init__(self, rules: list[list[Condition]]):
        self.rules = rules

    def keeps(self) -> Column:
        """Spark's conditional expression over the statistics."""
        if not self.rules:
            return F.lit(True)
        out = None
        for rule in self.rules:
            test = F.coalesce(_all(rule, Condition.expression), F.lit(False))
            out = F.when(test, False) if out is None else out.when(test, False)
        return out.otherwise(True)

    @classmethod
    def learn(cls, labelled: DataFrame, id_col: str, good_col: str) -> DecisionList:
        """Sequential covering over all labelled rows with words (``good_col`` 1 good, 0 bad).

        Thresholds lie midway between neighbouring quantiles. Two thirds of the rows, by a hash of the id, grow rules, the
        rest prune them. A rule grows by the condition of the best information gain, read from
        one table of counts by feature, bin and label; it is then cut back while that improves
        it on the pruning rows, and is taken if it is precise there. Rows that it covers are
        done. Each step reads one aggregate of ``THRESHOLDS`` rows a feature; no row leaves the
        executors. Null labels are ignored; without bad rows the list is empty.
        """
        values = features()
        rows = labelled.filter(F.col(good_col).isNotNull() & (F.col("n_words") > 0))
        shares = [i / THRESHOLDS for i in range(THRESHOLDS + 1)]
        found = rows.agg(*[F.percentile_approx(v, shares, 10_000).alias(k) for k, v in values.items()]).first()
        points = {k: sorted({float(x) for x in found[k] or ()}) for k in values}
        cuts = {k: [(a + b) / 2 for a, b in pairwise(x)] for k, x in points.items()}
        place = {k: _bin(v, cuts[k]) for k, v in values.items()}
        table = cut_lineage(
            rows.select(
                F.struct(*[p.cast("int").alias(k) for k, p in place.items()]).alias("bins"),
                (F.col(good_col) == 0).cast("bigint").alias("bad"),
                (F.pmod(F.xxhash64(F.col(id_col)), F.lit(3)) == 0).alias("prune"),
            )
            .groupBy("bins", "bad", "prune")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        rules: list[list[Condition]] = []
        left = F.lit(True)
        while len(rules) < MAX_RULES:
            rule = cls._grow(table.filter(left & ~F.col("prune")), cuts)
            rule = cls._prune(table.filter(left & F.col("prune")), rule)
            if not rule:
                break
            rules.append(rule)
            left = left & ~_all(rule, Condition.on_bins)
        return cls(rules)

    @staticmethod
    def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> list[Condition]:
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            each = F.explode(F.array(*[F.struct(F.lit(k).alias("f"), F.col("bins")[k].alias("b")) for k in cuts]))
            counts = (
                rows.filter(_all(rule, Condition.on_bins))
                .select(each.alias("x"), "bad", "n")
                .groupBy("x.f", "x.b")
                .agg(F.sum(F.col("bad") * F.col("n")).alias("p"), F.sum("n").alias("n"))
                .collect()
            )
            some = next(iter(cuts))
            p0 = sum(r.p for r in counts if r.f == some)
            n0 = sum(r.n for r in counts if r.f == some)
            if not p0 or p0 == n0:
                break
            best, gain = None, 0.0
            for f, thresholds in cuts.items():
                by_bin = {r.b: (r.p, r.n) for r in counts if r.f == f}
                p = n = 0
                for b, t in enumerate(thresholds):
                    p, n = p + by_bin.get(b, (0, 0))[0], n + by_bin.get(b, (0, 0))[1]
                    for above, (x, y) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        if x >= MIN_ROWS and y < n0:
                            g = x * (log2(x / y) - log2(p0 / n0))
                            if g > gain + 1e-9:
                                best, gain = Condition(f, above, t, b), g
            if best is None:
                break
            rule.append(best)
        return rule

    @staticmethod
    def _prune(rows: DataFrame, rule: list[Condition]) -> list[Condition]:
        """The beginning of the rule that is best on ``rows``; none if it is not precise."""
        if not rule:
            return []
        n = F.col("n")
        counts = rows.agg(
            *[
                F.coalesce(F.sum(F.when(_all(rule[:k], Condition.on_bins), n * c)), F.lit(0)).alias(f"{name}{k}")
                for k in range(1, len(rule) + 1)
                for name, c in (("p", F.col("bad")), ("n", 1 - F.col("bad")))
            ]
        ).first()
        worth = lambda k: (counts[f"p{k}"] - counts[f"n{k}"]) / max(1, counts[f"p{k}"] + counts[f"n{k}"])
        best = max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))
        p, wrong = counts[f"p{best}"], counts[f"n{best}"]
        return rule[:best] if p >= MIN_ROWS and p >= PRECISION * (p + wrong) else []


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good_col: str = "quality") -> DataFrame:
    """``(id, statistics..., base_failed, kept)`` for every row.

    ``base_failed``: under 50 words, or over half of the words in repeated windows. The list is
    learned from labelled documents that pass this base. Null and empty texts fail it. Null ids
    have no label; repeated rows and labels each count; other columns are ignored.
    """
    counted = cut_lineage(statistics(docs.withColumn("_id", F.col(id_col)), ["_id"], text_col)).withColumn("base_failed", base_failed())
    known = labels.select(F.col(id_col).alias("_id"), F.col(good_col).alias("_good"))
    rules = DecisionList.learn(counted.filter(~F.col("base_failed")).join(known, "_id"), "_id", "_good")
    return counted.withColumn("kept", ~F.col("base_failed") & rules.keeps()).withColumnRenamed("_id", id_col)
