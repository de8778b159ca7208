import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from affinis.llm import spread
from affinis.llm.lines import dedup_lines
from affinis.llm.queries import QUERIES, SQL
from oracle import same

LAST = (1 << 63) - 1


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def by_hand(rows, chars=10, least=2):
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= chars:
                held[key(line)].add(LAST if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < least or (LAST if i is None else i) == min(held[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LONG = "\n".join(f"line {i % 700} of a long text" for i in range(4000))
ROWS = [
    (3, "A shared line\nown line of three\n a SHARED line \t"), (1, "x\na shared line\na shared line\n"), (2, "a shared line"),
    (None, "a shared line\nonly null ids here"), (None, "only null ids here\nÀ shared line"), (4, None), (5, ""), (6, "\n\n"),
    (7, "short\nÀ Shared Line\r\ntail"), (8, "short\nà shared line\ntail"), (9, "À shared line "), (9, "another text\nown of nine lines"),
    (9, "own of nine lines"), (10, "own of nine lines"), (11, "exact row\nown of nine lines"), (11, "exact row\nown of nine lines"),
    (12, LONG), (13, LONG + "\nand its end here"), (14, "123456789\n1234567890"), (15, "123456789\n1234567890"), (-5, "own line of three"),
]


@pytest.mark.parametrize("least", [2, 3])
@pytest.mark.parametrize("frequent", [4096, 1 << 40])
def test_lines_like_by_hand(spark, monkeypatch, least, frequent):
    monkeypatch.setattr(spread, "FREQUENT", frequent)  # all shared keys are frequent with the larger one
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    for name in ("line", "pos", "doc", "t", "h1", "n", "first", "gone", "id", "kept"):
        df = df.withColumn(name, F.lit("clash"))
    got = sorted(map(tuple, dedup_lines(df.repartition(3), least_docs=least).collect()), key=repr)
    assert got == by_hand(ROWS, least=least)


def test_empty_table(spark):
    df = spark.createDataFrame(ROWS[:1], "doc_id long, text string")
    assert dedup_lines(df.limit(0)).collect() == []


def test_a_line_that_a_third_of_all_rows_hold(spark):
    rows = [(i, f"the same line again\nown line number {i}" if i % 3 else f"other line number {i}\n") for i in range(600)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(rows)


def test_query_equals_sql(spark, sf_dir):
    same(QUERIES["op12_line_dedup"](spark, sf_dir), SQL["op12_line_dedup"], sf_dir)
