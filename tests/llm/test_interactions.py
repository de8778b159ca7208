import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from affinis.llm.interactions import audit, failure_cells, interactions
from affinis.llm.queries import QUERIES, SQL
from oracle import same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failures(rows):
    """(part, failed letters, good, toxic) of every row."""
    out = []
    for i, source, text, good, toxic in rows:
        t = text or ""
        w = WORD.findall(t)
        bad = {
            "A": len(w) < 50,
            "B": 100 * len(set(w)) < 65 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": any((r[2] or "") == t and r[0] is not None and (i is None or r[0] < i) for r in rows),
        }
        out.append((source or "", {x for x in bad if bad[x]}, good, toxic))
    return out


def by_hand(docs):
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                failing = [d for d in own if x in d[1]]
                shapley[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(d[1] == {x} for d in own), sum(d[2] == 1 for d in gone), sum(d[3] == 1 for d in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def many(n, tail=""):
    return " ".join(f"w{i}" for i in range(n)) + tail


ROWS = [
    (1, "a", many(60), 1, 0), (2, "a", many(60), 1, 1), (3, "b", many(60), None, None), (None, "b", many(60), None, None), (None, None, many(49), None, None),
    (4, "", "a b " * 40, 0, 1), (5, None, None, 0, 1), (6, "a", "", 1, None), (7, "c", "ABC DEF", 1, 0), (8, "c", many(50, " # X"), 1, 1),
    (9, "a", many(50), 0, 0), (9, "a", many(50), 0, 0), (10, "a", many(50), 0, 0), (11, "b", "x|y " * 60, 0, 0), (12, "a", " \t\n", 1, 1),
    (13, "d", many(30000, " ÀÉ"), 1, 0), (14, "a", "A" + "b" * 19, 0, 1), (15, "a", "A" + "b" * 18, 0, 1),
]


def tables(spark):
    docs = spark.createDataFrame([(r[0], r[1], r[2], "x") for r in ROWS], "doc_id long, source string, text string, mask string")
    known = [(r[0], r[3], r[4]) for r in ROWS if r[3] is not None] + [(1, None, None), (2, 0, 0), (None, 1, 1), (99, 1, 1)]
    return docs.withColumn("part", F.lit("clash")).withColumn("n", F.lit(5)), spark.createDataFrame(known, "doc_id long, quality int, toxic int")


def test_all_orders_like_by_hand(spark):
    docs, labels = tables(spark)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = audit(docs, labels).collect()
    got = {(r.part, r.filter_order, r.step): [r[x] for x in names] for r in rows}
    assert len(rows) == len(got) == 120 * 5 * 5
    assert got == by_hand(failures(ROWS))


def test_empty_tables(spark):
    docs, labels = tables(spark)
    assert audit(docs.limit(0), labels).collect() == []
    assert {r.toxic_lost for r in audit(docs, labels.limit(0)).collect()} == {0}


def test_other_numbers_of_filters(spark):
    cells = spark.createDataFrame([("p", 3, 5, 1, 0), ("p", 2, 4, 0, 2), ("p", 0, 7, 7, 0)], "part string, mask int, n long, good long, toxic long")
    rows = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in interactions(cells, "XY").collect()}
    assert rows == {("XY", 1): (11, 5, 0, 0, 5), ("XY", 2): (7, 4, 5, 4, 13), ("YX", 1): (7, 9, 0, 4, 13), ("YX", 2): (7, 0, 5, 0, 5)}
    with pytest.raises(ValueError):
        interactions(cells, "ABCDEFG")


def test_cells_count_every_row(spark):
    docs, labels = tables(spark)
    assert failure_cells(docs, labels).agg(F.sum("n")).first()[0] == len(ROWS)


def test_query_equals_sql(spark, sf_dir):
    same(QUERIES["op11_filter_interactions"](spark, sf_dir), SQL["op11_filter_interactions"], sf_dir)
