from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from affinis.llm.mixing import mix, n_words
from affinis.llm.queries import QUERIES, SQL
from oracle import same


def water_fill(sizes, weights, most=3):
    """Targets by resharing the excess again and again."""
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        w = sum(weights[s] for s in sizes if s not in capped)
        share = {s: left * weights[s] / w for s in sizes if s not in capped}
        over = {s: most * sizes[s] for s in share if share[s] > most * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def check(rows, docs, slack):
    sizes = defaultdict(int)
    for s, n in docs:
        sizes[s] += n
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = water_fill(sizes, {s: i % 3 + 1 for i, s in enumerate(names)})
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r.copies <= 3
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack / 2 + 1e-6


def test_targets_and_samples(spark):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate([("a", 900), ("b", 5), ("b", 2), ("c", 100)] * 20 + [(None, 7)] * 30 + [("z", 0), ("é", 3)])]
    rows += [(5, "a", "x y")] * 3 + [(None, "c", "t t t"), (None, "c", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash"))
    got = mix(df).collect()
    assert len(got) == len(rows)
    check(got, [(s, len((t or "").split())) for _, s, t in rows], 900)
    again = mix(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_documents_are_included_in_proportion_to_size(spark):
    from math import sqrt

    rows = [(None, "a", "w " * (n + 1)) for n in (0, 3, 9) for _ in range(3000)] + [(7, "a", "w " * 3000)] * 2
    rows += [(i, "b", "w " * 40) for i in range(500)] + [(None, "c", "x " * 5)] * 2000
    got = mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    check(got, [(s, len(t.split())) for _, s, t in rows], 3000)
    for source in "abc":
        own = [r for r in got if r.source == source]
        whole, rest = divmod(own[0].target, own[0].source_size)
        assert sum(r.inclusion * r.size for r in own) == pytest.approx(rest)
        for size in {r.size for r in own}:
            same_size = [r for r in own if r.size == size]
            want, n = same_size[0].inclusion, len(same_size)
            taken = sum(r.copies - whole for r in same_size) / n
            assert abs(taken - want) <= 4 * sqrt(want * (1 - want) / n) + 2 / n, (source, size)
    level = {r.size: r.inclusion for r in got if r.source == "a"}
    assert level[3000] == 1 and level[10] == pytest.approx(10 * level[1]) and 0 < level[4] < 1


def test_empty_and_wordless_tables(spark):
    df = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert [(r.size, r.target, r.copies) for r in mix(df).collect()] == [(0, 0.0, 0)] * 2
    assert mix(df.limit(0)).collect() == []


def test_word_counts(spark):
    texts = ["", None, " ", "a", " a b\n", "\x0b\x0c\r", "a b c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(n_words(F.col("t"))).collect()] == [0, 0, 0, 1, 2, 0, 2]


def test_long_step_keeps_to_the_target(spark, monkeypatch):
    from affinis.llm import mixing

    monkeypatch.setattr(mixing, "STEPS", 1)  # everything is sorted in the step of the edge
    rows = [(i, "ab"[i % 2], "w " * (i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    one = sorted(map(str, mix(df).collect()))
    monkeypatch.undo()
    assert one == sorted(map(str, mix(df).collect()))


def test_query_equals_sql(spark, sf_dir):
    same(QUERIES["op9_mix_sources"](spark, sf_dir), SQL["op9_mix_sources"], sf_dir)
