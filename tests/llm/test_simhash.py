import re

import numpy as np
import pytest
import xxhash

from affinis.llm.components import components, forest
from affinis.llm.simhash import near_duplicates, near_links, segments


def fingerprint(text):
    """Bit by bit, from the definition."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(rows, distance=4):
    """{id: smallest id reachable}, comparing all pairs."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, f in rows:
        for j, g in rows:
            if i < j and bin(f ^ g).count("1") <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i, _ in rows}


TEXTS = [
    "one two three four five six", "One  TWO\nthree four five\tsix", "a b", "", None, " \n ", "a b", "x",
    "é ü ÀB c d", " a b c d e", "one two three four five six seven eight nine ten eleven twelve " * 400,
]


def test_fingerprints_and_groups_equal_the_definition(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, id long")
    got = {r.id: (r.fp & (2**64 - 1), r.component) for r in near_duplicates(df).collect()}
    want = [(i, fingerprint(t)) for i, t in enumerate(TEXTS)]
    roots = grouped(want)
    assert got == {i: (f, roots[i]) for i, f in want}


def test_documents_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = [(r.doc_id, fingerprint(r.text)) for r in docs.collect()]
    roots = grouped(want)
    got = {r.id: (r.fp & (2**64 - 1), r.component) for r in near_duplicates(docs).collect()}
    assert got == {i: (f, roots[i]) for i, f in want}


def test_null_ids_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b"), (None, "q r s t u")], "doc_id long, text string")
    got = sorted((r.id or -1, r.component or -1) for r in near_duplicates(df).collect())
    assert got == [(-1, -1), (-1, 3), (3, 3), (3, 3)]
    assert near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 6])
def test_segments_cover_the_distance(distance):
    assert sum(r + 1 for _, _, r in segments(distance)) > distance
    assert all(s + w <= 64 for s, w, _ in segments(distance))


def test_hot_segments_keep_all_links(spark, monkeypatch):
    from affinis.llm import simhash

    monkeypatch.setattr(simhash, "CELL", 16)
    rng = np.random.default_rng(5)
    centre = 0x123456789ABCDEF0
    fps = {centre ^ sum(1 << int(b) for b in set(rng.integers(0, 64, n))) for n in rng.integers(0, 9, 300)}
    fps |= {int(x) for x in rng.integers(0, 2**63, 200)}
    df = spark.createDataFrame([((f ^ (1 << 63)) - (1 << 63),) for f in fps], "fp long")
    got = {r.id & (2**64 - 1): r.root & (2**64 - 1) for r in components(near_links(df.repartition(3))).collect()}
    want = grouped([(f, f) for f in fps])
    groups = lambda m: sorted(sorted(k for k in fps if m.get(k, k) == v) for v in {m.get(k, k) for k in fps})
    assert groups(got) == groups(want)


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 340)] + [(1, 2), (2, 3), (3, 1), (9, 9), (None, 4)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.root for r in components(df).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(300, 340)]} | {1: 1, 2: 1, 3: 1}
    assert components(df.limit(0)).collect() == []


def test_forest_joins_what_the_links_join():
    a, b = np.array([5, 6, 7, 1, 2]), np.array([6, 7, 5, 2, 1])
    x, y = forest(a, b)
    assert sorted(zip(x.tolist(), y.tolist(), strict=True)) == [(2, 1), (6, 5), (7, 5)]
