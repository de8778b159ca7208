import random
import re

import numpy as np

from affinis.llm import contamination as c
from affinis.llm.queries import QUERIES


def tokens(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def distance(a, b):
    """Smallest edit distance of ``a`` to a part of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return min(row)


def test_edit_match():
    rng = random.Random(4)
    for _ in range(50):
        a = [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]
        b = [rng.choice("abcd") for _ in range(rng.randrange(0, 25))]
        d, start, end = c.edit_match(a, b, 99)
        assert d == distance(a, b) == distance(a, b[start:end])
    assert c.edit_match(["a", "b"], ["x", "y"], 1) is None


def test_blocks_find_every_allowed_edit():
    for n in range(5, 90):
        q, offsets = c.blocks(n)
        assert len(offsets) == c.edits_allowed(n) + 1 and q >= 1
        ends = [*offsets[1:], n]
        assert all(e - o >= q for o, e in zip(offsets, ends, strict=True))


def test_embedding_keeps_equal_rows_together():
    rng = np.random.default_rng(0)
    x = rng.integers(1, 2**63, (50, 30)).astype(np.uint64)
    y = x.copy()
    y[:, 10] = 7
    sizes = np.full(50, 30)
    places = np.tile(np.arange(90), (50, 1))
    same = (c.embed(x, sizes, places, 1) == c.embed(y, sizes, places, 1)).mean()
    far = (c.embed(x, sizes, places, 1) == c.embed(x[::-1], sizes, places, 1)).mean()
    assert same > 0.75 and far < 0.5
    assert (c.lsh_keys(x, sizes, 3) == c.lsh_keys(x.copy(), sizes, 3)).all()
    assert 2 <= c.repetitions_needed() < 200


def test_planted_items(spark):
    rng = random.Random(9)
    text = lambda n: [f"v{rng.randrange(10**5)}" for _ in range(n)]
    items = {i: text(rng.choice([6, 15, 40, 70])) for i in range(12)}
    docs = {}
    for k in range(240):
        i = k % 12
        part = list(items[i])
        for _ in range(c.edits_allowed(len(part)) if k % 3 else 0):
            at, kind = rng.randrange(len(part)), rng.randrange(3)
            if kind == 0:
                part[at] = "edited"
            elif kind == 1:
                part.insert(at, "more")
            else:
                del part[at]
        docs[k] = text(rng.randrange(120)) + part + text(rng.randrange(120))
    for k in range(240, 300):
        docs[k] = text(200)
    rows = [(k, " ".join(w).upper() + "!", "clash") for k, w in docs.items()] + [(None, " ".join(docs[0]), "x"), (301, None, "x"), (302, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, item string")
    bench = spark.createDataFrame([(i, ", ".join(w)) for i, w in items.items()] + [(90, None), (91, "a b"), (None, "q r s t u v")], "item_id long, text string")
    got = {(r.doc, r.item): r.distance for r in c.leaks(df, bench).collect()}
    want = {(k, i): d for k, w in docs.items() for i, x in items.items() if (d := distance(x, w)) <= c.edits_allowed(len(x))}
    assert {k for k in got if k[0] is not None} <= set(want) and (None, 0) in got
    assert len([k for k in want if k in got]) >= 0.98 * len(want)
    assert c.leaks(df.limit(0), bench).collect() == [] and c.leaks(df, bench.limit(0)).collect() == []


def test_query_equals_brute_force(spark, sf_dir):
    docs = {r.doc_id: tokens(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: tokens(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    want = set()
    for i, x in items.items():
        ids = {t: k for k, t in enumerate(sorted(set(x)))}
        a = np.array([ids[t] for t in x])
        for k, w in docs.items():
            b = np.array([ids.get(t, -1) for t in w])
            if len(b) and (b >= 0).any() and c._distances(a, b, True).min() <= c.edits_allowed(len(x)):
                want.add((k, i))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_benchmark_leaks"](spark, sf_dir).collect()}
    assert want and got <= want and len(got) >= 0.98 * len(want)
