import random
import re

from affinis.llm import licenses
from affinis.llm.queries import QUERIES


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def shingles(w):
    return [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]


def plain(rows, templates):
    """{(id, license): best containment of any window}."""
    out = {}
    for name, t in templates.items():
        want = shingles(words(t))
        m, step = len(want), max(1, len(want) // 2)
        for i, text in rows:
            have = shingles(words(text))
            for s in range(0, len(have), step):
                c = len(set(want) & set(have[s : s + 2 * m])) / len(set(want))
                if c >= 0.8 and c > out.get((i, name), (0,))[0]:
                    out[i, name] = (c, s)
    return out


def test_templates_are_found_and_other_text_is_left(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join(f"t{rng.randrange(9999)}" for _ in range(n))
    rows = []
    for k, (name, t) in enumerate(sorted(licenses.TEMPLATES.items()) * 3):
        w = t.split()
        if k % 3 == 1 and len(w) > 30:
            w[15] = "changed"
        rows.append((k, f"{filler(rng.randrange(80))}\n# {' '.join(w).upper()} {filler(rng.randrange(80))}"))
    rows += [(100 + k, filler(100)) for k in range(20)] + [(200, None), (201, ""), (202, "under the MIT License"), (None, rows[0][1]), (1, rows[1][1])]
    rows += [(203, filler(3000) + " " + licenses.TEMPLATES["mit-notice"] + " " + filler(3000)), (204, (licenses.TEMPLATES["mit-statement"] + " ") * 50)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, license string")
    got = {(r.doc_id, r.license): (r.containment, r.start_word) for r in licenses.scan(df).collect()}
    want = plain(rows, licenses.TEMPLATES)
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want)
    assert all(got[k][0] >= 0.8 and got[k] == want[k] or got[k][0] <= want[k][0] for k in got)
    assert {i for i, _ in got} >= {*range(45), 203, 204, None}
    assert licenses.scan(df.limit(0)).collect() == [] and licenses.scan(df, {}).collect() == [] and licenses.scan(df, {"a": "too short"}).collect() == []


def test_bands_reach_the_recall():
    least = licenses.CONTAINED / (3 - licenses.CONTAINED)
    assert 1 - (1 - least) ** licenses.band_count() >= licenses.RECALL


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = plain(rows, licenses.TEMPLATES)
    got = {(r.doc_id, r.license): (r.containment, r.start_word) for r in QUERIES["op4_license_scan"](spark, sf_dir).collect()}
    assert want and set(got) <= set(want) and len(got) >= 0.99 * len(want)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op4_license_scan"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "Python" not in plan
