import re
from collections import Counter

from affinis.llm.quality import DecisionList, judge, statistics
from affinis.llm.queries import QUERIES

WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    """The statistics by their definitions."""
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_distinct_words": len(set(words)),
        "n_upper": sum(c.isupper() for c in text),
    }


TEXTS = [
    None, "", " \n\t", "a b c a b c", "a a a a a", "one two\none two\n\n \n \none two ", "É Ünï & x | y\x0bz <b>", "x",
    "a b c d e f g " * 500, "q w e r t y " + "l " * 3, "a b c x a b c y a b c", "日本 語 & 😀 日本 語",
]


def test_statistics_equal_the_definitions(spark):
    df = spark.createDataFrame([(i, t, "n", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words string, _x int")
    got = {r.doc_id: r.asDict() for r in statistics(df, ["doc_id"]).collect()}
    for i, t in enumerate(TEXTS):
        assert {k: got[i][k] for k in plain(t)} == plain(t), t
    assert statistics(df.limit(0), ["doc_id"]).collect() == []


def test_rules_reject_junk_and_keep_clean_text(spark):
    def text(i):
        return " ".join(f"{'w' if i % 4 else '#w'}{(i * j) % 997}" for j in range(1, 60 + i % 50))

    rows = [(i, text(i)) for i in range(400)] + [(None, text(4)), (None, None)]
    labels = [(i, int(i % 4 > 0)) for i in range(0, 400, 2)] + [(2, None), (2, 1), (None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = judge(docs, known).collect()
    assert len(got) == len(rows)
    assert all(r.kept == (r.doc_id % 4 > 0) for r in got if r.doc_id is not None)
    assert not any(r.kept for r in got if r.n_words == 0)
    # without labels, or with good ones only, nothing but the base rejects
    for few in (known.limit(0), known.filter("quality = 1")):
        assert all(r.kept == (not r.base_failed) for r in judge(docs, few).collect())


def test_a_conjunction_is_learned(spark):
    rows = []
    for i in range(900):
        symbols, upper = (i % 3) * 10, (i // 3 % 3) * 10
        rows.append((i, 100, 500, symbols, 0, 0, 80, upper, int(not (symbols > 5 and upper > 5))))
    names = "id n_words word_chars n_symbols n_dup_lines n_repeat_words n_distinct_words n_upper good".split()
    df = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    rules = DecisionList.learn(df, "id", "good")
    assert all(len(r) >= 2 for r in rules.rules)
    got = df.withColumn("kept", rules.keeps()).collect()
    assert all(r.kept == bool(r.good) for r in got)


def test_query_equals_the_definitions(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op1_quality_rules"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        want = plain(docs[r.doc_id])
        assert {k: r[k] for k in want} == want
        assert r.base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert not (r.kept and r.base_failed)
