from collections import Counter

import pytest

from affinis.llm.langid import RankOrder, identify, ngram_counts, profiles
from affinis.llm.queries import QUERIES


def grams(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text).split():
        out.update(f" {word} "[i : i + n] for n in (1, 2, 3) for i in range(len(word) + 3 - n))
    out.pop(" ", None)
    return {g: n for g, n in out.items() if g.strip() and not (len(g) == 3 and g[1] == " ")}


def code(gram):
    return sum(ord(c) << (21 * (len(gram) - 1 - i)) for i, c in enumerate(gram))


@pytest.mark.parametrize("text", ["", "12 !", "a", "the then, the!", "été où", "漢字 かな 漢字", "x" * 50, "ab 1 ab\n\nab"])
def test_counts_equal_the_definition(text):
    codes, counts = ngram_counts(text)
    assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == {code(g): n for g, n in grams(text).items()}


def plain(text, model_rows, size):
    """Out-of-place distance by dictionaries."""
    own = sorted(grams(text.lower()).items(), key=lambda x: (-x[1], code(x[0])))[:size]
    if not own:
        return "und", 0.0
    langs = {}
    for lang, gram, place in model_rows:
        langs.setdefault(lang, {})[gram] = place
    d = {x: sum(abs(p[code(g)] - i) if code(g) in p else size for i, (g, _) in enumerate(own)) for x, p in langs.items()}
    best = min(sorted(d, key=str.encode), key=d.get)
    return best, 1 - d[best] / (size * len(own))


def test_profiles_and_predictions_equal_the_definition(spark):
    rows = [(1, "en", "the cat and the dog and the hat"), (2, "es", "el gato y el perro y la casa"), (3, "en", None),
            (4, None, "le chat"), (5, "en", ""), (6, "es", "La Noche " * 3000), (2, "es", "el gato y el perro y la casa"), (None, "en", "THE END")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    learned = [tuple(r) for r in profiles(df, size=20).collect()]
    for lang in ("en", "es"):
        all_grams = Counter()
        for _, x, t in rows:
            if x == lang and t:
                all_grams.update(grams(t.lower()))
        want = sorted(all_grams.items(), key=lambda x: (-x[1], code(x[0])))[:20]
        assert sorted((p, g) for x, g, p in learned if x == lang) == [(i, code(g)) for i, (g, _) in enumerate(want)]
    model = RankOrder(learned, 20)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in identify(df, model, ["doc_id", "text"]).collect()}
    for i, _, t in rows:
        lang, score = plain(t or "", learned, 20)
        assert got[(i, t)][0] == lang and got[(i, t)][1] == pytest.approx(score)


def test_runs_and_blocks_change_nothing(spark, monkeypatch):
    from affinis.llm import langid

    text = "The cat, the dog; été où 漢字 " * 40 + "x" * 300 + " end"
    whole = ngram_counts(text)
    rows = [(i, f"l{i % 7}", f"{'abcdefg'[i % 7]} word {i} " * 9) for i in range(60)] + [(99, "l1", text), (98, None, text), (97, "l0", None)]
    df = spark.createDataFrame(rows, "score long, lang string, text string")
    model = RankOrder.learn(df)
    want = sorted(identify(df, model, ["score", "text"], names=("a", "b")).collect(), key=str)
    monkeypatch.setattr(langid, "RUN_CHARS", 50)
    monkeypatch.setattr(langid, "MERGE", 20)
    monkeypatch.setattr(langid, "BLOCK_LANGUAGES", 2)
    assert [x.tolist() for x in ngram_counts(text)] == [x.tolist() for x in whole]
    many = RankOrder.learn(df)
    assert len(list(many.blocks())) == 4
    assert sorted(identify(df, many, ["score", "text"], names=("a", "b")).collect(), key=str) == want


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    model = RankOrder.learn(df)
    assert identify(df, model, ["doc_id"]).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in identify(some, model, ["doc_id"]).collect()] == [("und", 0.0)]


def test_held_out_documents_are_recognised(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op3_language_id"](spark, sf_dir).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    right = [r for r in held if r.lang_pred == docs[r.doc_id].lang]
    assert held and len(right) >= 0.95 * len(held)
