import re
from collections import defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_contamination import tokens
from test_mixing import check
from test_simhash import fingerprint, grouped

from affinis.llm import contamination, stages
from affinis.session import cut_lineage


def plain_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def runs(t, n=50):
    w = plain_words(t)
    return {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], sf_dir)))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "substring_dedup", "decontaminate", "mix_sources"]
    assert all(s.dtypes == steps[0].dtypes for s in steps[1:5])


def test_language_stage_keeps_text_with_letters(steps):
    before, after = by_id(steps[0]), by_id(steps[1])
    assert set(after) == {i for i, r in before.items() if any(c.isalpha() for c in r.text or "")}


def test_one_document_of_each_group_stays(steps):
    before, after = by_id(steps[1]), by_id(steps[2])
    roots = grouped([(i, fingerprint(r.text)) for i, r in before.items()])
    assert set(after) == set(roots.values())
    assert all(after[i] == before[i] for i in after)


def test_repeated_passages_go_and_clean_documents_stay(steps):
    before, after = by_id(steps[2]), by_id(steps[3])
    first = {}
    for i in sorted(before):
        for r in runs(before[i].text):
            first.setdefault(r, []).append(i)
    repeated = {i for ids in first.values() for i in ids[1:]}
    for i, r in before.items():
        if i in after and after[i].text == r.text:
            assert i not in repeated
            assert after[i] == r
    for i in set(before) - repeated:  # changed only if a near-duplicate was found
        assert i in after
    left = defaultdict(list)
    for i, r in after.items():
        for x in runs(r.text):
            left[x].append(i)
        assert r.n_chars == len(r.text)
    assert not [x for x, ids in left.items() if len(set(ids)) > 1]
    kept = {x for r in after.values() for x in runs(r.text)}
    assert all(ids[0] in repeated or ids[0] in after for ids in first.values()) and kept


def test_contaminated_documents_go(spark, sf_dir, steps):
    before, after = by_id(steps[3]), by_id(steps[4])
    items = [tokens(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {i for i, r in before.items() if any(contamination.edit_match(x, tokens(r.text), contamination.edits_allowed(len(x))) for x in items)}
    assert set(after) >= set(before) - bad
    assert len(set(after) & bad) <= 0.02 * len(bad)


def test_mix_follows_the_targets(steps):
    docs = [(r.source, len(plain_words(r.text))) for r in steps[4].collect()]
    rows = steps[5].collect()
    check(rows, docs, max(n for _, n in docs))
    assert all(r.copies > 0 for r in rows)


def test_run_gives_the_rows_of_the_stages(spark, sf_dir, steps):
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(str, steps[5].collect()))


def test_nulls_repeats_and_empty_tables(spark, sf_dir):
    long = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(90))
    rows = [(1, "en", "a", 3, "the cat"), (1, "en", "a", 3, "the cat"), (None, "en", None, None, "the cat"), (None, None, "a", 1, "a dog sat"),
            (None, None, "a", 1, "a dog sat"), (2, "en", "a", 1, None), (3, None, None, 1, "12 ..."), (4, "en", "a", 400, long + " " + other), (5, "en", "b", 9, "q r s " + long)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long, text string")
    kept = stages.language_id(spark, docs, sf_dir)
    assert kept.count() == 7
    kept = stages.simhash_dedup(spark, kept, sf_dir)
    assert sorted((r.doc_id or -1, r.text[:5]) for r in kept.collect()) == [(-1, "a dog"), (1, "the c"), (4, "w0 w1"), (5, "q r s")]
    kept = stages.substring_dedup(spark, kept, sf_dir)
    assert {r.doc_id: (r.text, r.n_chars) for r in kept.collect() if r.doc_id} == {1: ("the cat", 3), 4: (long + " " + other, 400), 5: ("q r s ", 6)}
    kept = stages.decontaminate(spark, kept, sf_dir)
    assert kept.count() == 4
    assert {r.doc_id for r in stages.mix_sources(spark, kept, sf_dir).collect()} <= {None, 1, 4, 5}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).collect() == []


def words_of(rng, n):
    return " ".join(f"{'abcdefghij'[rng.randrange(10)]}{'aeiou'[rng.randrange(5)]}{rng.randrange(10**6)}" for _ in range(n))


def test_clashing_names_and_ids_lose_nothing(spark, sf_dir):
    import random

    rng = random.Random(3)
    one, two, three = words_of(rng, 80), words_of(rng, 90), words_of(rng, 70)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    rows = [
        (1, one, 1), (1, two, 2), (1, two, 3), (1, two, 3), (2, words_of(rng, 20) + " " + two, 4), (None, three, 5), (None, three, 6),
        (None, words_of(rng, 60), 7), (9, "before " + item + " after", 8), (9, words_of(rng, 60), 9), (4, words_of(rng, 30000), 10), (5, None, 11),
    ]
    names = ["score", "lang_pred", "_id", "_n", "_spans", "id", "row", "t", "made", "given", "spans", "language", "fit", "doc", "component", "c0"]
    docs = spark.createDataFrame([(i, "en", "s", 1, t, *[k] * len(names)) for i, t, k in rows], f"doc_id long, lang string, source string, n_chars long, text string, {', '.join(f'{n} int' for n in names)}")
    tag = lambda df: sorted(r.score for r in df.collect())
    kept = {name: stage(spark, docs, sf_dir) for name, stage in corpus_pipeline.STAGES[:4]}
    assert all(df.dtypes == docs.dtypes for df in kept.values())
    for df in kept.values():
        assert all(r._id == r._n == r._spans == r.row == r.c0 == r.lang_pred == r.score for r in df.collect())
    assert tag(kept["language_id"]) == [r[2] for r in rows if r[1] is not None for _ in [0]]
    assert tag(kept["simhash_dedup"]) in ([1, 2, 4, 5, 7, 8, 9, 10, 11], [1, 3, 4, 5, 7, 8, 9, 10, 11])
    cut = {r.score: r.text for r in kept["substring_dedup"].collect()}
    assert cut[1] == one and cut[8] == rows[8][1] and cut[10] == rows[10][1] and cut[11] is None
    assert (2 in cut and cut[2] == two and cut[4] != rows[4][1]) or (2 not in cut and cut[4] == rows[4][1])
    assert cut.get(3) == cut.get(2) and cut[5] == cut[6] == three  # repeated rows are not cut against each other
    assert tag(kept["decontaminate"]) == [1, 2, 3, 3, 4, 5, 6, 7, 9, 10, 11]


@pytest.mark.parametrize("text", [
    "Litwo Ojczyzno moja ty jesteś jak zdrowie ile cię trzeba cenić ten tylko się dowie kto cię stracił",
    "Mieleni minun tekevi aivoni ajattelevi lähteäni laulamahan saa'ani sanelemahan sukuvirttä suoltamahan",
    "Они были там вчера и видели его",
])
def test_other_languages_are_rejected(spark, sf_dir, text):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    other = docs.limit(1).selectExpr("-1L doc_id", f'"{text}" text', "CAST(NULL AS STRING) lang", "source", "n_chars").select(*docs.columns)
    kept = {r.doc_id for r in stages.language_id(spark, docs.unionByName(other), sf_dir).collect()}
    assert -1 not in kept and len(kept) >= docs.filter("text rlike '[a-zA-Z]'").count()


def test_cutting():
    assert stages._without("a b\nc  d e", [(1, 3)]) == "a d e"
    assert stages._without("a b", [(0, 2)]) == ""
    assert stages._without(" é b c", [(0, 1), (0, 2)]) == " c"


def test_language_threshold_is_the_median_of_all_labelled_documents(spark):
    fit = (F.col("id") * F.col("id")) / 1e9  # a part of the rows would have another median
    rows = spark.range(30_001).select(F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit("en").alias("language"), fit.alias("fit"))
    other = spark.createDataFrame([("x", "en", "de", 9.0), (None, "en", "en", 9.0), ("x", None, "en", 9.0)], "text string, lang string, language string, fit double")
    assert stages._threshold(rows.unionByName(other), "language", "fit") == pytest.approx(stages.LANGUAGE_SHARE * 15_000**2 / 1e9, rel=1e-12)
    assert stages._threshold(other, "language", "fit") == 0.0
