import pytest
from pyspark.sql import functions as F

from affinis.functions import text as fx
from affinis.functions import vectors as vx

TITLES = [
    ("Toy Story (1995)", 1995, "Toy Story"),
    ("2001: A Space Odyssey (1968)", 1968, "2001: A Space Odyssey"),
    ("Some Movie", None, "Some Movie"),
    ("Movie (abc)", None, "Movie (abc)"),
    ("", None, ""),
    ("English Patient, The (1996)", 1996, "The English Patient"),
    ("A  B (1995) ", 1995, "A B"),
    ("X, the (1993)", 1993, "the X"),
    ("Amélie, An (2001) ", 2001, "An Amélie"),
    (None, None, None),
]


def test_titles(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(TITLES)], "i int, t string")
    out = df.select("i", fx.extract_year("t").alias("y"), fx.clean_title("t").alias("c")).orderBy("i").collect()
    assert [(r.y, r.c) for r in out] == [(y, c) for _, y, c in TITLES]


def test_genres(spark):
    df = spark.createDataFrame([(1, "t", 1990, 1, 0, None), (2, "u", None, 0, 1, 1)], "item_id int, title string, year int, a int, b int, c int")
    arr = df.select("item_id", "title", "year", fx.genre_array({"A": "a", "B": "b", "C": "c"}).alias("genres"))
    rows = arr.orderBy("item_id").collect()
    assert [r.genres for r in rows] == [["A"], ["B", "C"]]
    wide = fx.genre_onehot(arr, ["A", "B", "C"])
    assert wide.columns == ["item_id", "title", "year", "A", "B", "C"]
    assert [tuple(r)[3:] for r in wide.orderBy("item_id").collect()] == [(1, 0, 0), (0, 1, 1)]
    assert len(fx.GENRES) == 19


def test_labels_and_reasons(spark):
    df = spark.createDataFrame(
        [(None,), ("",), ("popularity",), ("popularity:genre=Film-Noir",), ("similar_to_seed:12",), ("unknown_user",)],
        "r string",
    )
    out = df.select("r", fx.fallback_kind("r").alias("k"), fx.fallback_argument("r").alias("a")).collect()
    assert [(r.k, r.a) for r in out] == [
        (None, None), (None, None), ("popularity", None), ("genre", "Film-Noir"), ("seed", "12"), ("other", None),
    ]
    one = spark.range(1).select(
        fx.title_label(F.lit("Heat"), F.lit(1995)).alias("a"),
        fx.title_label(F.lit("Heat"), F.lit(None).cast("int")).alias("b"),
        fx.genre_label(F.array().cast("array<string>")).alias("c"),
        fx.sanitize_metric(F.lit("ndcg@10")).alias("d"),
        fx.version_string(F.expr("timestamp_ntz'2026-01-08 16:39:08'")).alias("e"),
        fx.ts_to_string(F.lit(886759441)).alias("f"),
    ).first()
    assert tuple(one) == ("Heat (1995)", "Heat", "Unknown", "ndcg_at_10", "v20260108_163908", "1998-02-06 10:04:01")


@pytest.mark.parametrize("text,want", [("[1,2]", [1, 2]), ("[]", []), ("bad", None), ("null", None), ("5", None), ("{}", None), (None, None)])
def test_json_ids(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(fx.json_ids("t")).first()[0] == want


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    out = df.select(vx.dot("a", "b").alias("d"), vx.l2_normalize("a").alias("u"), vx.has_dim("a", 3).alias("ok")).collect()
    assert out[0].d == 11.0 and out[0].u == pytest.approx([0.6, 0.8]) and not out[0].ok
    assert out[1].u == [0.0, 0.0]


def test_a_vector_is_measured_once(spark):
    df = spark.createDataFrame([([3.0, 4.0, 0.0],), ([],), (None,), ([1.0, None, 0.0],)], "a array<double>")
    unit = df.select(vx.l2_normalize("a").alias("u"))
    assert [r.u for r in unit.collect()] == [pytest.approx([0.6, 0.8, 0.0]), [], None, [None, None, None]]
    # no place of the vector asks for the length again
    places = unit._jdf.queryExecution().optimizedPlan().toString()
    assert "/ (SQRT" not in places and places.count("SQRT") == 1


def test_request_ids_are_unique(spark):
    ids = spark.range(200).select(fx.request_id().alias("r"))
    assert ids.distinct().count() == 200
