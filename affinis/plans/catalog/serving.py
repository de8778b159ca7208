"""Request tables answered in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions import text as fx
from affinis.operators import filters, serve
from affinis.plans import testdata as td
from affinis.plans.catalog import sql as q
from affinis.plans.catalog.registry import prepared, query

# Features are known for every part; items outside the part table show the missing-feature rules.
_FEATURES = "features AS (SELECT * FROM items)"
_G = "array_to_string(genres, '|') AS genres"


def _features(spark, sf):
    return td.items(spark, sf)


def _flat(df):
    return df.withColumn("genres", F.concat_ws("|", "genres"))


@query(
    "popular_by_genre",
    q.POPULAR + """SELECT genre, row_number() OVER (PARTITION BY genre ORDER BY popularity_rank, item_id) AS rank, item_id,
      interaction_count AS score, popularity_rank, title, year
    FROM (SELECT p.*, title, year, unnest(list_distinct(genres)) AS genre FROM popularity p JOIN items USING (item_id)) QUALIFY rank <= 10""",
)
def popular_by_genre(spark, sf):
    return serve.popular_by_genre(prepared(spark, sf).popularity, td.items(spark, sf), 10)


# --- filters on candidate rows --------------------------------------------------------

_CANDIDATES = """candidates AS (
  SELECT l.request_id, l.item_id, r.genres AS wanted, r.year_min, r.year_max, f.genres, f.year, f.title
  FROM (SELECT request_id, CASE WHEN id % 7 = 0 THEN id + 100000000 ELSE id END AS item_id FROM (SELECT request_id, unnest(ids) AS id FROM parsed_log)) l JOIN requests r USING (request_id) LEFT JOIN features f ON f.item_id = l.item_id)"""
_CAND = q.with_(q.LOG, q.REQUESTS, q.ITEMS, _FEATURES, _CANDIDATES)


def _shown(spark, sf):
    shown = td.request_log(spark, sf).select("request_id", F.explode(fx.json_ids("recommendations")).alias("id"))
    outside = F.when(F.col("id") % 7 == 0, F.col("id") + 100_000_000).otherwise(F.col("id"))
    return shown.select("request_id", outside.alias("item_id"))


def _candidates(spark, sf):
    asked = td.requests(spark, sf).select("request_id", F.col("genres").alias("wanted"), "year_min", "year_max")
    return _shown(spark, sf).join(asked, "request_id").join(
        _features(spark, sf).select("item_id", "genres", "year"), "item_id", "left"
    )


@query(
    "filter_genres_any",
    _CAND + "SELECT request_id, item_id FROM candidates WHERE wanted IS NULL OR genres IS NULL OR list_has_any(genres, wanted)",
)
def filter_genres_any(spark, sf):
    return filters.filter_genres_any(_candidates(spark, sf), F.col("wanted")).select("request_id", "item_id")


@query(
    "filter_genre_one",
    _CAND + "SELECT request_id, item_id FROM candidates WHERE wanted IS NULL OR coalesce(list_contains(genres, wanted[1]), false)",
)
def filter_genre_one(spark, sf):
    first = F.try_element_at("wanted", F.lit(1))
    return filters.filter_genre_one(_candidates(spark, sf), first).select("request_id", "item_id")


@query(
    "filter_year",
    _CAND + """SELECT request_id, item_id FROM candidates WHERE (year_min IS NULL OR year IS NULL OR year >= year_min)
      AND (year_max IS NULL OR year IS NULL OR year <= year_max)""",
)
def filter_year(spark, sf):
    kept = filters.filter_year(_candidates(spark, sf), F.col("year_min"), F.col("year_max"))
    return kept.select("request_id", "item_id")


@query(
    "enrich",
    _CAND + """SELECT request_id, item_id, coalesce(title, 'Movie ' || item_id) AS title,
      coalesce(array_to_string(genres, '|'), '') AS genres, year FROM candidates""",
)
def enrich(spark, sf):
    return _flat(filters.enrich(_shown(spark, sf), _features(spark, sf)))


@query(
    "display_fields",
    _CAND + """SELECT request_id, item_id, CASE WHEN title IS NULL THEN 'Movie ' || item_id ELSE title || ' (' || year || ')' END AS label,
      coalesce(array_to_string(genres, ', '), 'Unknown') AS genres, item_id / CAST(2 AS DOUBLE) * 100 AS similarity FROM candidates""",
)
def display_fields(spark, sf):
    rows = filters.enrich(_shown(spark, sf), _features(spark, sf))
    return rows.select(
        "request_id", "item_id", fx.title_label("title", "year").alias("label"), fx.genre_label("genres").alias("genres"),
        fx.similarity_percent(F.col("item_id") / 2).alias("similarity"),
    )


# --- lists ----------------------------------------------------------------------------

_POPULAR_FOR = """sigs AS (SELECT DISTINCT k, {genre} AS genre, {lo} AS year_min, {hi} AS year_max FROM {src}),
sig_lists AS (
  SELECT s.*, p.item_id, p.interaction_count, p.popularity_rank, f.title, f.genres, f.year,
         row_number() OVER (PARTITION BY s.k, s.genre, s.year_min, s.year_max ORDER BY p.interaction_count DESC, p.item_id) AS rank
  FROM sigs s CROSS JOIN popularity p LEFT JOIN features f USING (item_id)
  WHERE (s.genre IS NULL OR coalesce(list_contains(f.genres, s.genre), false))
    AND (s.year_min IS NULL OR f.year IS NULL OR f.year >= s.year_min) AND (s.year_max IS NULL OR f.year IS NULL OR f.year <= s.year_max)
  QUALIFY rank <= s.k)"""


@query(
    "popular",
    q.POPULAR + f", {_FEATURES}, {q.REQUESTS}, " + _POPULAR_FOR.format(genre="genres[1]", lo="year_min", hi="year_max", src="requests")
    + """ SELECT r.request_id, l.rank, l.item_id, CAST(l.interaction_count AS DOUBLE) AS score, l.popularity_rank,
      coalesce(l.title, 'Movie ' || l.item_id) AS title, coalesce(array_to_string(l.genres, '|'), '') AS genres, l.year
    FROM requests r JOIN sig_lists l ON l.k = r.k AND l.genre IS NOT DISTINCT FROM r.genres[1]
      AND l.year_min IS NOT DISTINCT FROM r.year_min AND l.year_max IS NOT DISTINCT FROM r.year_max""",
)
def popular(spark, sf):
    r = td.requests(spark, sf).select(
        "request_id", "k", F.try_element_at("genres", F.lit(1)).alias("genre"), "year_min", "year_max"
    )
    return _flat(serve.popular(r, prepared(spark, sf).popularity, _features(spark, sf)))


_DOTS = """asked_users AS (SELECT DISTINCT user_id FROM requests),
dots AS MATERIALIZED (
  SELECT u.user_id, v.item_id, round(list_dot_product(u.vec, v.vec), 9) AS score
  FROM user_vectors u SEMI JOIN asked_users USING (user_id) CROSS JOIN vectors v)"""
_LISTS = """model_lists AS MATERIALIZED (
  SELECT r.request_id, row_number() OVER (PARTITION BY r.request_id ORDER BY d.score DESC, d.item_id) AS rank, d.item_id, d.score,
         f.title, f.genres, f.year
  FROM requests r JOIN dots d USING (user_id) LEFT JOIN features f ON f.item_id = d.item_id
  WHERE (r.genres IS NULL OR f.genres IS NULL OR list_has_any(f.genres, r.genres))
    AND (r.year_min IS NULL OR f.year IS NULL OR f.year >= r.year_min) AND (r.year_max IS NULL OR f.year IS NULL OR f.year <= r.year_max)
    AND NOT (r.exclude_seen AND EXISTS (SELECT 1 FROM liked h WHERE h.user_id = r.user_id AND h.item_id = d.item_id))
  QUALIFY rank <= r.k)"""
_LIKED = "liked AS (SELECT DISTINCT user_id, item_id FROM ratings WHERE rating >= 4)"
_MODEL = q.with_(q.RATINGS, q.ITEMS, _FEATURES, q.REQUESTS, q.VECTORS, _LIKED, _DOTS, _LISTS)
_ENRICHED = "coalesce(title, 'Movie ' || item_id) AS title, coalesce(array_to_string(genres, '|'), '') AS genres, year"


def _liked(spark, sf):
    return filters.to_implicit(td.ratings(spark, sf)).select("user_id", "item_id")


@query("recommend_filtered", _MODEL + f"SELECT request_id, rank, item_id, score, {_ENRICHED} FROM model_lists")
def recommend_filtered(spark, sf):
    return _flat(serve.recommend_filtered(
        td.requests(spark, sf), td.user_vectors(spark, sf), td.vectors(spark, sf), _features(spark, sf), _liked(spark, sf)
    ))


_NEAR = """seeds AS (SELECT DISTINCT {seed} AS seed FROM requests WHERE {seed} IS NOT NULL),
near AS MATERIALIZED (
  SELECT s.seed, row_number() OVER (PARTITION BY s.seed ORDER BY round(list_dot_product(a.vec, b.vec), 9) DESC, b.item_id) AS rank,
         b.item_id, round(list_dot_product(a.vec, b.vec), 9) AS score
  FROM seeds s JOIN unit_vectors a ON a.item_id = s.seed JOIN unit_vectors b ON b.item_id <> s.seed QUALIFY rank <= 100)"""


@query(
    "similar_filtered",
    q.with_(q.ITEMS, _FEATURES, q.REQUESTS, q.VECTORS, _NEAR.format(seed="item_id"))
    + f"""SELECT request_id, rank, item_id, score, {_ENRICHED} FROM (
      SELECT r.request_id, n.rank, n.item_id, n.score, f.title, f.genres, f.year
      FROM requests r JOIN near n ON n.seed = r.item_id AND n.rank <= r.k LEFT JOIN features f ON f.item_id = n.item_id)""",
)
def similar_filtered(spark, sf):
    return _flat(serve.similar_filtered(td.requests(spark, sf), td.vectors(spark, sf), _features(spark, sf)))


@query(
    "similar_to_seed",
    q.with_(q.ITEMS, _FEATURES, q.REQUESTS, q.VECTORS, _NEAR.format(seed="seed_item"))
    + """SELECT r.request_id, coalesce(r.seed_item IN (SELECT item_id FROM vectors), false) AS success, n.rank, n.item_id, n.score,
      CASE WHEN n.item_id IS NOT NULL THEN coalesce(f.title, 'Movie ' || n.item_id) END AS title,
      coalesce(array_to_string(f.genres, '|'), '') AS genres, f.year
    FROM requests r LEFT JOIN near n ON n.seed = r.seed_item AND n.rank <= r.k LEFT JOIN features f ON f.item_id = n.item_id""",
)
def similar_to_seed(spark, sf):
    lists, flags = serve.similar_to_seed(td.requests(spark, sf), td.vectors(spark, sf), _features(spark, sf))
    return _flat(flags.join(lists, "request_id", "left"))


_FALLBACK = f"""{_NEAR.format(seed="seed_item")},
plain AS (SELECT *, genres[1] AS genre FROM requests WHERE seed_item IS NULL OR seed_item NOT IN (SELECT item_id FROM vectors)),
{_POPULAR_FOR.format(genre="genre", lo="CAST(NULL AS INTEGER)", hi="CAST(NULL AS INTEGER)", src="plain")},
cold_lists AS MATERIALIZED (
  SELECT r.request_id, n.rank, n.item_id, n.score, 'similar_to_seed:' || r.seed_item AS fallback_reason
  FROM requests r JOIN near n ON n.seed = r.seed_item AND n.rank <= r.k
  UNION ALL
  SELECT r.request_id, l.rank, l.item_id, CAST(l.interaction_count AS DOUBLE),
         CASE WHEN r.genre IS NULL THEN 'popularity' ELSE 'popularity:genre=' || r.genre END
  FROM plain r JOIN sig_lists l ON l.k = r.k AND l.genre IS NOT DISTINCT FROM r.genre)"""


@query(
    "fallback_for_user",
    q.POPULAR + f", {_FEATURES}, {q.REQUESTS}, {q.VECTORS}, {_FALLBACK} "
    + f"SELECT c.request_id, c.rank, c.item_id, c.score, coalesce(f.title, 'Movie ' || c.item_id) AS title, "
    "coalesce(array_to_string(f.genres, '|'), '') AS genres, f.year, c.fallback_reason "
    "FROM cold_lists c LEFT JOIN features f ON f.item_id = c.item_id",
)
def fallback_for_user(spark, sf):
    r = td.requests(spark, sf).withColumn("genre", F.try_element_at("genres", F.lit(1)))
    return _flat(serve.fallback_for_user(
        r, prepared(spark, sf).popularity, _features(spark, sf), td.vectors(spark, sf)
    ))


@query(
    "route_requests",
    q.POPULAR + f", {_FEATURES}, {q.REQUESTS}, {q.VECTORS}, {_LIKED}, {_DOTS}, {_LISTS}, {_FALLBACK}, "
    + """warm AS (SELECT * FROM requests WHERE user_id IN (SELECT user_id FROM user_vectors)),
    model_arrays AS (SELECT request_id, string_agg(item_id, ',' ORDER BY rank) AS recommendations, sum(CAST(round(score * 1e9) AS BIGINT)) AS total FROM model_lists GROUP BY 1),
    cold_arrays AS (SELECT request_id, string_agg(item_id, ',' ORDER BY rank) AS recommendations, sum(CAST(round(score * 1e9) AS BIGINT)) AS total FROM cold_lists GROUP BY 1)
    SELECT request_id, user_id, coalesce(recommendations, '') AS recommendations, CAST(coalesce(total, 0) AS BIGINT) AS total, 'v1' AS model_version,
      false AS is_fallback, CAST(NULL AS VARCHAR) AS fallback_reason FROM warm LEFT JOIN model_arrays USING (request_id)
    UNION ALL
    SELECT r.request_id, r.user_id, coalesce(recommendations, ''), CAST(coalesce(total, 0) AS BIGINT), 'v1', true,
      CASE WHEN r.seed_item IN (SELECT item_id FROM vectors) THEN 'similar_to_seed:' || r.seed_item
           WHEN r.genres IS NOT NULL THEN 'popularity:genre=' || r.genres[1] ELSE 'popularity' END
    FROM requests r ANTI JOIN warm w USING (request_id) LEFT JOIN cold_arrays USING (request_id)""",
)
def route_requests(spark, sf):
    out = serve.route_requests(
        td.requests(spark, sf), td.user_vectors(spark, sf), td.vectors(spark, sf), _features(spark, sf),
        prepared(spark, sf).popularity, _liked(spark, sf), "v1",
    )
    # the scores have nine digits, so their sum is exact in whole billionths
    billionths = F.transform("scores", lambda x: F.round(x * 1e9).cast("bigint"))
    total = F.aggregate(billionths, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return out.select(
        "request_id", "user_id", F.concat_ws(",", "recommendations").alias("recommendations"), total.alias("total"),
        "model_version", "is_fallback", "fallback_reason",
    )


@query(
    "catalog_labels",
    q.POPULAR + """SELECT title || ' (' || year || ')' AS label, max_by(item_id, place) AS item_id FROM (
      SELECT item_id, row_number() OVER (ORDER BY popularity_rank, item_id) AS place FROM popularity) JOIN items USING (item_id)
    WHERE place <= 100 GROUP BY 1""",
)
def catalog_labels(spark, sf):
    from affinis.operators.popularity import most_popular
    from pyspark.sql import Window as W

    top = most_popular(prepared(spark, sf).popularity, 100)  # the list the selector shows
    placed = top.withColumn("rank", F.row_number().over(W.orderBy("popularity_rank", "item_id")))
    return serve.catalog_labels(filters.enrich(placed, td.items(spark, sf)))
