"""Scans, filters, splits, ids and popularity."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions import text as fx
from affinis.operators import filters, ids, popularity, prefix, split
from affinis.operators.kcore import kcore_filter
from affinis.plans import testdata as td
from affinis.plans.catalog import sql as q
from affinis.plans.catalog.registry import prepared, query
from affinis.sources.ratings import item_features

# --- scans and row filters ------------------------------------------------------------


@query("to_implicit", q.with_(q.RATINGS) + "SELECT user_id, item_id, timestamp FROM ratings WHERE rating >= 4")
def to_implicit(spark, sf):
    return filters.to_implicit(td.ratings(spark, sf)).select("user_id", "item_id", "timestamp")


@query("projection_check", q.with_(q.RATINGS) + "SELECT user_id, item_id FROM ratings")
def projection_check(spark, sf):
    return filters.check_columns(td.ratings(spark, sf), "user_id", "item_id")


@query("kcore_filter", q.with_(q.RATINGS, q.kcore()) + "SELECT * FROM interactions")
def kcore(spark, sf):
    implicit = filters.to_implicit(td.ratings(spark, sf)).select("user_id", "item_id", "timestamp")
    return kcore_filter(implicit, 5, 10)


@query(
    "kcore_filter_strict",
    q.with_(q.RATINGS, q.kcore(12, 12, 3)) + "SELECT count(*) AS n, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM interactions",
)
def kcore_strict(spark, sf):
    implicit = filters.to_implicit(td.ratings(spark, sf), 3).select("user_id", "item_id", "timestamp")
    return kcore_filter(implicit, 12, 12).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("item_id").alias("n_items"),
    )


@query(
    "sort_by_time",
    q.with_(q.RATINGS) + "SELECT user_id, item_id, timestamp FROM ratings WHERE rating >= 4 ORDER BY timestamp, user_id, item_id",
)
def sort_by_time(spark, sf):
    rows = filters.to_implicit(td.ratings(spark, sf)).select("user_id", "item_id", "timestamp")
    return filters.sort_by_time(rows)


@query(
    "ts_to_string",
    q.with_(q.RATINGS) + "SELECT user_id, item_id, strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d %H:%M:%S') AS at FROM ratings",
)
def ts_to_string(spark, sf):
    return td.ratings(spark, sf).select("user_id", "item_id", fx.ts_to_string("timestamp").alias("at"))


# --- item features --------------------------------------------------------------------

_CLEANED = r"""cleaned AS (
  SELECT item_id, title, TRY_CAST(nullif(regexp_extract(title, '\((\d{4})\)\s*$', 1), '') AS INTEGER) AS year,
         regexp_replace(
           regexp_replace(trim(regexp_replace(title, '\s*\(\d{4}\)\s*$', '')), '\s+', ' ', 'g'),
           '^(.+),\s+(The|A|An)$', '\2 \1', 'i') AS clean, p_type, word
  FROM raw_items)"""


@query("extract_year", q.with_(q.RAW_ITEMS, _CLEANED) + "SELECT item_id, year FROM cleaned")
def extract_year(spark, sf):
    return td.raw_items(spark, sf).select("item_id", fx.extract_year("title").alias("year"))


@query("clean_title", q.with_(q.RAW_ITEMS, _CLEANED) + "SELECT item_id, clean AS title FROM cleaned")
def clean_title(spark, sf):
    return td.raw_items(spark, sf).select("item_id", fx.clean_title("title").alias("title"))


_TYPES = ("ECONOMY", "STANDARD", "PROMO", "LARGE", "MEDIUM", "SMALL")
_FLAGS = ", ".join(f"CAST(p_type = '{t}' AS INTEGER) AS \"{t}\"" for t in _TYPES)


def _flagged(spark, sf):
    """Raw items with one 0/1 column per type; the last flag is null where it is off."""
    raw = td.raw_items(spark, sf)
    flags = [(F.col("p_type") == t).cast("int").alias(t) for t in _TYPES[:-1]]
    return raw.select("item_id", "title", *flags, F.when(F.col("p_type") == _TYPES[-1], 1).alias(_TYPES[-1]))


@query(
    "genre_array",
    q.with_(q.RAW_ITEMS, _CLEANED) + f"SELECT item_id, clean AS title, year, array_to_string(list_filter([p_type], lambda x: x IN {_TYPES}), '|') AS genres FROM cleaned",
)
def genre_array(spark, sf):
    out = item_features(_flagged(spark, sf), list(_TYPES))
    return out.withColumn("genres", F.concat_ws("|", "genres"))


@query("genre_onehot", q.with_(q.RAW_ITEMS, _CLEANED) + f"SELECT item_id, clean AS title, year, {_FLAGS} FROM cleaned")
def genre_onehot(spark, sf):
    return fx.genre_onehot(item_features(_flagged(spark, sf), list(_TYPES)), list(_TYPES))


@query(
    "genre_counts",
    q.with_(q.ITEMS) + "SELECT genre, count(*) AS n_items FROM (SELECT unnest(genres) AS genre FROM items) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
def genre_counts(spark, sf):
    return popularity.genre_counts(td.items(spark, sf))


@query("titles_with_year", q.with_(q.RAW_ITEMS, _CLEANED) + "SELECT count(*) AS n_items, count(year) AS n_with_year FROM cleaned")
def titles_with_year(spark, sf):
    return popularity.titles_with_year(
        td.raw_items(spark, sf).select("item_id", fx.extract_year("title").alias("year"))
    )


@query(
    "item_info",
    q.with_(q.ITEMS) + "SELECT item_id, title, year, array_to_string(genres, '|') AS genres FROM items WHERE item_id IN (SELECT l_partkey FROM lineitem)",
)
def item_info(spark, sf):
    asked = td.ratings(spark, sf).select("item_id")
    return filters.item_info(asked, td.items(spark, sf)).select(
        "item_id", "title", "year", F.concat_ws("|", "genres").alias("genres")
    )


# --- splits ---------------------------------------------------------------------------


@query("split_cutoffs", q.with_(q.RATINGS, q.kcore(), q.CUTOFFS) + "SELECT * FROM cutoffs")
def split_cutoffs(spark, sf):
    return split.split_cutoffs(prepared(spark, sf).split)


@query(
    "order_statistic",
    q.with_(q.RATINGS) + """SELECT max(timestamp) FILTER (nth = CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT)) AS middle,
      max(timestamp) FILTER (nth = CAST(floor(n * CAST(0.9 AS DOUBLE)) AS BIGINT)) AS late
    FROM (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS nth, count(*) OVER () AS n FROM ratings)""",
)
def order_statistic(spark, sf):
    return prefix.order_statistics(td.ratings(spark, sf), "timestamp", {"middle": 0.5, "late": 0.9})


@query("time_split", q.PREPARED + "SELECT user_id, item_id, timestamp, split FROM split")
def time_split(spark, sf):
    interactions = prepared(spark, sf).split.drop("split")
    return split.time_split(interactions)


@query(
    "split_stats",
    q.PREPARED + """, lv AS (SELECT *, CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END AS l FROM split),
    fu AS (SELECT user_id, min(l) AS f FROM lv GROUP BY 1), fi AS (SELECT item_id, min(l) AS f FROM lv GROUP BY 1)
    SELECT split, count(*) AS n, count(*) / CAST((SELECT count(*) FROM lv) AS DOUBLE) AS share,
           min(timestamp) AS min_ts, max(timestamp) AS max_ts,
           count(DISTINCT lv.user_id) AS n_users, count(DISTINCT lv.user_id) FILTER (fu.f = l) AS new_users,
           count(DISTINCT lv.item_id) AS n_items, count(DISTINCT lv.item_id) FILTER (fi.f = l) AS new_items
    FROM lv JOIN fu USING (user_id) JOIN fi USING (item_id) GROUP BY 1""",
)
def split_stats(spark, sf):
    return split.split_stats(prepared(spark, sf).split)


_POSITIONED = """positioned AS (
  SELECT user_id, item_id, rating, row_number() OVER (ORDER BY order_id, line, item_id, timestamp, rating) - 1 AS pos FROM ratings)"""


def _positioned(spark, sf):
    rows = td.ratings(spark, sf, keyed=True)
    return prefix.row_positions(rows, ["order_id", "line", "item_id", "timestamp", "rating"])


@query(
    "fold_split",
    q.with_(q.RATINGS, _POSITIONED) + """SELECT user_id, item_id, rating, pos,
      CAST(pos // CAST(ceil((SELECT count(*) FROM ratings) / CAST(5 AS DOUBLE)) AS BIGINT) + 1 AS INTEGER) AS fold FROM positioned""",
)
def fold_split(spark, sf):
    return split.fold_split(_positioned(spark, sf), 5).select("user_id", "item_id", "rating", "pos", "fold")


_HOLDOUT = """numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pos) AS rn FROM positioned),
marked AS (SELECT *, rn BETWEEN 1 AND 10 AS early,
    sum(CASE WHEN rn BETWEEN 1 AND 10 THEN 1 ELSE 0 END) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS taken FROM numbered)"""


@query(
    "holdout_n_per_user",
    q.with_(q.RATINGS, _POSITIONED, _HOLDOUT) + "SELECT user_id, item_id, pos, early AS is_test FROM marked",
)
def holdout(spark, sf):
    return split.holdout_n_per_user(_positioned(spark, sf), 1, 10).select("user_id", "item_id", "pos", "is_test")


@query(
    "holdout_n_per_user_capped",
    q.with_(q.RATINGS, _POSITIONED, _HOLDOUT) + "SELECT user_id, item_id, pos, early AND taken <= 2000 AS is_test FROM marked",
)
def holdout_capped(spark, sf):
    return split.holdout_n_per_user(_positioned(spark, sf), 1, 10, 2000).select("user_id", "item_id", "pos", "is_test")


@query(
    "set_difference",
    q.PREPARED + """(SELECT 'user' AS side, user_id AS id FROM ratings EXCEPT SELECT 'user', user_id FROM train)
    UNION ALL (SELECT 'item', item_id FROM ratings EXCEPT SELECT 'item', item_id FROM train)""",
)
def set_difference(spark, sf):
    """Rated users and items that training does not know."""
    p, rated = prepared(spark, sf), td.ratings(spark, sf)

    def new(column, side):
        return rated.select(F.lit(side).alias("side"), F.col(column).alias("id")).subtract(
            p.train.select(F.lit(side), F.col(column))
        )

    return new("user_id", "user").unionByName(new("item_id", "item"))


# --- ids ------------------------------------------------------------------------------


@query("dense_ids", q.INDEXED + "SELECT 'user' AS side, id, idx FROM user_map UNION ALL SELECT 'item', id, idx FROM item_map")
def dense_ids(spark, sf):
    users, items = ids.build_mappings(prepared(spark, sf).train)
    return users.withColumn("side", F.lit("user")).unionByName(items.withColumn("side", F.lit("item")))


@query("reverse_ids", q.INDEXED + "SELECT idx, id FROM item_map")
def reverse_ids(spark, sf):
    return ids.reverse_ids(prepared(spark, sf).items)


@query(
    "map_ids",
    q.INDEXED + "SELECT s.user_id, s.item_id, s.timestamp, u.idx AS user_idx FROM split s LEFT JOIN user_map u ON s.user_id = u.id WHERE split <> 'train'",
)
def map_ids(spark, sf):
    p = prepared(spark, sf)
    rows = p.split.filter("split <> 'train'").drop("split")
    return ids.map_ids(rows, p.users, "user_id", "user_idx").select("user_id", "item_id", "timestamp", "user_idx")


@query("unmap_ids", q.INDEXED + "SELECT m.user_idx, m.item_idx, i.id AS item_id FROM matrix m LEFT JOIN item_map i ON m.item_idx = i.idx")
def unmap_ids(spark, sf):
    p = prepared(spark, sf)
    return ids.unmap_ids(p.matrix.select("user_idx", "item_idx"), p.items, "item_idx", "item_id")


@query("has_id", q.INDEXED + "SELECT user_id, item_id, timestamp FROM split WHERE split = 'val' AND user_id IN (SELECT id FROM user_map)")
def has_id(spark, sf):
    p = prepared(spark, sf)
    return ids.has_id(p.val, p.users, "user_id").select("user_id", "item_id", "timestamp")


@query("n_ids", q.INDEXED + "SELECT count(*) AS n FROM user_map")
def n_ids(spark, sf):
    return ids.n_ids(prepared(spark, sf).users)


@query("all_ids", q.INDEXED + "SELECT id FROM item_map")
def all_ids(spark, sf):
    return ids.all_ids(prepared(spark, sf).items)


@query("interaction_matrix", q.INDEXED + "SELECT user_idx, item_idx, value FROM matrix")
def interaction_matrix(spark, sf):
    p = prepared(spark, sf)
    return ids.interaction_matrix(p.train, p.users, p.items)


@query(
    "interaction_matrix_val",
    q.INDEXED + """SELECT u.idx AS user_idx, i.idx AS item_idx, count(*) AS value FROM split s
    JOIN user_map u ON s.user_id = u.id JOIN item_map i ON s.item_id = i.id WHERE split = 'val' GROUP BY 1, 2""",
)
def interaction_matrix_val(spark, sf):
    p = prepared(spark, sf)
    return ids.interaction_matrix(p.val, p.users, p.items)


@query(
    "index_validation",
    q.INDEXED + "SELECT user_id AS idx, user_id >= 0 AND user_id < (SELECT count(*) FROM user_map) AS valid FROM split",
)
def index_validation(spark, sf):
    p = prepared(spark, sf)
    return filters.check_ids(p.split.select(F.col("user_id").alias("idx")), p.users)


# --- popularity -----------------------------------------------------------------------


@query("popularity", q.POPULAR + "SELECT * FROM popularity")
def popularity_table(spark, sf):
    return popularity.popularity(prepared(spark, sf).train)


@query(
    "popularity_all_ratings",
    q.with_(q.RATINGS, "train AS (SELECT user_id, item_id FROM ratings)", q.POPULARITY) + "SELECT * FROM popularity",
)
def popularity_all(spark, sf):
    return popularity.popularity(td.ratings(spark, sf))


@query("popularity_rank", q.POPULAR + "SELECT item_id, popularity_rank FROM popularity")
def popularity_rank(spark, sf):
    return popularity.popularity(prepared(spark, sf).train).select("item_id", "popularity_rank")


@query("popularity_percentile", q.POPULAR + "SELECT item_id, popularity_percentile FROM popularity")
def popularity_percentile(spark, sf):
    return popularity.popularity(prepared(spark, sf).train).select("item_id", "popularity_percentile")


@query(
    "popularity_stats",
    q.POPULAR + "SELECT min(interaction_count) AS min_count, quantile_cont(interaction_count, 0.5) AS median_count, max(interaction_count) AS max_count FROM popularity",
)
def popularity_stats(spark, sf):
    return popularity.popularity_stats(prepared(spark, sf).popularity)


@query(
    "most_popular",
    q.POPULAR + "SELECT * FROM popularity ORDER BY popularity_rank, item_id LIMIT 10",
)
def most_popular(spark, sf):
    return popularity.most_popular(prepared(spark, sf).popularity)


@query(
    "density",
    q.with_(q.RATINGS, q.kcore()) + """SELECT count(*) AS n_interactions, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
    count(*) * CAST(100 AS DOUBLE) / (count(DISTINCT user_id) * count(DISTINCT item_id)) AS density_pct FROM interactions""",
)
def density(spark, sf):
    return popularity.density(prepared(spark, sf).split)


@query("table_io", q.PREPARED + "SELECT split, count(*) AS n, min(timestamp) AS min_ts FROM split GROUP BY 1")
def table_io(spark, sf):
    """Write the split table by split, then read it back."""
    import uuid

    from affinis.session import checkpoint_dir
    from affinis.sources.tables import read_table, write_table

    path = f"{checkpoint_dir(spark)}/table_io_{uuid.uuid4().hex}"
    write_table(prepared(spark, sf).split, path, partition_by=["split"])
    return read_table(spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("min_ts")
    )
