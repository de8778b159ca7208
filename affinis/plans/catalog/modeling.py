"""Similarity models, vector search, ALS and ranking metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from affinis.functions import vectors as vx
from affinis.operators import als, filters, incremental, item_item, knn, neighbor_graph, popularity, pruned, rank_metrics
from affinis.plans import testdata as td
from affinis.plans.catalog import sql as q
from affinis.plans.catalog.registry import edges, prepared, query, stage
from affinis.session import checkpoint_dir, cut_lineage

# --- item-item ------------------------------------------------------------------------


@query("item_item_fit", q.EDGED + "SELECT * FROM edges")
def item_item_fit(spark, sf):
    return item_item.item_item_fit(prepared(spark, sf).matrix, 50)


@query("item_item_fit_all", q.EDGED + "SELECT * FROM sims WHERE sim >= CAST(0.2 AS DOUBLE)")
def item_item_fit_all(spark, sf):
    """All neighbours above a similarity, without a limit per item."""
    return item_item.item_item_fit(prepared(spark, sf).matrix, None, 0.2)


@query(
    "topk_neighbors",
    q.EDGED + "SELECT * FROM edges QUALIFY row_number() OVER (PARTITION BY item_i ORDER BY sim DESC, item_j) <= 5",
)
def topk_neighbors(spark, sf):
    return item_item.topk_neighbors(edges(spark, sf), 5)


@query(
    "cooccurrence",
    q.with_(q.RATINGS, q.kcore(), q.CUTOFFS, q.SPLIT, q.IDS)
    + """SELECT a.item_idx AS item_i, b.item_idx AS item_j, sum(a.value * b.value) AS shared
    FROM matrix a JOIN matrix b ON a.user_idx = b.user_idx AND a.item_idx <> b.item_idx GROUP BY 1, 2""",
)
def cooccurrence(spark, sf):
    """Shared weight of every pair of items, recovered from the unlimited similarities."""
    m = prepared(spark, sf).matrix
    sims = item_item.item_item_fit(m, None)
    norms = m.groupBy("item_idx").agg(F.sum(F.col("value") * F.col("value")).alias("n2"))
    i = norms.select(F.col("item_idx").alias("item_i"), F.col("n2").alias("a"))
    j = norms.select(F.col("item_idx").alias("item_j"), F.col("n2").alias("b"))
    shared = F.round(F.col("sim") * F.sqrt((F.col("a") * F.col("b")).cast("double"))).cast("bigint")
    return sims.join(i, "item_i").join(j, "item_j").select("item_i", "item_j", shared.alias("shared"))


@query(
    "edge_density",
    q.EDGED + """SELECT count(*) AS n_edges, count(*) * CAST(100 AS DOUBLE)
      / ((SELECT count(*) FROM item_map) * (SELECT count(*) FROM item_map)) AS density_pct FROM edges""",
)
def edge_density(spark, sf):
    from affinis.operators.ids import n_ids

    return popularity.edge_density(edges(spark, sf), n_ids(prepared(spark, sf).items))


def _in_batches(spark, sf):
    """A state that got the training matrix in four batches, one of them twice."""
    m = prepared(spark, sf).matrix
    state = incremental.IncrementalItemItem(spark, f"{checkpoint_dir(spark)}/item-item-{uuid.uuid4().hex}", compact=3)
    for b in (0, 1, 2, 1, 3):
        part = m.filter(F.pmod(F.col("user_idx") * 3 + F.col("item_idx"), F.lit(4)) == b)
        state.add(part, f"batch {b}", "user_idx", "item_idx", "value")
    return state


def _incremental(spark, sf):
    return stage(spark, sf, "incremental", lambda: _in_batches(spark, sf))


@query("incremental_item_item_fit", q.EDGED + "SELECT * FROM edges")
def incremental_item_item_fit(spark, sf):
    """Similarities kept up batch by batch equal those of one fit."""
    return _incremental(spark, sf).edges(50)


@query("incremental_popularity", q.EDGED + "SELECT item_idx AS item_id, count(*) AS users FROM matrix GROUP BY 1")
def incremental_popularity(spark, sf):
    return _incremental(spark, sf).popularity()


@query(
    "incremental_ids",
    q.EDGED + """SELECT 'user' AS side, count(DISTINCT user_idx) AS n, 0 AS low, count(DISTINCT user_idx) - 1 AS high, count(DISTINCT user_idx) AS ids FROM matrix
    UNION ALL SELECT 'item', count(DISTINCT item_idx), 0, count(DISTINCT item_idx) - 1, count(DISTINCT item_idx) FROM matrix""",
)
def incremental_ids(spark, sf):
    """Both id maps are one to one and without gaps."""
    state = _incremental(spark, sf)
    figures = [F.count(F.lit(1)).alias("n"), F.min("idx").alias("low"), F.max("idx").alias("high"), F.count_distinct("idx").alias("ids")]
    sides = [state.ids(x).agg(*figures).select(F.lit(x).alias("side"), "n", "low", "high", "ids") for x in ("user", "item")]
    return sides[0].unionByName(sides[1])


@query("item_item_recommend", q.SCORED + "SELECT user_idx, rank, item_idx, score FROM scored_recs")
def item_item_recommend(spark, sf):
    return item_item.item_item_recommend(edges(spark, sf), prepared(spark, sf).matrix, 20)


_FILLED = """filled AS MATERIALIZED (
  SELECT u.idx AS user_idx, i.idx AS item_idx, coalesce(s.score, 0) AS score,
         row_number() OVER (PARTITION BY u.idx ORDER BY coalesce(s.score, 0) DESC, i.idx) AS rank
  FROM user_map u CROSS JOIN item_map i LEFT JOIN scores s ON s.user_idx = u.idx AND s.item_idx = i.idx
  WHERE NOT EXISTS (SELECT 1 FROM matrix m WHERE m.user_idx = u.idx AND m.item_idx = i.idx)
  QUALIFY rank <= {n})"""


@query(
    "item_item_recommend_filled",
    q.SCORED + ", " + _FILLED.format(n=100) + " SELECT user_idx, rank, item_idx, score FROM filled",
)
def item_item_recommend_filled(spark, sf):
    p = prepared(spark, sf)
    catalog = p.items.select(F.col("idx").alias("item_idx"))
    return item_item.item_item_recommend(edges(spark, sf), p.matrix, 100, fill_zero=True, catalog=catalog)


@query(
    "item_item_recommend_limited",
    q.SCORED + """, half AS (SELECT idx AS item_idx FROM item_map WHERE id IN (SELECT p_partkey FROM part WHERE p_size <= 25)),
    held AS (SELECT u.idx AS user_idx, i.idx AS item_idx FROM split s JOIN user_map u ON s.user_id = u.id JOIN item_map i ON s.item_id = i.id WHERE split = 'val')
    SELECT user_idx, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS rank, item_idx, score
    FROM scores SEMI JOIN half USING (item_idx) ANTI JOIN held USING (user_idx, item_idx) QUALIFY rank <= 10""",
)
def item_item_recommend_limited(spark, sf):
    """Liked items may return; validation pairs are excluded; only small parts are scored."""
    p = prepared(spark, sf)
    small = td.table(spark, sf, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("id"))
    allowed = p.items.join(small, "id", "left_semi").select(F.col("idx").alias("item_idx"))
    from affinis.operators.ids import interaction_matrix

    held = interaction_matrix(p.val, p.users, p.items)
    return item_item.item_item_recommend(
        edges(spark, sf), p.matrix, 10, exclude_liked=False, excluded=held, allowed=allowed
    )


@query(
    "topk_per_user",
    q.SCORED + "SELECT user_idx, rank, item_idx, score FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS rank FROM scores) WHERE rank <= 3",
)
def topk_per_user(spark, sf):
    scores = item_item.liked_scores(edges(spark, sf), prepared(spark, sf).matrix)
    return item_item.rank_scores(scores, 3).select("user_idx", "rank", "item_idx", "score")


@query(
    "exclude_items",
    q.SCORED + "SELECT user_idx, item_idx, score FROM open_scores",
)
def exclude_items(spark, sf):
    m = prepared(spark, sf).matrix
    scores = item_item.liked_scores(edges(spark, sf), m)
    return filters.exclude_items(scores, m, ["user_idx", "item_idx"])


@query(
    "restrict_items",
    q.SCORED + "SELECT user_idx, item_idx, score FROM scores SEMI JOIN matrix USING (user_idx, item_idx)",
)
def restrict_items(spark, sf):
    m = prepared(spark, sf).matrix
    scores = item_item.liked_scores(edges(spark, sf), m)
    return filters.restrict_items(scores, m, ["user_idx", "item_idx"])


@query(
    "item_item_similar",
    q.EDGED + "SELECT item_i, row_number() OVER (PARTITION BY item_i ORDER BY sim DESC, item_j) AS rank, item_j, sim FROM edges WHERE sim > 0 QUALIFY rank <= 10",
)
def item_item_similar(spark, sf):
    catalog = prepared(spark, sf).items.select(F.col("idx").alias("item_idx"))
    return item_item.item_item_similar(edges(spark, sf), catalog, 10)


@query(
    "item_item_score",
    q.EDGED + "SELECT a.item_j AS item_i, a.item_i AS item_j, coalesce(b.sim, 0) AS sim FROM edges a LEFT JOIN edges b ON b.item_i = a.item_j AND b.item_j = a.item_i",
)
def item_item_score(spark, sf):
    e = edges(spark, sf)
    back = e.select(F.col("item_j").alias("item_i"), F.col("item_i").alias("item_j"))
    return item_item.item_item_score(e, back)


# --- ranking metrics ------------------------------------------------------------------

_RELEVANT = """relevant AS (SELECT DISTINCT u.idx AS user_idx, i.idx AS item_idx FROM split s
  JOIN user_map u ON s.user_id = u.id JOIN item_map i ON s.item_id = i.id WHERE split = 'val'),
n_rel AS (SELECT user_idx, count(*) AS n_rel FROM relevant GROUP BY 1),
ks AS (SELECT unnest([5, 10, 20]) AS k),
marked AS (SELECT r.user_idx, r.rank, v.item_idx IS NOT NULL AS hit FROM {recs} r LEFT JOIN relevant v USING (user_idx, item_idx)),
ideal AS (SELECT k, n, (SELECT sum(1 / log2(p + 1)) FROM range(1, least(n, k) + 1) t(p)) AS idcg FROM ks, range(1, 5000) s(n) WHERE n <= (SELECT max(n_rel) FROM n_rel)),
user_metrics AS MATERIALIZED (
  SELECT user_idx, k, count(*) FILTER (hit AND rank <= k) / CAST(k AS DOUBLE) AS precision,
         coalesce(count(*) FILTER (hit AND rank <= k) / CAST(any_value(n_rel) AS DOUBLE), 0) AS recall,
         coalesce(coalesce(sum(1 / log2(rank + 1)) FILTER (hit AND rank <= k), 0) / any_value(idcg), 0) AS ndcg,
         CASE WHEN count(*) FILTER (hit AND rank <= k) > 0 THEN 1.0 ELSE 0.0 END AS hit,
         coalesce(1 / CAST(min(rank) FILTER (hit) AS DOUBLE), 0) AS reciprocal_rank
  FROM marked CROSS JOIN ks LEFT JOIN n_rel USING (user_idx) LEFT JOIN ideal USING (k) WHERE n_rel IS NULL OR ideal.n = n_rel
  GROUP BY user_idx, k)"""
_METRICS = q.SCORED + ", " + _RELEVANT.format(recs="scored_recs") + " "


def _recs(spark, sf):
    return stage(
        spark, sf, "recs",
        lambda: cut_lineage(item_item.item_item_recommend(edges(spark, sf), prepared(spark, sf).matrix, 20)),
    )


def _relevance(spark, sf):
    from affinis.operators.ids import interaction_matrix

    p = prepared(spark, sf)
    return interaction_matrix(p.val, p.users, p.items)


def _user_metrics(spark, sf):
    return rank_metrics.user_metrics(_recs(spark, sf), _relevance(spark, sf), user="user_idx", item="item_idx")


@query("user_metrics", _METRICS + "SELECT * FROM user_metrics")
def user_metrics(spark, sf):
    return _user_metrics(spark, sf)


def _one_metric(name: str, column: str) -> None:
    @query(name, _METRICS + f"SELECT user_idx, k, {column} FROM user_metrics")
    def metric(spark, sf):
        return _user_metrics(spark, sf).select("user_idx", "k", column)


_one_metric("precision_at_k", "precision")
_one_metric("recall_at_k", "recall")
_one_metric("ndcg_at_k", "ndcg")
_one_metric("hit_at_k", "hit")
_one_metric("reciprocal_rank", "reciprocal_rank")

@query("first_hit_position", _METRICS + "SELECT user_idx, min(rank) AS first FROM marked WHERE hit GROUP BY 1")
def first_hit_position(spark, sf):
    """Place of each user's first relevant item, from the reciprocal rank."""
    hit = _user_metrics(spark, sf).filter((F.col("reciprocal_rank") > 0) & (F.col("k") == 5))
    return hit.select("user_idx", F.round(1 / F.col("reciprocal_rank")).cast("int").alias("first"))


@query(
    "set_intersection",
    _METRICS + "SELECT user_idx, item_idx FROM scored_recs WHERE rank <= 10 INTERSECT SELECT user_idx, item_idx FROM relevant",
)
def set_intersection(spark, sf):
    """Recommended items that turned out relevant."""
    top = _recs(spark, sf).filter("rank <= 10").select("user_idx", "item_idx")
    return top.intersect(_relevance(spark, sf).select("user_idx", "item_idx"))


_TESTED = "tested AS (SELECT * FROM user_metrics SEMI JOIN n_rel USING (user_idx))"
_MEANS = """means AS (
  SELECT 'precision' AS metric, k, avg(precision) AS value FROM tested GROUP BY k
  UNION ALL SELECT 'recall', k, avg(recall) FROM tested GROUP BY k
  UNION ALL SELECT 'ndcg', k, avg(ndcg) FROM tested GROUP BY k
  UNION ALL SELECT 'hit', k, avg(hit) FROM tested GROUP BY k
  UNION ALL SELECT 'mrr', NULL, avg(reciprocal_rank) FROM tested WHERE k = 5
  UNION ALL SELECT 'n_users_evaluated', NULL, count(*) FROM tested WHERE k = 5)"""


@query("evaluate_model", _METRICS + ", " + _TESTED + ", " + _MEANS + " SELECT metric, k, value FROM means")
def evaluate_model(spark, sf):
    return rank_metrics.evaluate_model(_recs(spark, sf), _relevance(spark, sf), user="user_idx", item="item_idx")


@query(
    "evaluate_model_df",
    q.SCORED + ", " + _FILLED.format(n=20) + ", " + _RELEVANT.format(recs="filled") + ", " + _TESTED + ", " + _MEANS
    + " SELECT metric, k, value FROM means",
)
def evaluate_model_df(spark, sf):
    """Lists padded to full length, from raw-id validation rows."""
    p = prepared(spark, sf)
    catalog = p.items.select(F.col("idx").alias("item_idx"))
    recs = item_item.item_item_recommend(edges(spark, sf), p.matrix, 20, fill_zero=True, catalog=catalog)
    return rank_metrics.evaluate_model_df(recs, p.val, p.users, p.items)


@query(
    "metrics_table",
    _METRICS + ", " + _TESTED + ", " + _MEANS
    + """ SELECT metric, max(value) FILTER (k = 5) AS at_5, max(value) FILTER (k = 10) AS at_10, max(value) FILTER (k = 20) AS at_20
    FROM means WHERE k IS NOT NULL GROUP BY 1""",
)
def metrics_table(spark, sf):
    return rank_metrics.metrics_table(evaluate_model(spark, sf))


# --- vectors --------------------------------------------------------------------------

_V = q.with_(q.VECTORS)


@query("vector_l2_normalize", _V + "SELECT item_id, unnest(vec) AS x, unnest(range(len(vec))) AS place FROM unit_vectors")
def vector_l2_normalize(spark, sf):
    unit = td.vectors(spark, sf).select("item_id", vx.l2_normalize("vec").alias("vec"))
    return unit.select("item_id", F.posexplode("vec").alias("place", "x"))


@query("vector_dot", _V + "SELECT a.item_id, list_dot_product(a.vec, b.vec) AS dot FROM vectors a JOIN vectors b ON b.item_id = a.item_id + 1")
def vector_dot(spark, sf):
    v = td.vectors(spark, sf)
    following = v.select((F.col("item_id") - 1).alias("item_id"), F.col("vec").alias("other"))
    return v.join(following, "item_id").select("item_id", vx.dot("vec", "other").alias("dot"))


@query("dim_check", _V + "SELECT item_id, len(vec) = 64 AS valid FROM vectors")
def dim_check(spark, sf):
    return knn.dim_check(td.vectors(spark, sf), 64).select("item_id", "valid")


@query(
    "vector_by_idx",
    _V + "SELECT p_partkey AS item_id, vec[1] AS first, len(vec) AS width FROM part LEFT JOIN vectors ON p_partkey = item_id",
)
def vector_by_idx(spark, sf):
    asked = td.items(spark, sf).select("item_id")
    return knn.vector_by_idx(td.vectors(spark, sf), asked).select(
        "item_id", F.col("vec")[0].cast("double").alias("first"), F.size("vec").alias("width")
    )


_KNN = """SELECT a.item_id AS query_id, row_number() OVER (PARTITION BY a.item_id ORDER BY round(list_dot_product(a.vec, b.vec), 9) DESC, b.item_id) AS rank,
  b.item_id, round(list_dot_product(a.vec, b.vec), 9) AS score
FROM {t} a CROSS JOIN {t} b WHERE {c} QUALIFY rank <= {k}"""


def _as_queries(vectors):
    return vectors.withColumnRenamed("item_id", "query_id")


@query("knn_exact", _V + _KNN.format(t="unit_vectors", c="true", k=10))
def knn_exact(spark, sf):
    v = td.vectors(spark, sf)
    return knn.knn_exact(_as_queries(v), v, 10)


@query("knn_exact_raw", _V + _KNN.format(t="vectors", c="a.item_id <> b.item_id", k=5))
def knn_exact_raw(spark, sf):
    """Inner product without normalization, each query left out of its own list."""
    v = td.vectors(spark, sf)
    return knn.knn_exact(_as_queries(v), v, 5, normalize=False, skip_self=True)


@query("knn_ivf")
def knn_ivf(spark, sf):
    v = td.vectors(spark, sf)
    return knn.knn_ivf(_as_queries(v), v, 10)


@query("knn_ivf_all_lists", _V + _KNN.format(t="unit_vectors", c="true", k=10))
def knn_ivf_all_lists(spark, sf):
    """Probing every list must equal the exact search."""
    v = td.vectors(spark, sf)
    return knn.knn_ivf(_as_queries(v), v, 10, nlist=20, nprobe=20)


@query("knn_lsh")
def knn_lsh(spark, sf):
    v = td.vectors(spark, sf)
    return knn.knn_lsh(_as_queries(v), v, 10)


def _quality(index, v, comparisons):
    return _recall(index.search(_as_queries(v), 10), v, comparisons)


def _recall(found, v, comparisons):
    row = knn.search_quality(found, knn.knn_exact(_as_queries(v), v, 10), comparisons, v.count())
    return row.select((F.col("recall") >= 0.9).alias("recall_ok"), (F.col("comparisons") < 1).alias("fewer_comparisons"))


@query("knn_ivf_quality", "SELECT true AS recall_ok, true AS fewer_comparisons")
def knn_ivf_quality(spark, sf):
    """At least 0.9 of the exact lists, from fewer comparisons than exact search makes."""
    v = td.vectors(spark, sf)
    index = knn.IvfIndex(v)
    return _quality(index, v, index.comparisons(_as_queries(v)))


@query("knn_lsh_quality", "SELECT true AS recall_ok, true AS fewer_comparisons")
def knn_lsh_quality(spark, sf):
    v = td.vectors(spark, sf)
    index = knn.LshIndex(v)
    return _quality(index, v, index.comparisons(_as_queries(v)))


def _graph(spark, sf):
    return stage(spark, sf, "graph", lambda: neighbor_graph.NeighborGraph(td.vectors(spark, sf)))


@query("knn_graph_links", _V + "SELECT item_id, least(16, (SELECT count(*) FROM vectors) - 1) AS links FROM vectors")
def knn_graph_links(spark, sf):
    """Every item keeps the same number of neighbours in the graph."""
    links = F.count(F.lit(1)).alias("links")
    return _graph(spark, sf).edges.groupBy(F.col("item_i").alias("item_id")).agg(links)


@query("knn_graph")
def knn_graph(spark, sf):
    return _graph(spark, sf).search(_as_queries(td.vectors(spark, sf)), 10)


@query("knn_graph_quality", "SELECT true AS recall_ok, true AS fewer_comparisons")
def knn_graph_quality(spark, sf):
    """Every vector is asked; one walk gives both the lists and the comparisons."""
    v = td.vectors(spark, sf)
    visits = _graph(spark, sf).visits(_as_queries(v))
    looked = visits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    return _recall(_graph(spark, sf).nearest(visits, 10), v, looked)


_SKEWED = _V.rstrip() + """,
skewed AS (SELECT item_id, [x * (CAST(1000 AS DOUBLE) / ((1 + (item_id * 7) % 100) * (1 + (item_id * 7) % 100))) FOR x IN vec] AS vec FROM vectors)
"""


def _skewed(spark, sf):
    """Vectors whose norms fall with the square of their rank."""
    place = 1 + (F.col("item_id") * 7) % 100
    scale = F.lit(1000.0) / (place * place)
    return td.vectors(spark, sf).select("item_id", F.transform("vec", lambda x: x.cast("double") * scale).alias("vec"))


@query("inner_product_pruned", _SKEWED + _KNN.format(t="skewed", c="a.item_id <> b.item_id", k=10))
def inner_product_pruned(spark, sf):
    v = _skewed(spark, sf)
    return pruned.PrunedSearch(v, first=64).search(_as_queries(v), 10, skip_self=True)


@query("inner_product_pruned_share", "SELECT true AS below_half")
def inner_product_pruned_share(spark, sf):
    """Whether norms that differ spare the exact search more than half of all pairs."""
    v = _skewed(spark, sf)
    index = pruned.PrunedSearch(v, first=64)
    index.search(_as_queries(v), 10, skip_self=True)
    pairs = v.agg((F.count(F.lit(1)) * F.count(F.lit(1))).alias("pairs"))
    return pairs.select((F.lit(index.comparisons) < F.col("pairs") / 2).alias("below_half"))


@query(
    "als_recommend_pruned",
    q.with_(q.RATINGS, q.VECTORS, "liked AS (SELECT DISTINCT user_id, item_id FROM ratings WHERE rating >= 4)")
    + """SELECT user_id AS query_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank, item_id, score FROM (
      SELECT u.user_id, v.item_id, round(list_dot_product(u.vec, v.vec), 9) AS score
      FROM user_vectors u SEMI JOIN liked USING (user_id) CROSS JOIN vectors v
      WHERE NOT EXISTS (SELECT 1 FROM liked h WHERE h.user_id = u.user_id AND h.item_id = v.item_id)) QUALIFY rank <= 10""",
)
def als_recommend_pruned(spark, sf):
    """Lists of factors with seen items left out, by pruned search."""
    liked, model = _liked(spark, sf), _factors(spark, sf)
    users = model.users.select(F.col("idx").alias("query_id"), "vec").join(liked.select(F.col("user_idx").alias("query_id")), "query_id", "left_semi")
    seen = liked.select(F.col("user_idx").alias("query_id"), F.col("item_idx").alias("item_id"))
    return pruned.PrunedSearch(model.items.select(F.col("idx").alias("item_id"), "vec"), first=64).search(users, 10, skip=seen)


# --- ALS ------------------------------------------------------------------------------


def fitted(spark, sf):
    """The ALS factors as a stage."""
    return stage(spark, sf, "als", lambda: als.als_fit(prepared(spark, sf).matrix))


def _factors(spark, sf):
    """Given vectors as factors, so that scores can be checked."""
    users = td.user_vectors(spark, sf).select(F.col("user_id").alias("idx"), "vec")
    return als.AlsFactors(users, td.vectors(spark, sf).select(F.col("item_id").alias("idx"), "vec"))


def _liked(spark, sf):
    rows = filters.to_implicit(td.ratings(spark, sf))
    return rows.select(F.col("user_id").alias("user_idx"), F.col("item_id").alias("item_idx")).distinct()


_ALS = q.with_(q.RATINGS, q.VECTORS, "liked AS (SELECT DISTINCT user_id, item_id FROM ratings WHERE rating >= 4)")


@query(
    "als_fit",
    q.INDEXED + """SELECT 'user' AS side, count(DISTINCT user_idx) AS n, 64 AS width, true AS finite FROM matrix
    UNION ALL SELECT 'item', count(DISTINCT item_idx), 64, true FROM matrix""",
)
def als_fit(spark, sf):
    """Every user and item of the matrix gets factors of full width."""
    model = als.als_fit(prepared(spark, sf).matrix)
    sides = model.users.withColumn("side", F.lit("user")).unionByName(model.items.withColumn("side", F.lit("item")))
    length = vx.norm("vec")
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width"),
        F.min(length.isNotNull() & ~F.isnan(length) & (length < 1e6)).alias("finite"),
    )


@query(
    "als_recommend",
    _ALS + """SELECT user_idx, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS rank, item_idx, score FROM (
      SELECT u.user_id AS user_idx, v.item_id AS item_idx, round(list_dot_product(u.vec, v.vec), 9) AS score
      FROM user_vectors u SEMI JOIN liked USING (user_id) CROSS JOIN vectors v
      WHERE NOT EXISTS (SELECT 1 FROM liked h WHERE h.user_id = u.user_id AND h.item_id = v.item_id)) QUALIFY rank <= 10""",
)
def als_recommend(spark, sf):
    liked = _liked(spark, sf)
    return als.als_recommend(_factors(spark, sf), liked.select("user_idx"), 10, liked)


@query(
    "als_similar",
    _V + "SELECT query_id AS item_i, rank, item_id AS item_j, score AS sim FROM ("
    + _KNN.format(t="unit_vectors", c="a.item_id <> b.item_id AND a.item_id IN (SELECT l_partkey FROM lineitem)", k=10) + ")",
)
def als_similar(spark, sf):
    return als.als_similar(_factors(spark, sf), td.ratings(spark, sf).select(F.col("item_id").alias("item_idx")), 10)


@query(
    "als_score",
    _ALS + """SELECT l.user_id AS user_idx, l.item_id AS item_idx, list_dot_product(u.vec, v.vec) AS score
    FROM liked l LEFT JOIN user_vectors u USING (user_id) LEFT JOIN vectors v ON v.item_id = l.item_id""",
)
def als_score(spark, sf):
    return als.als_score(_factors(spark, sf), _liked(spark, sf))


@query(
    "embeddings_get",
    _V + """SELECT 'user' AS side, user_id AS idx, unnest(vec) AS x, unnest(range(64)) AS place FROM user_vectors SEMI JOIN (SELECT o_custkey AS user_id FROM orders) USING (user_id)
    UNION ALL SELECT 'item', item_id, unnest(vec), unnest(range(64)) FROM vectors SEMI JOIN (SELECT l_partkey AS item_id FROM lineitem) USING (item_id)""",
)
def embeddings_get(spark, sf):
    """Factors of the users and items that occur in the ratings."""
    model, rows = _factors(spark, sf), td.ratings(spark, sf)
    sides = [("user", model.users, "user_id"), ("item", model.items, "item_id")]
    users, items = (
        als.embeddings_get(table, rows.select(F.col(c).alias("idx"))).select(F.lit(side).alias("side"), "idx", F.posexplode("vec").alias("place", "x"))
        for side, table, c in sides
    )
    return users.unionByName(items).withColumn("x", F.col("x").cast("double"))


@query("train_all")
def train_all(spark, sf):
    from affinis.plans.training import train_all as train

    _, metrics, _, _ = train(prepared(spark, sf))
    return metrics
