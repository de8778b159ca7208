"""Shared SQL for the source tables derived in ``testdata`` and the preparation stages."""

RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(1 + (CAST(l_quantity AS INTEGER) - 1) // 10 AS INTEGER) AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS timestamp,
         l_orderkey AS order_id, l_linenumber AS line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RAW_ITEMS = """raw_items AS (
  SELECT p_partkey AS item_id,
         p_name || (['', ', The', ',  a', '  '])[p_size % 4 + 1]
           || CASE WHEN p_size % 5 > 0 THEN ' (' || (p_size + 1950) || ') ' ELSE '' END AS title,
         p_type, split_part(p_name, ' ', 1) AS word
  FROM part)"""

ITEMS = """items AS (
  SELECT p_partkey AS item_id, p_name AS title, p_size + 1950 AS year,
         [p_type, split_part(p_name, ' ', 1)] AS genres
  FROM part)"""

LOG = """base_log AS (
  SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'click' THEN '/similar' WHEN 'purchase' THEN '/popular' ELSE '/recommend' END AS endpoint
  FROM events),
request_log AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id, ts AS timestamp,
         CASE WHEN event_type <> 'purchase' THEN user_id END AS user_id, endpoint,
         CASE WHEN event_id % 3 = 1 THEN 'v1' WHEN event_id % 3 = 2 THEN CASE WHEN event_id % 2 = 0 THEN 'v2' ELSE '' END END AS model_version,
         CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'bad'
              ELSE '[' || array_to_string(range(k, k + event_id % 10 + 1), ',') || ']' END AS recommendations,
         value AS latency_ms,
         (event_id % 7 = 0 AND endpoint = '/recommend') AS is_fallback,
         CASE WHEN NOT (event_id % 7 = 0 AND endpoint = '/recommend') THEN NULL
              WHEN event_id % 3 = 0 THEN 'popularity'
              WHEN event_id % 3 = 1 THEN 'popularity:genre=' || event_type
              ELSE 'similar_to_seed:' || k END AS fallback_reason
  FROM base_log),
parsed_log AS (SELECT *, TRY_CAST(recommendations AS BIGINT[]) AS ids FROM request_log)"""

REQUESTS = """base_requests AS (
  SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS kk FROM events),
requests AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id,
         CASE WHEN event_id % 5 = 0 THEN user_id + 100000000 ELSE user_id END AS user_id,
         CAST(kk % 20 + 1 AS INTEGER) AS k,
         CASE kk % 3 WHEN 1 THEN [(['ECONOMY', 'STANDARD', 'PROMO', 'LARGE'])[kk % 4 + 1]]
                     WHEN 2 THEN [(['ECONOMY', 'STANDARD', 'PROMO', 'LARGE'])[kk % 4 + 1], 'red'] END AS genres,
         CASE WHEN kk % 4 = 0 THEN 1955 + kk % 10 END AS year_min,
         CASE WHEN kk % 5 = 0 THEN 1980 + kk % 10 END AS year_max,
         CASE WHEN kk % 10 = 0 THEN kk END AS seed_item,
         kk AS item_id, kk % 7 <> 0 AS exclude_seen
  FROM base_requests)"""

VECTORS = """vectors AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
unit_vectors AS (
  SELECT item_id, [x / (sqrt(list_dot_product(vec, vec)) + 1e-10) FOR x IN vec] AS vec FROM vectors),
user_vectors AS (
  SELECT c_custkey AS user_id, vec FROM customer
  JOIN vectors ON item_id = c_custkey % (SELECT count(*) FROM embeddings))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# More rounds than the filter needs at any test size; further rounds change nothing.
KCORE_ROUNDS = 12


def kcore(min_user: int = 5, min_item: int = 10, threshold: int = 4) -> str:
    """``interactions``: the minimum-degree filter, one pair of counts per round."""
    parts = [
        f"core0 AS MATERIALIZED (SELECT user_id, item_id, timestamp FROM ratings WHERE rating >= {threshold})"
    ]
    for r in range(1, KCORE_ROUNDS + 1):
        last = f"core{r - 1}"
        parts.append(
            f"core{r} AS MATERIALIZED (SELECT * FROM {last} WHERE user_id IN "
            f"(SELECT user_id FROM {last} GROUP BY user_id HAVING count(*) >= {min_user}) AND item_id IN "
            f"(SELECT item_id FROM {last} GROUP BY item_id HAVING count(*) >= {min_item}))"
        )
    parts.append(f"interactions AS MATERIALIZED (SELECT * FROM core{KCORE_ROUNDS})")
    return ",\n".join(parts)


CUTOFFS = """ordered AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS nth, count(*) OVER () AS n FROM interactions),
cutoffs AS (
  SELECT max(timestamp) FILTER (nth = least(CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT), n - 1)) AS train_cutoff,
         max(timestamp) FILTER (nth = least(CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT), n - 1)) AS val_cutoff
  FROM ordered)"""

SPLIT = """split AS MATERIALIZED (
  SELECT user_id, item_id, timestamp,
         CASE WHEN timestamp < train_cutoff THEN 'train' WHEN timestamp < val_cutoff THEN 'val' ELSE 'test' END AS split
  FROM interactions, cutoffs),
train AS MATERIALIZED (SELECT user_id, item_id, timestamp FROM split WHERE split = 'train')"""

IDS = """user_map AS MATERIALIZED (SELECT user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM (SELECT DISTINCT user_id FROM train)),
item_map AS MATERIALIZED (SELECT item_id AS id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM (SELECT DISTINCT item_id FROM train)),
matrix AS MATERIALIZED (
  SELECT u.idx AS user_idx, i.idx AS item_idx, count(*) AS value
  FROM train t JOIN user_map u ON t.user_id = u.id JOIN item_map i ON t.item_id = i.id GROUP BY 1, 2)"""

POPULARITY = """counts AS (SELECT item_id, count(*) AS interaction_count FROM train GROUP BY 1),
popularity AS MATERIALIZED (
  SELECT item_id, interaction_count,
         CAST(rank() OVER (ORDER BY interaction_count DESC) AS INTEGER) AS popularity_rank,
         round_even((rank() OVER (ORDER BY interaction_count)
                + (count(*) OVER (PARTITION BY interaction_count) - 1) / CAST(2 AS DOUBLE))
               / count(*) OVER () * 100, 1) AS popularity_percentile
  FROM counts)"""

EDGES = """norms AS MATERIALIZED (SELECT item_idx, sum(value * value) AS n2 FROM matrix GROUP BY 1),
dots AS (
  SELECT a.item_idx AS item_i, b.item_idx AS item_j, CAST(sum(a.value * b.value) AS DOUBLE) AS dot
  FROM matrix a JOIN matrix b ON a.user_idx = b.user_idx AND a.item_idx <> b.item_idx GROUP BY 1, 2),
sims AS (
  SELECT item_i, item_j, dot / sqrt(CAST(x.n2 * y.n2 AS DOUBLE)) AS sim
  FROM dots JOIN norms x ON x.item_idx = item_i JOIN norms y ON y.item_idx = item_j),
edges AS MATERIALIZED (
  SELECT item_i, item_j, sim FROM sims
  QUALIFY row_number() OVER (PARTITION BY item_i ORDER BY sim DESC, item_j) <= 50)"""

SCORES = """scores AS MATERIALIZED (
  SELECT m.user_idx, e.item_j AS item_idx, round(sum(e.sim), 9) AS score
  FROM matrix m JOIN edges e ON e.item_i = m.item_idx GROUP BY 1, 2),
open_scores AS (SELECT * FROM scores s ANTI JOIN matrix m USING (user_idx, item_idx)),
scored_recs AS MATERIALIZED (
  SELECT user_idx, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS rank, item_idx, score
  FROM open_scores QUALIFY rank <= 20)"""

PREPARED = with_(RATINGS, kcore(), CUTOFFS, SPLIT)
INDEXED = with_(RATINGS, kcore(), CUTOFFS, SPLIT, IDS)
POPULAR = with_(RATINGS, kcore(), CUTOFFS, SPLIT, POPULARITY, ITEMS)
EDGED = with_(RATINGS, kcore(), CUTOFFS, SPLIT, IDS, EDGES)
SCORED = with_(RATINGS, kcore(), CUTOFFS, SPLIT, IDS, EDGES, SCORES)
