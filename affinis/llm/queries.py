"""One query for each operator, over whole tables, and SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm import urls
from affinis.llm.tables import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op10_simhash_groups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    from affinis.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def held_out():
    """Documents that the language query never learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by profiles of three quarters of the labelled ones."""
    from affinis.llm.langid import RankOrder, identify

    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    model = RankOrder.learn(docs.filter(~F.col("held_out")))
    return identify(docs, model, ["doc_id", "held_out"])


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) AS again,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM d GROUP BY source
), w AS (
  SELECT *, number % 3 + 1 AS w, source_size * 3 / (number % 3 + 1) AS ratio FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER before, 0))
          / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM w
  WINDOW before AS (ORDER BY ratio, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT level AS common FROM l WHERE level <= ratio ORDER BY ratio, number LIMIT 1
), t AS (
  SELECT source, source_size, number,
         least((source_size * 3)::DOUBLE, w * common) AS target
  FROM l, c
), g AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t
), h AS (
  SELECT *, floor(ratio)::BIGINT AS whole, target - floor(ratio) * source_size AS rest FROM g
), z AS (
  SELECT number, any_value(rest) AS rest, any_value(source_size)::BIGINT AS source_size, size, count(*) AS n
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source GROUP BY number, size
), zl AS (
  SELECT number, size, (rest - (source_size - sum(size * n) OVER upto)) / nullif(sum(size * n * size) OVER upto, 0) AS level
  FROM z WINDOW upto AS (PARTITION BY number ORDER BY size)
), e AS (
  SELECT number, max(size) AS certain, arg_max(level, size) AS level FROM zl WHERE level * size <= 1 GROUP BY number
), u AS (
  SELECT doc_id, size, source_size, target, number, whole, rest,
         CASE WHEN size > certain THEN 1 ELSE coalesce(level * size, 0) END AS pi,
         (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || digest || ':' || again), 1, 12))::BIGINT + 0.5::DOUBLE)
           / 281474976710656::DOUBLE AS u
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source LEFT JOIN e USING (number)
), k AS (
  SELECT *, CASE WHEN pi <= 0 THEN 1 WHEN pi >= 1 THEN 0
                 ELSE u * (1 - pi) / (u * (1 - pi) + (1 - u) * pi) END AS key
  FROM u
), r AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY number ORDER BY key, doc_id NULLS LAST, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN pi > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


@query("op9_mix_sources", MIX_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    from affinis.llm.mixing import mix

    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, by rules learned from the labelled ones."""
    from affinis.llm.quality import judge

    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*base, "n_distinct_words", "n_upper")


@query("op7_url_filter", urls.sql(urls.RULES))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.RULES).drop("score")


@query("op8_repeated_passages")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of every document that an earlier one also has."""
    from affinis.llm.passages import repeated_passages

    found = repeated_passages(table(spark, sf_dir, "documents"))
    names = ["doc_id", "start_word", "end_word", "first_doc_id", "first_start", "first_end", "similarity"]
    return found.toDF(*names)


@query("op6_benchmark_leaks")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold, at the nearest place."""
    from affinis.llm.contamination import leaks

    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = F.min(F.struct("distance", "start", "end")).alias("best")
    return found.groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).agg(best).select(
        "doc_id", "item_id", "best.distance", F.col("best.start").alias("start_word"), F.col("best.end").alias("end_word")
    )


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, n::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 8), lambda g: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * g, 5))::INT >> s) & 31), 1)),
         'string_agg', '')), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first OR first IS NULL THEN NULL ELSE first END AS refers_to
FROM f
"""


@query("op2_warc_archives", WARC_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every page to archives in the shared folder and reads these back."""
    from affinis.llm.warc import read_archives, write_archives

    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder, with_payload=False).drop("url", "payload")


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License statements and notices that documents hold."""
    from affinis.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"))


@query("op5_main_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from affinis.llm.extract import extract

    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


INTERACTIONS_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), f AS (
  SELECT t, min(coalesce(doc_id, 9223372036854775807)) AS first FROM d GROUP BY t
), g AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 50)::INT
         + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
         + 4 * (100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * len(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * (first < coalesce(doc_id, 9223372036854775807))::INT AS mask
  FROM d JOIN f USING (t) LEFT JOIN g USING (doc_id)
), c AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL
), walk AS (
  SELECT '' AS prefix, 0 AS applied, 0 AS bit
  UNION ALL
  SELECT prefix || chr(65 + i), applied | bit, 1 << i
  FROM walk, (SELECT unnest([0, 1, 2, 3, 4]) AS i) WHERE (applied | bit) & (1 << i) = 0
), s AS (
  SELECT part, prefix,
         coalesce(sum(n) FILTER (mask & (applied | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & applied = 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & applied <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & applied = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & applied = 0), 0) AS toxic_lost
  FROM walk, c WHERE prefix <> '' GROUP BY ALL
), o AS (
  SELECT prefix AS filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM walk WHERE len(prefix) = 5
), p AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
         kept, removed, redundant, unique_fails, good_lost, toxic_lost
  FROM o JOIN s ON s.prefix = substr(filter_order, 1, step)
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM p
"""


@query("op11_filter_interactions", INTERACTIONS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every step of every order of five filters does to each source."""
    from affinis.llm.interactions import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LINES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, coalesce(doc_id, 9223372036854775807) AS doc, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), f AS (
  SELECT key, min(doc) AS first FROM k WHERE len(key) >= 10 GROUP BY key HAVING count(DISTINCT doc) >= 2
), g AS (
  SELECT r, count(*) AS n, count(*) FILTER (doc > first) AS gone,
         string_agg(line, chr(10) ORDER BY pos) FILTER (first IS NULL OR doc <= first) AS kept
  FROM k LEFT JOIN f USING (key) GROUP BY r
)
SELECT doc_id, n AS n_lines, gone AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM g JOIN d USING (r)
"""


@query("op12_line_dedup", LINES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the lines that an earlier one has."""
    from affinis.llm.lines import dedup_lines

    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


RANKING_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), q AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), t AS (
  SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL
), s AS (
  SELECT r, sum(tf)::BIGINT AS size FROM t GROUP BY r
), a AS (
  SELECT count(*) AS docs, sum(size)::BIGINT AS total FROM s
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight
  FROM t, a GROUP BY term
), m AS (
  SELECT r, 10 + (90 * size * docs) // total AS m FROM s, a
), x AS (
  SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL
), y AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM x WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM y WHERE rank <= 10
"""


@query("op13_lexical_ranking", RANKING_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    from affinis.llm.ranking import rank

    found = rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
