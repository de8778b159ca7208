"""Interaction tables derived from the generic star-schema test tables.

Ratings come from orders and line items, items from parts, the request log from events,
vectors from embeddings. Every row of the source tables takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(c: str) -> Column:
    """Unix seconds of a wall-clock timestamp, whatever the session time zone."""
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast({c} as timestamp_ntz))")


def ratings(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """``user_id, item_id, rating 1..5, timestamp``; with ``keyed`` also the order line."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    key = [F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line")] if keyed else []
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.floor((F.col("l_quantity").cast("int") - 1) / 10) + 1).cast("int").alias("rating"),
        epoch_seconds("l_shipdate").alias("timestamp"),
        *key,
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, title, p_type, word``: uncleaned titles with years, articles and spacing."""
    tail = F.element_at(
        F.array(F.lit(""), F.lit(", The"), F.lit(",  a"), F.lit("  ")), F.pmod("p_size", F.lit(4)) + 1
    )
    year = F.when(F.pmod("p_size", F.lit(5)) > 0, F.concat(F.lit(" ("), F.col("p_size") + 1950, F.lit(") "))).otherwise("")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.concat("p_name", tail, year).alias("title"),
        "p_type", F.split("p_name", " ")[0].alias("word"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, title, year, genres``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        (F.col("p_size") + 1950).alias("year"),
        F.array("p_type", F.split("p_name", " ")[0]).alias("genres"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a request log."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    ident = F.col("event_id")
    ids = F.sequence(k, k + F.pmod(ident, F.lit(10)))
    text = F.when(ident % 11 == 0, None).when(ident % 13 == 0, "bad").otherwise(F.to_json(ids))
    kind = F.col("event_type")
    endpoint = F.when(kind == "click", "/similar").when(kind == "purchase", "/popular").otherwise("/recommend")
    is_fallback = (ident % 7 == 0) & (endpoint == "/recommend")
    reason = (
        F.when(~is_fallback, None)
        .when(ident % 3 == 0, "popularity")
        .when(ident % 3 == 1, F.concat(F.lit("popularity:genre="), kind))
        .otherwise(F.concat(F.lit("similar_to_seed:"), k))
    )
    return e.select(
        ident.cast("string").alias("request_id"),
        F.col("ts").alias("timestamp"),
        F.when(kind != "purchase", F.col("user_id")).alias("user_id"),
        endpoint.alias("endpoint"),
        F.when(ident % 3 == 1, "v1").when(ident % 3 == 2, F.when(ident % 2 == 0, "v2").otherwise("")).alias("model_version"),
        text.alias("recommendations"),
        F.col("value").alias("latency_ms"),
        is_fallback.alias("is_fallback"),
        reason.alias("fallback_reason"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as recommendation requests, a fifth of them from unknown users."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    ident = F.col("event_id")
    types = F.array(*[F.lit(t) for t in ("ECONOMY", "STANDARD", "PROMO", "LARGE")])
    pick = F.element_at(types, (k % 4 + 1).cast("int"))
    return e.select(
        ident.cast("string").alias("request_id"),
        F.when(ident % 5 == 0, F.col("user_id") + 100_000_000).otherwise(F.col("user_id")).alias("user_id"),
        (k % 20 + 1).cast("int").alias("k"),
        F.when(k % 3 == 1, F.array(pick)).when(k % 3 == 2, F.array(pick, F.lit("red"))).alias("genres"),
        F.when(k % 4 == 0, (F.lit(1955) + k % 10).cast("int")).alias("year_min"),
        F.when(k % 5 == 0, (F.lit(1980) + k % 10).cast("int")).alias("year_max"),
        F.when(k % 10 == 0, k).alias("seed_item"),
        k.alias("item_id"),
        (k % 7 != 0).alias("exclude_seen"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, vec``."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"))


def user_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, vec``: each customer gets the vector numbered by its key, wrapping around."""
    v = vectors(spark, sf_dir)
    n = v.agg(F.count(F.lit(1))).scalar()
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return users.withColumn("item_id", F.col("user_id") % n).join(v, "item_id").select("user_id", "vec")
