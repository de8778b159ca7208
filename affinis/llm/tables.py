"""Reading test tables and small shared column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.session import checkpoint_dir

#: White space that separates words.
SPACES = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder as a URI."""
    folder = checkpoint_dir(spark)
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def word_array(text: Column) -> Column:
    """The words of a text in order; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    return F.filter(parts, lambda x: x != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once for each row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Bytes of the filter of ``may_hold``, whatever the number of ids.
FILTER_BYTES = 1 << 17


def may_hold(ids: DataFrame, column: str) -> Column:
    """False only for rows whose ``column`` is in no row of ``ids``; never null.

    A filter of fixed size that keeps most rows without a partner out of a shuffle. With very
    many ids it lets all rows pass, which changes no result.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(FILTER_BYTES * 8))
    packed = (
        ids.select(bit.alias("at"))
        .groupBy(F.shiftright("at", 3).alias("byte"))
        .agg(F.bit_or(F.expr("shiftleft(1, cast(at & 7 as int))")).alias("bits"))
    )
    held = bytearray(FILTER_BYTES)
    for r in packed.collect():  # FILTER_BYTES rows at most
        held[r.byte] = r.bits
    byte = F.substring(F.lit(bytes(held)), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", value, bit.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
