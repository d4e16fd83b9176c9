"""Market-data views of the star-schema tables: a trade tape, book levels, open-interest samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import valid_trade


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(ts: Column) -> Column:
    """Epoch milliseconds of a UTC wall-clock timestamp without zone, whatever the session's zone."""
    wall = ts.cast("timestamp_ntz")
    return F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall).cast("timestamp"))


def raw_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """market, ts, side, price, qty, idx of every event, invalid ones included."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("market"), millis(F.col("ts")).alias("ts"),
        F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.col("value").alias("price"), F.get_json_object("props", "$.k").try_cast("double").alias("qty"), F.col("event_id").alias("idx"),
    )


def tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid trades of raw_tape."""
    return raw_tape(spark, sf_dir).where(valid_trade(F.col("price"), F.col("qty"), F.col("side"), F.col("ts")))


#: The order of book events; ship dates tie heavily.
BOOK_ORDER = ("ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "qty0", "l_extendedprice")


def book_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """market, side (bid/ask), price, qty (0 deletes), ts and an order key: one level change per row."""
    i = table(spark, sf_dir, "lineitem")
    return i.select(
        F.col("l_returnflag").alias("market"), F.when(F.col("l_linestatus") == "F", "bid").otherwise("ask").alias("side"),
        F.when(F.col("l_linestatus") == "F", F.col("l_partkey") % 50).otherwise(F.col("l_partkey") % 50 + 40).cast("double").alias("price"),
        F.when(F.col("l_linenumber") == 7, 0.0).otherwise(F.col("l_quantity")).alias("qty"), millis(F.col("l_shipdate")).alias("ts"),
        F.struct(millis(F.col("l_shipdate")), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("ord"),
    )


def oi_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """market, ts, oi, idx: one open-interest sample per order."""
    o = table(spark, sf_dir, "orders")
    return o.select((F.col("o_custkey") % 20).alias("market"), millis(F.col("o_orderdate")).alias("ts"), F.col("o_totalprice").alias("oi"), F.col("o_orderkey").alias("idx"))


def oi_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """market, ts, anchor: one moment per line item at which the latest sample is wanted."""
    i = table(spark, sf_dir, "lineitem")
    return i.select((F.col("l_suppkey") % 20).alias("market"), millis(F.col("l_shipdate")).alias("ts"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("anchor"))
