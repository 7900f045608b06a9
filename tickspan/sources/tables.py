"""Ticks derived from stored tables of timestamped, keyed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import event_time


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def between(df: DataFrame, column: str, since: str | None, until: str | None) -> DataFrame:
    """since <= column < until, as plain comparisons that reach the Parquet scan."""
    kind = df.schema[column].dataType
    if since is not None:
        df = df.filter(F.col(column) >= F.lit(since).cast(kind))
    if until is not None:
        df = df.filter(F.col(column) < F.lit(until).cast(kind))
    return df


def ticks_from_events(
    events: DataFrame,
    since: str | None = None,
    until: str | None = None,
    precision: str = "millis",
) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return (
        between(events, "ts", since, until)
        .select(
            F.col("event_id"),
            F.col("event_type").alias("code"),
            F.col("value").alias("trade_price"),
            F.get_json_object("props", "$.k").cast("double").alias("trade_volume"),
            millis.alias("timestamp"),
            F.when(F.col("user_id") % 2 == 0, "ASK").otherwise("BID").alias("ask_bid"),
        )
        .withColumn("event_time", event_time(F.col("timestamp"), precision))
    )


def ticks_from_orders(
    orders: DataFrame, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Orders as ticks: many share a day, so bars need `o_orderkey` as tie-break."""
    at = F.col("o_orderdate").cast("timestamp")
    return between(orders, "o_orderdate", since, until).select(
        F.col("o_orderkey"),
        F.col("o_orderpriority").alias("code"),
        F.col("o_totalprice").alias("trade_price"),
        F.lit(1.0).alias("trade_volume"),
        F.unix_millis(at).alias("timestamp"),
        F.lit(None).cast("string").alias("ask_bid"),
        at.alias("event_time"),
    )
