"""Bars that a running or stopped query still holds in its state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BAR_COLUMNS

#: The buffers of the bar aggregates, in their order; min_by and max_by keep an ordering besides.
_BUFFERS = ("open", "_opened", "high", "low", "close", "_closed", "volume", "trade_count")


def bar_operator(spark: SparkSession, checkpoint: str, operator: int | None = None) -> int:
    """The number of the operator that makes bars; of several (wider bars) the last one.

    An `operator` that is given must be one of them.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    makers = operators.filter("operatorName = 'stateStoreSave'")
    if operator is not None:
        makers = makers.filter(F.col("operatorId") == operator)
    found = makers.agg(F.min("operatorId")).first()[0]
    if found is None:
        raise ValueError(f"no such operator of {checkpoint} makes bars")
    return found


def open_bars(
    spark: SparkSession, checkpoint: str, batch: int | None = None, operator: int | None = None
) -> DataFrame:
    """The bars in the state of a query over `aggregate_ohlcv`, as they stand after a micro-batch.

    In append mode these are the bars whose end the watermark hasn't passed: those that the sink
    doesn't have. In update mode they are the bars that may change yet. The state is read as a
    table, a task per state partition, beside the query and without a change to it. `batch` is the
    newest committed one by default; older ones are there as long as the checkpoint keeps them.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    number = bar_operator(spark, checkpoint, operator)
    state = reader.option("operatorId", number).load(checkpoint)
    held = state.schema["value"].dataType
    if len(held) != len(_BUFFERS):
        raise ValueError(f"operator {number} of {checkpoint} doesn't make bars")
    # two buffers of the same kind have the same names, so they are named anew by position
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(_BUFFERS, held.fields)])
    return state.select(
        F.col("key.code").alias("code"),
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col("value").cast(named).alias("bar"),
    ).select("code", "window_start", "window_end", *(f"bar.{c}" for c in BAR_COLUMNS[3:]))
