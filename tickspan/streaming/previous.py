"""Final bars with their previous close, one close per code carried from batch to batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import Slots, previous_close
from ..operators.keyed_table import read_parquet
from ..schemas import BAR, BAR_COLUMNS
from .jobs import start_query

CARRIED = T.StructType([f for f in BAR.fields if f.name in ("code", "window_start", "close")])


def price_batch(spark: SparkSession, root: str, closed: DataFrame, number: int) -> None:
    """Write the closed bars of one micro-batch with prev_close to root/priced/batch=number.

    The batch is written first, so its plan runs once. Inside the batch a code's history is looked
    through by days (see `previous_close`), so a backfill that closes years of one code at once is
    spread over tasks; from earlier batches one close per code is read. A replay reads what the
    first try read and replaces what it wrote.
    """
    place = f"{root}/closed/batch={number}"
    closed.select(*BAR_COLUMNS).write.mode("overwrite").parquet(place)
    bars = spark.read.schema(BAR).parquet(place)
    carried = Slots(f"{root}/carried", CARRIED)
    _, before = carried.newest(spark, before=number)
    names = CARRIED.fieldNames()
    view = bars.select(*names)
    if before is not None:
        view = view.unionByName(before.select(*names))
    priced = bars.join(previous_close(view).drop("close"), ["code", "window_start"])
    priced.write.mode("overwrite").parquet(f"{root}/priced/batch={number}")
    newest = view.groupBy("code").agg(
        F.max("window_start").alias("window_start"),
        F.max_by("close", "window_start").alias("close"),
    )
    if not view.isEmpty():
        carried.write(spark, newest, number)


def start_priced_bars(
    final_bars: DataFrame,
    root: str,
    checkpoint: str,
    once: bool = False,
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Final bars (append mode) with prev_close; read them with `priced_bars`.

    Micro-batches emit final bars in watermark order, so the carried close is always the newest
    before the batch.
    """
    spark = final_bars.sparkSession

    def on_batch(batch: DataFrame, number: int) -> None:
        price_batch(spark, root, batch, number)

    writer = final_bars.writeStream.outputMode("append").foreachBatch(on_batch)
    return start_query(spark, writer, checkpoint, once, every, state_partitions)


def priced_bars(spark: SparkSession, root: str) -> DataFrame:
    """All final bars written so far, with prev_close."""
    schema = T.StructType([*BAR.fields, T.StructField("prev_close", T.DoubleType())])
    place = f"{root}/priced"
    return read_parquet(spark, schema, place, place).select(*schema.fieldNames())
