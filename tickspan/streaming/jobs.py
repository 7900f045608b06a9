"""Structured Streaming jobs over parsed ticks.

Triggers: the default starts a micro-batch as soon as the last one ends, `every="1 minute"` at
that pace (each batch is one version in the store, so a pace bounds their number), `once=True`
drains what is there and stops, and can be repeated on the same checkpoint.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators import aggregate_ohlcv, barless_ticks, flatten_bars, wider_ohlcv
from ..operators.bars import LATENESS, WIDTH
from ..operators.quality import quarantined_ticks
from ..plans.detection import apply_bars
from ..plans.store import Store
from .epochs import claim_epoch

_STARTING = threading.Lock()
#: The code of the tick that closes all bars.
FLUSH = ""
#: Rows of a micro-batch that the console shows; as many as Spark shows by itself.
SHOWN = 20


def start_query(
    spark: SparkSession,
    writer: DataStreamWriter,
    checkpoint: str,
    once: bool = False,
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a query. A new checkpoint fixes its number of state partitions for good, so it can
    be chosen apart from the session's shuffle partitions, which batch plans adapt at run time.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    with _STARTING:  # the setting is the session's: no two queries may start with each other's
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or before))
        try:
            return writer.start()  # the query works on a copy of the session's settings
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a `once` query, or run until stopped."""
    query.awaitTermination()
    return query


def start_bars(
    spark: SparkSession,
    ticks: DataFrame,
    store: Store,
    checkpoint: str,
    epoch: int | None = None,
    width: str = WIDTH,
    lateness: str = LATENESS,
    tie_break: str | None = None,
    files_per_day: int | None = None,
    once: bool = False,
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Update mode: every micro-batch upserts the bars it touched, judges and logs them.

    The bars are those of a batch run over the same ticks. `start_quarantine` keeps the ticks that
    are in none. The epoch is the checkpoint's own; a new checkpoint gets a new one.
    """
    epoch = claim_epoch(spark, store, checkpoint, epoch)
    bars = flatten_bars(aggregate_ohlcv(ticks, width, lateness, tie_break))

    def on_batch(batch: DataFrame, number: int) -> None:
        # Reads run in the caller's session, which plans adaptively; the batch's own does not.
        apply_bars(spark, store, batch, epoch, number, files_per_day=files_per_day)

    writer = bars.writeStream.outputMode("update").foreachBatch(on_batch)
    return start_query(spark, writer, checkpoint, once, every, state_partitions)


def final_bars(
    ticks: DataFrame, width: str = WIDTH, lateness: str = LATENESS, tie_break: str | None = None
) -> DataFrame:
    """Bars for append mode: each comes out once, when the watermark has passed its end."""
    return flatten_bars(aggregate_ohlcv(ticks, width, lateness, tie_break))


def final_wider_bars(
    ticks: DataFrame,
    width: str,
    fine: str = WIDTH,
    lateness: str = LATENESS,
    tie_break: str | None = None,
) -> DataFrame:
    """`final_bars` of a wide width, made of final bars of a finer one in one query.

    The second aggregation holds one row per code and wide bar and takes a row per fine bar, however
    many ticks there are; its watermark is the first one's.
    """
    return flatten_bars(wider_ohlcv(aggregate_ohlcv(ticks, fine, lateness, tie_break), width))


def flush_tick(spark: SparkSession, schema: T.StructType, moment: datetime) -> DataFrame:
    """One tick of the code FLUSH, so late that the watermark closes all bars before `moment`.

    Append it to a bounded feed, then run the query once more: append mode then emits the bars
    that are still open. The tick's own bar has no price and stays open; a later flush emits it.
    (A tick without a code would be filtered out before it moves the watermark.) `schema` is the
    feed's; `event_time` gives the tick's time.
    """
    given = {"code": F.lit(FLUSH), "event_time": F.lit(moment)}
    values = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).select(*values)


def start_final_bars(
    bars: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append final bars to Parquet files (exactly once, by the file sink's own log)."""
    writer = bars.writeStream.outputMode("append").format("parquet").option("path", path)
    return start_query(bars.sparkSession, writer, checkpoint, once, every, state_partitions)


def start_quarantine(
    ticks: DataFrame, path: str, checkpoint: str, once: bool = False, strict: bool = True
) -> StreamingQuery:
    """Keep the ticks that break the tick table's constraints, with the reason.

    With strict=False only those that no bar holds are kept.
    """
    found = quarantined_ticks(ticks) if strict else barless_ticks(ticks)
    writer = found.writeStream.outputMode("append").format("parquet")
    return start_query(ticks.sparkSession, writer.option("path", path), checkpoint, once)


def first_of_tasks(rows: DataFrame, number: int) -> DataFrame:
    """The first rows of every task. The others are read as well, and counted in the progress."""

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = number
        for batch in batches:
            if left:
                part = batch.slice(0, left)
                left -= part.num_rows
                yield part

    return rows.mapInArrow(first, rows.schema)


def print_messages(messages: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Show raw values on the console: the first SHOWN of every micro-batch.

    The console sink takes all rows it is given to the driver before it shows the first ones, so a
    task hands on only as many as can be shown, and one by which the sink knows that there are more.
    """
    text = messages.select(F.col("value").cast("string").alias("value"))
    writer = first_of_tasks(text, SHOWN + 1).writeStream.format("console")
    writer = writer.option("numRows", SHOWN).option("truncate", "false")
    return start_query(messages.sparkSession, writer, checkpoint, once)

