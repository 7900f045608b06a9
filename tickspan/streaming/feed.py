"""The outbox as a stream: each alert once, for whoever delivers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.store import BAR_KEY, Store
from ..schemas import ALERT
from .jobs import start_query

#: How long an alert that was read is remembered.
REMEMBER = "1 day"


def alert_feed(spark: SparkSession, store: Store, remember: str = REMEMBER) -> DataFrame:
    """New rows of the outbox (ALERT) as a stream; start it on a checkpoint of its own.

    Alerts get into the outbox behind the bars and the log, when their batch is as good as
    committed, so no reader can hold up or fail the job that finds them. A batch that is repeated
    writes its files anew; its alerts are known by their key for `remember` after they were read,
    counted by the clock of the feed, so an alert for an old bar is never late. The files of the
    first try may be gone by then: they are passed over, for the new ones hold the same alerts.
    """
    table = store.alerts
    if not table.exists(spark):
        table.append(spark.createDataFrame([], ALERT), 0, 0)
    return (
        spark.readStream.schema(table.stored_schema)
        .option("ignoreMissingFiles", "true")
        .parquet(table.path)
        .withColumn("_read_at", F.current_timestamp())
        .withWatermark("_read_at", remember)
        .dropDuplicatesWithinWatermark(list(BAR_KEY))
        .select(*ALERT.fieldNames())
    )


def start_alert_feed(
    spark: SparkSession,
    store: Store,
    path: str,
    checkpoint: str,
    remember: str = REMEMBER,
    once: bool = False,
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append each alert once to Parquet files, by the file sink's own log."""
    writer = alert_feed(spark, store, remember).writeStream.outputMode("append").format("parquet")
    return start_query(
        spark, writer.option("path", path), checkpoint, once, every, state_partitions
    )
