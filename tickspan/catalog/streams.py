"""Streaming queries: run to the end of the input, return the stored result.

A sequence of micro-batches is made by writing time slices of the ticks into one folder and
draining the stream after each, on one checkpoint, as a job that is stopped and restarted does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import change_rate
from ..operators import recompute_thresholds
from ..plans.detection import apply_bars
from ..plans.store import Store
from ..session import as_table, configure, new_folder
from ..sources import file_source_options, parse_ticks, ticks_from_events, to_messages
from ..streaming import (
    Tally,
    counted,
    drain,
    final_bars,
    final_wider_bars,
    flush_tick,
    open_bars,
    priced_bars,
    print_messages,
    start_alert_feed,
    start_bars,
    start_final_bars,
    start_priced_bars,
    start_quarantine,
    tallied,
    with_previous_close,
)
from .batch import AS_OF, faulty_messages, hourly, load, rounded, ticks

WIDTH = "1 hour"
MID_BAR = ("2024-01-11 00:30:00", "2024-01-21 00:30:00")
BAR_EDGE = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
LATE_UNTIL = "2024-01-05 00:00:00"


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream; the pattern fits a single file as well as a directory."""
    configure(spark)
    schema = load(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")


def in_slices(
    spark: SparkSession,
    slices: Sequence[DataFrame],
    start: Callable[[DataFrame], StreamingQuery],
) -> None:
    folder = new_folder(spark, "ticks")
    for part in slices:
        part.write.mode("append").parquet(folder)
        drain(start(spark.readStream.schema(part.schema).parquet(folder)))


def cut(spark: SparkSession, folder: str, at: Sequence[str]) -> list[DataFrame]:
    edges = [None, *at, None]
    return [
        ticks(spark, folder, since=a, until=b) for a, b in zip(edges, edges[1:], strict=False)
    ]


def run_bars(
    spark: SparkSession, feed: DataFrame, store: Store, checkpoint: str, width: str = WIDTH
) -> StreamingQuery:
    cores = spark.sparkContext.defaultParallelism
    return start_bars(
        spark, feed, store, checkpoint, width=width, once=True, state_partitions=cores
    )


def run_final_bars(bars: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    cores = bars.sparkSession.sparkContext.defaultParallelism
    return start_final_bars(bars, path, checkpoint, once=True, state_partitions=cores)


def new_store(spark: SparkSession) -> tuple[Store, str]:
    return Store(new_folder(spark, "store")), new_folder(spark, "checkpoint")


def stream_ohlcv_update_final(spark, folder):
    """The table is streamed as it is; every bar is upserted."""
    store, checkpoint = new_store(spark)
    feed = ticks_from_events(stream_events(spark, folder))
    drain(run_bars(spark, feed, store, checkpoint))
    return rounded(store.ohlcv.current(spark).drop("created_at"), "volume")


def stream_restart(spark, folder):
    """Three runs on one checkpoint, cut inside a bar; then the last batch is applied again."""
    store, checkpoint = new_store(spark)
    in_slices(
        spark,
        cut(spark, folder, MID_BAR),
        lambda feed: run_bars(spark, feed, store, checkpoint),
    )
    rows = store.ohlcv.versions(spark)
    last = rows.agg(F.max("batch").alias("batch")).first()["batch"]
    again = as_table(store.ohlcv.version(spark, 1, last), "again")
    apply_bars(spark, store, again, 1, last)
    return rounded(store.ohlcv.current(spark).drop("created_at"), "volume")


def stream_ohlcv_append(spark, folder):
    """Final bars only: those whose end the watermark has passed."""
    out, checkpoint = new_store(spark)
    feed = ticks_from_events(stream_events(spark, folder))
    drain(run_final_bars(final_bars(feed, WIDTH), out.root, checkpoint))
    return rounded(spark.read.parquet(out.root), "volume")


def stream_late_data(spark, folder):
    """The errors of the first days arrive last of all; their bars are long closed."""
    store, checkpoint = new_store(spark)
    late = F.col("code") == "error"
    first, rest = cut(spark, folder, [LATE_UNTIL])
    in_slices(
        spark,
        [first.filter(~late), rest, first.filter(late)],
        lambda feed: run_bars(spark, feed, store, checkpoint),
    )
    return rounded(store.ohlcv.current(spark).drop("created_at"), "volume")


def with_thresholds(spark: SparkSession, thresholds: DataFrame) -> tuple[Store, str]:
    store, checkpoint = new_store(spark)
    store.anomaly_threshold.append(thresholds, 0, 0)
    return store, checkpoint


def stream_anomaly_log(spark, folder):
    """Slices end at bar edges, so no bar is judged before it is complete."""
    found = recompute_thresholds(hourly(spark, folder), AS_OF)
    store, checkpoint = with_thresholds(spark, found)
    in_slices(
        spark,
        cut(spark, folder, BAR_EDGE),
        lambda feed: run_bars(spark, feed, store, checkpoint),
    )
    log = store.anomaly_log.current(spark).drop("detected_at")
    return rounded(log, "volume", "change_rate")


def stream_alerts(spark, folder):
    found = recompute_thresholds(hourly(spark, folder), AS_OF)
    store, checkpoint = with_thresholds(spark, found)
    in_slices(
        spark,
        cut(spark, folder, BAR_EDGE),
        lambda feed: run_bars(spark, feed, store, checkpoint),
    )
    return store.alerts.current(spark).select("code", "window_start", "message")


def stream_prev_close(spark, folder):
    """At threshold zero every bar that has a predecessor is logged, with its previous close."""
    codes = ticks(spark, folder).select("code").distinct()
    zero = F.lit(0.0)
    always = codes.select(
        "code",
        zero.alias("threshold"),
        zero.alias("avg_change"),
        zero.alias("std_change"),
        F.lit(AS_OF).cast("timestamp").alias("calculated_at"),
    )
    store, checkpoint = with_thresholds(spark, always)
    in_slices(
        spark,
        cut(spark, folder, BAR_EDGE),
        lambda feed: run_bars(spark, feed, store, checkpoint),
    )
    log = store.anomaly_log.current(spark)
    return rounded(
        log.select("code", "window_start", "close", "prev_close", "change_rate"), "change_rate"
    )


def with_rate(priced: DataFrame) -> DataFrame:
    rate = change_rate(F.col("close"), F.col("prev_close"))
    return rounded(
        priced.select("code", "window_start", "close", "prev_close", rate.alias("change_rate")),
        "change_rate",
    )


def stream_prev_close_state(spark, folder):
    """Final bars with their previous close out of the state store; three runs on one checkpoint."""
    out, checkpoint = new_store(spark)

    def start(feed):
        bars = with_previous_close(final_bars(feed, WIDTH))
        return run_final_bars(bars, out.root, checkpoint)

    in_slices(spark, cut(spark, folder, MID_BAR), start)
    return with_rate(spark.read.parquet(out.root))


def stream_prev_close_carried(spark, folder):
    """Final bars with their previous close, one close per code carried between batches."""
    out, checkpoint = new_store(spark)

    cores = spark.sparkContext.defaultParallelism

    def start(feed):
        bars = final_bars(feed, WIDTH)
        return start_priced_bars(bars, out.root, checkpoint, once=True, state_partitions=cores)

    in_slices(spark, cut(spark, folder, MID_BAR), start)
    return with_rate(priced_bars(spark, out.root))


def stream_open_bars(spark, folder):
    """The bars that append mode has not emitted, read from the state of the query."""
    out, checkpoint = new_store(spark)
    feed = ticks_from_events(stream_events(spark, folder))
    drain(run_final_bars(final_bars(feed, WIDTH), out.root, checkpoint))
    return rounded(open_bars(spark, checkpoint), "volume")


def stream_1h_from_1m(spark, folder):
    """Hourly final bars made of the minute bars of the same query."""
    out, checkpoint = new_store(spark)

    def start(feed):
        return run_final_bars(final_wider_bars(feed, WIDTH), out.root, checkpoint)

    in_slices(spark, cut(spark, folder, MID_BAR), start)
    return rounded(spark.read.parquet(out.root), "volume")


def stream_json_bars(spark, folder):
    """JSON messages in files, parsed as a stream, to one-minute bars."""
    path = new_folder(spark, "messages")
    to_messages(ticks(spark, folder)).write.parquet(path)
    raw = spark.readStream.schema("key binary, value binary").parquet(path)
    store, checkpoint = new_store(spark)
    drain(run_bars(spark, parse_ticks(raw), store, checkpoint, "1 minute"))
    return rounded(store.ohlcv.current(spark).drop("created_at"), "volume")


def stream_quarantine(spark, folder):
    path = new_folder(spark, "messages")
    faulty_messages(spark, folder).write.parquet(path)
    raw = spark.readStream.schema("event_id long, value binary").parquet(path)
    out, checkpoint = new_store(spark)
    drain(start_quarantine(parse_ticks(raw, keep=["event_id"]), out.root, checkpoint, once=True))
    return spark.read.parquet(out.root).select("event_id", "code", "defect")


def faulty_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks of which some have no volume, some no price, and some a code of over 20 characters."""
    number = F.col("event_id")
    long_code = F.concat("code", F.lit("-with-a-very-long-name"))
    return ticks(spark, folder).withColumns(
        {
            "code": F.when(number % 13 == 0, long_code).otherwise(F.col("code")),
            "trade_price": F.when(number % 11 != 0, F.col("trade_price")),
            "trade_volume": F.when(number % 7 != 0, F.col("trade_volume")),
        }
    )


def stream_null_fields(spark, folder):
    """Ticks with missing fields are in the bars of a stream as they are in those of a batch."""
    store, checkpoint = new_store(spark)
    feed = lambda rows: run_bars(spark, rows, store, checkpoint)
    in_slices(spark, [faulty_ticks(spark, folder)], feed)
    return rounded(store.ohlcv.current(spark).drop("created_at"), "volume")


def stream_flushed_append(spark, folder):
    """Final bars of a bounded run: a late tick closes the last ones."""
    out, checkpoint = new_store(spark)
    feed = ticks(spark, folder)
    newest = feed.agg(F.max("event_time")).first()[0]
    late = flush_tick(spark, feed.schema, newest + timedelta(days=1))

    def start(rows):
        return run_final_bars(final_bars(rows, WIDTH), out.root, checkpoint)

    in_slices(spark, [feed, late], start)
    return rounded(spark.read.parquet(out.root), "volume")


PACE = 2


def paced(spark: SparkSession, folder: str) -> tuple[Store, StreamingQuery]:
    """Bars from a query that takes one file of ticks every two seconds, until it has all."""
    place = new_folder(spark, "ticks")
    for part in cut(spark, folder, BAR_EDGE):
        part.coalesce(1).write.mode("append").parquet(place)
    schema = ticks(spark, folder).schema
    options = file_source_options(per_trigger=1)
    feed = spark.readStream.schema(schema).options(**options).parquet(place)
    store, checkpoint = new_store(spark)
    cores = spark.sparkContext.defaultParallelism
    every = f"{PACE} seconds"
    query = start_bars(
        spark, feed, store, checkpoint, width=WIDTH, every=every, state_partitions=cores
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return store, query


def stream_trigger_interval(spark, folder):
    """The same bars from a paced query: several micro-batches, each at its time."""
    store, _ = paced(spark, folder)
    return rounded(store.ohlcv.current(spark).drop("created_at"), "volume")


def stream_alert_feed(spark, folder):
    """The outbox read as a stream: stopped and started between batches, and behind a replay."""
    found = recompute_thresholds(hourly(spark, folder), AS_OF)
    store, checkpoint = with_thresholds(spark, found)
    out, own = new_store(spark)

    def read():
        drain(start_alert_feed(spark, store, out.root, own, once=True, state_partitions=2))

    def start(feed):
        read()
        return run_bars(spark, feed, store, checkpoint)

    in_slices(spark, cut(spark, folder, BAR_EDGE), start)
    read()
    last = store.alerts.versions(spark).agg(F.max("batch").alias("batch")).first()["batch"]
    again = as_table(store.ohlcv.version(spark, 1, last), "again")
    apply_bars(spark, store, again, 1, last)
    read()
    return spark.read.parquet(out.root).select("code", "window_start", "message")


def stream_late_count(spark, folder):
    """How many ticks came too late over three runs of a query: those observed, less those in bars."""
    store, checkpoint = new_store(spark)
    late = F.col("code") == "error"
    first, rest = cut(spark, folder, [LATE_UNTIL])
    tally, runs = Tally(), []
    spark.streams.addListener(tally)

    def start(feed):
        runs.append(run_bars(spark, counted(feed), store, checkpoint))
        return runs[-1]

    try:
        in_slices(spark, [first.filter(~late), rest, first.filter(late)], start)
        for run in runs:
            tally.wait(run)
    finally:
        spark.streams.removeListener(tally)
    place = new_folder(spark, "tally")
    tally.write(spark, place)
    in_bars = F.lit(store.ohlcv.current(spark).agg(F.sum("trade_count")).first()[0])
    return tallied(spark, place).select(
        "runs", "ticks", in_bars.alias("in_bars"), (F.col("ticks") - in_bars).alias("late")
    )


def console_sink(spark, folder):
    """Raw messages shown on the console; how many the query took."""
    path = new_folder(spark, "messages")
    to_messages(ticks(spark, folder)).write.parquet(path)
    raw = spark.readStream.schema("key binary, value binary").parquet(path)
    query = drain(print_messages(raw, new_folder(spark, "checkpoint"), once=True))
    taken = sum(p.numInputRows for p in query.recentProgress)
    return spark.createDataFrame([(taken,)], "n_messages long")


def stream_replay_log(spark, folder):
    """The last batch is applied again after the thresholds changed: log and outbox stay."""
    found = recompute_thresholds(hourly(spark, folder), AS_OF)
    store, checkpoint = with_thresholds(spark, found)
    feed = lambda rows: run_bars(spark, rows, store, checkpoint)
    in_slices(spark, cut(spark, folder, BAR_EDGE), feed)
    for threshold, moment in ((0.0, 1), (1e9, 2)):
        changed = found.withColumn("threshold", F.lit(threshold))
        store.anomaly_threshold.append(changed, 0, moment)
        rows = store.ohlcv.versions(spark)
        last = rows.agg(F.max("batch").alias("batch")).first()["batch"]
        again = as_table(store.ohlcv.version(spark, 1, last), "again")
        apply_bars(spark, store, again, 1, last)
    keys = ["code", "window_start"]
    alerts = store.alerts.versions(spark).groupBy(*keys).agg(F.count(F.lit(1)).alias("alerts"))
    log = store.anomaly_log.current(spark).drop("detected_at")
    return rounded(log.join(alerts, keys, "full"), "volume", "change_rate")


STREAMS = {
    "stream_ohlcv_update_final": stream_ohlcv_update_final,
    "stream_ohlcv_append": stream_ohlcv_append,
    "stream_restart": stream_restart,
    "stream_late_data": stream_late_data,
    "stream_anomaly_log": stream_anomaly_log,
    "stream_alerts": stream_alerts,
    "stream_prev_close": stream_prev_close,
    "stream_prev_close_state": stream_prev_close_state,
    "stream_prev_close_carried": stream_prev_close_carried,
    "stream_open_bars": stream_open_bars,
    "stream_1h_from_1m": stream_1h_from_1m,
    "stream_json_bars": stream_json_bars,
    "stream_quarantine": stream_quarantine,
    "stream_null_fields": stream_null_fields,
    "stream_flushed_append": stream_flushed_append,
    "stream_trigger_interval": stream_trigger_interval,
    "stream_alert_feed": stream_alert_feed,
    "stream_late_count": stream_late_count,
    "stream_replay_log": stream_replay_log,
    "console_sink": console_sink,
}
