"""Command line of the jobs, for spark-submit.

    spark-submit run.py ingest --from text:/landing --to parquet:/ticks --checkpoint /cp/ingest
    spark-submit run.py bars --from parquet:/ticks --store /store --checkpoint /cp/bars
    spark-submit run.py quarantine --from parquet:/ticks --to /bad --checkpoint /cp/bad
    spark-submit run.py close-days --store /store --until 2024-01-30
    spark-submit run.py thresholds --store /store --as-of "2024-01-31 00:00:00" --from-days
    spark-submit run.py alerts --store /store --to /alerts --checkpoint /cp/alerts
    spark-submit run.py open-bars --checkpoint /cp/bars --to /open
    spark-submit run.py panel anomalies --store /store

A source or sink is `format:path`, or `kafka:servers/topic` with the Kafka connector on the
class path.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from .plans.reports import PANELS, panel
from .plans.store import Store
from .plans.thresholds import update_thresholds, update_thresholds_from_days
from .session import configure
from .sources import (
    file_source_options,
    kafka_sink_options,
    kafka_source_options,
    only_symbols,
    parse_ticks,
    pick_fields,
    stream_messages,
    write_messages,
)
from .streaming import drain, open_bars, start_alert_feed, start_bars, start_quarantine


def source(
    spark: SparkSession, place: str, starting: str = "latest", per_trigger: int | None = None
) -> DataFrame:
    fmt, where = place.split(":", 1)
    if fmt == "kafka":
        server_and_topic = where.rsplit("/", 1)
        options = kafka_source_options(
            *server_and_topic, starting=starting, per_trigger=per_trigger
        )
        return stream_messages(spark, fmt, options=options)
    return stream_messages(spark, fmt, where, file_source_options(per_trigger))


def ingest(raw: DataFrame, place: str, checkpoint: str, once: bool, symbols: list[str]) -> None:
    """Reduce a raw JSON feed to keyed tick messages and publish them."""
    messages = pick_fields(raw)
    if symbols:
        key = messages["key"].cast("string").alias("code")
        messages = only_symbols(messages.select("key", "value", key), symbols).drop("code")
    fmt, where = place.split(":", 1)
    if fmt == "kafka":
        writer = write_messages(messages, fmt, options=kafka_sink_options(*where.rsplit("/", 1)))
    else:
        writer = write_messages(messages, fmt, where)
    writer = writer.option("checkpointLocation", checkpoint)
    drain((writer.trigger(availableNow=True) if once else writer).start())


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tickspan")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("ingest", "bars", "quarantine"):
        command = commands.add_parser(name)
        command.add_argument("--from", dest="source", required=True)
        command.add_argument("--starting", default="latest")
        command.add_argument("--per-trigger", type=int, help="messages or files of a micro-batch")
        command.add_argument("--checkpoint", required=True)
        command.add_argument("--once", action="store_true")
        if name != "bars":
            command.add_argument("--to", required=True)
        if name == "ingest":
            command.add_argument("--symbols", nargs="*", default=[])
        if name == "bars":
            command.add_argument("--precision", choices=["millis", "second"], default="millis")
            command.add_argument("--store", required=True)
            command.add_argument("--epoch", type=int)
            command.add_argument("--width", default="1 minute")
            command.add_argument("--lateness", default="10 seconds")
            command.add_argument("--every")
            command.add_argument("--state-partitions", type=int)
            command.add_argument("--files-per-day", type=int)
            command.add_argument("--rejects", help="folder for ticks that no bar holds")
    command = commands.add_parser("close-days")
    command.add_argument("--store", required=True)
    command.add_argument("--until", type=date.fromisoformat, required=True)
    command = commands.add_parser("thresholds")
    command.add_argument("--store", required=True)
    command.add_argument("--as-of", type=datetime.fromisoformat)
    command.add_argument("--from-days", action="store_true", help="merge daily parts")
    command = commands.add_parser("alerts")
    command.add_argument("--store", required=True)
    command.add_argument("--to", required=True)
    command.add_argument("--checkpoint", required=True)
    command.add_argument("--once", action="store_true")
    command.add_argument("--every")
    command = commands.add_parser("open-bars")
    command.add_argument("--checkpoint", required=True)
    command.add_argument("--to", required=True)
    command = commands.add_parser("panel")
    command.add_argument("--store", required=True)
    command.add_argument("name", choices=sorted(PANELS))
    command.add_argument("--since", type=datetime.fromisoformat)
    command.add_argument("--until", type=datetime.fromisoformat)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"tickspan-{args.command}").getOrCreate())
    if args.command == "thresholds":
        update = update_thresholds_from_days if args.from_days else update_thresholds
        update(spark, Store(args.store), args.as_of)
        return
    if args.command == "alerts":
        place = (args.to, args.checkpoint)
        drain(start_alert_feed(spark, Store(args.store), *place, once=args.once, every=args.every))
        return
    if args.command == "open-bars":
        open_bars(spark, args.checkpoint).write.mode("overwrite").parquet(args.to)
        return
    if args.command == "panel":
        panel(spark, Store(args.store), args.name, args.since, args.until).show(1000, False)
        return
    if args.command == "close-days":
        store = Store(args.store)
        for table in (store.ohlcv, store.anomaly_log, store.alerts):
            table.close_days(spark, args.until)
        return
    raw = source(spark, args.source, args.starting, args.per_trigger)
    if args.command == "ingest":
        ingest(raw, args.to, args.checkpoint, args.once, args.symbols)
        return
    if args.command == "quarantine":
        drain(start_quarantine(parse_ticks(raw), args.to, args.checkpoint, args.once))
        return
    ticks = parse_ticks(raw, args.precision)
    rejects = None
    if args.rejects:
        place = f"{args.checkpoint}-rejects"
        rejects = start_quarantine(ticks, args.rejects, place, args.once, strict=False)
    query = start_bars(
        spark,
        ticks,
        Store(args.store),
        args.checkpoint,
        epoch=args.epoch,
        width=args.width,
        lateness=args.lateness,
        files_per_day=args.files_per_day,
        once=args.once,
        every=args.every,
        state_partitions=args.state_partitions,
    )
    drain(query)
    if rejects is not None:
        drain(rejects)
