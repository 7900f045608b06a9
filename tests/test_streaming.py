"""Streaming jobs over small files, one file per micro-batch."""

import os
import random
import subprocess
import sys

import pytest
from helpers import START, at, tick, write_files
from pyspark.sql import functions as F

from tickspan.operators import bars_of, previous_close
from tickspan.plans.store import Store
from tickspan.schemas import THRESHOLD
from tickspan.sources import parse_ticks, read_messages, stream_messages, write_messages
from tickspan.streaming import (
    Tally,
    claim_epoch,
    drain,
    final_bars,
    flush_tick,
    priced_bars,
    print_messages,
    start_bars,
    start_final_bars,
    start_priced_bars,
    start_quarantine,
)
from tickspan.streaming.previous import price_batch

FIVE_FILES = [
    [tick("A", 100.0, 10), tick("A", 105.0, 30)],
    [tick("A", 98.0, 50), tick("A", 101.0, 65)],
    [tick("A", 200.0, 20), tick("A", 110.0, 125)],
    [tick("A", 999.0, 30), tick("A", 111.0, 130)],
    [tick("A", 112.0, 300)],
]


@pytest.fixture
def place(tmp_path):
    class Place:
        files = str(tmp_path / "files")
        checkpoint = str(tmp_path / "checkpoint")
        out = str(tmp_path / "out")
        store = Store(str(tmp_path / "store"))

    return Place


def feed(spark, place, parse=True):
    raw = stream_messages(spark, "text", place.files, {"maxFilesPerTrigger": "1"})
    return parse_ticks(raw) if parse else raw


def run(spark, place, **options):
    return drain(
        start_bars(spark, feed(spark, place), place.store, place.checkpoint, once=True, **options)
    )


def emitted(spark, store):
    rows = store.ohlcv.versions(spark).orderBy("batch", "window_start").collect()
    return [
        (r.batch, int((r.window_start - START).total_seconds() // 60), r.open, r.close, r.trade_count)
        for r in rows
    ]


def test_update_mode_emits_every_touched_bar(spark, place):
    write_files(place.files, FIVE_FILES)
    run(spark, place)
    assert emitted(spark, place.store) == [
        (0, 0, 100.0, 105.0, 2),
        (1, 0, 100.0, 98.0, 3),
        (1, 1, 101.0, 101.0, 1),
        (2, 0, 100.0, 98.0, 4),
        (2, 2, 110.0, 110.0, 1),
        (3, 0, 100.0, 98.0, 5),
        (3, 2, 110.0, 111.0, 2),
        (4, 5, 112.0, 112.0, 1),
    ]
    current = place.store.ohlcv.current(spark).orderBy("window_start").collect()
    assert [(r.open, r.close, r.trade_count) for r in current] == [
        (100.0, 98.0, 5),
        (101.0, 101.0, 1),
        (110.0, 111.0, 2),
        (112.0, 112.0, 1),
    ]


def test_append_mode_emits_closed_bars_with_the_carried_previous_close(spark, place):
    write_files(place.files, FIVE_FILES)
    drain(start_priced_bars(final_bars(feed(spark, place)), place.out, place.checkpoint, once=True))
    found = priced_bars(spark, place.out).orderBy("window_start").collect()
    assert [(r.open, r.close, r.trade_count, r.prev_close) for r in found] == [
        (100.0, 98.0, 5, None),
        (101.0, 101.0, 1, 98.0),
        (110.0, 111.0, 2, 101.0),
    ]


def test_a_backfill_of_a_hot_code_is_priced_by_days(spark, place):
    """One batch closes 20,000 bars of one code; no task sorts them all."""
    minutes = 20_000
    bars = spark.range(minutes).select(
        F.lit("A").alias("code"),
        F.timestamp_seconds(F.col("id") * 60 + 1704067200).alias("window_start"),
        F.timestamp_seconds(F.col("id") * 60 + 1704067260).alias("window_end"),
        *(F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")),
        F.lit(1).cast("long").alias("trade_count"),
    )
    half = F.col("close") < minutes // 2
    price_batch(spark, place.out, bars.filter(half), 0)
    for _ in range(2):  # a replay changes nothing
        price_batch(spark, place.out, bars.filter(~half), 1)
    found = priced_bars(spark, place.out)
    assert found.count() == minutes
    assert found.filter("prev_close IS NULL").count() == 1
    assert found.filter("prev_close <> close - 1").count() == 0


def test_a_late_tick_flushes_the_open_bars(spark, place):
    write_files(place.files, FIVE_FILES[:2])
    schema = feed(spark, place).schema
    ticks = parse_ticks(read_messages(spark, "text", place.files))
    for part in (ticks, flush_tick(spark, schema, at(3600))):
        part.select(*schema.fieldNames()).write.mode("append").parquet(place.out)
        rows = spark.readStream.schema(schema).parquet(place.out)
        drain(start_final_bars(final_bars(rows), place.out + "-bars", place.checkpoint, once=True))
    found = spark.read.parquet(place.out + "-bars").orderBy("window_start").collect()
    assert [(r.code, r.close, r.trade_count) for r in found] == [("A", 98.0, 3), ("A", 101.0, 1)]


def test_streams_and_batches_make_the_same_bars_of_faulty_ticks(spark, place):
    """Ticks without a volume or price, and with a long code, are in the bars of both."""
    lines = [tick("A", 100.0, 1), tick("A", 200.0, 2, volume=None), tick("A", None, 3, volume=5.0),
             tick("a-code-of-over-twenty-characters", 7.0, 4), tick(None, 1.0, 5)]
    write_files(place.files, [lines])
    run(spark, place)
    ticks = parse_ticks(read_messages(spark, "text", place.files))
    stored = place.store.ohlcv.current(spark).drop("created_at")
    assert sorted(stored.collect()) == sorted(bars_of(ticks).collect())
    (row,) = stored.filter("code = 'A'").collect()
    assert (row.high, row.volume, row.trade_count) == (200.0, 6.0, 2)


def test_late_rows_null_codes_and_null_times(spark, place):
    write_files(
        place.files,
        [
            [tick("A", 100.0, 10), tick(None, 5.0, 20), tick("Z", 5.0, None)],
            [tick("A", 101.0, 125)],
            [tick("A", 102.0, 130), tick("A", 7.0, 20)],
            [tick("A", 103.0, 140), tick("A", 8.0, 25)],
        ],
    )
    tally = Tally()
    spark.streams.addListener(tally)
    query = run(spark, place)
    tally.wait(query)
    spark.streams.removeListener(tally)
    current = place.store.ohlcv.current(spark).orderBy("window_start").collect()
    assert [(r.code, r.open, r.close, r.low, r.trade_count) for r in current] == [
        ("A", 100.0, 7.0, 7.0, 2),
        ("A", 101.0, 103.0, 101.0, 3),
    ]
    assert tally.totals(query)["dropped"] == 1


def test_quarantine_keeps_what_bars_cannot_take(spark, place):
    write_files(place.files, [["not json", tick(None, 5.0, 20), tick("A", 1.0, 3)]])
    drain(start_quarantine(feed(spark, place), place.out, place.checkpoint, once=True))
    found = spark.read.parquet(place.out)
    assert [r.defect for r in found.collect()] == ["code missing"] * 2


def test_rejects_are_the_ticks_in_no_bar(spark, place):
    lines = ["not json", tick("A", 1.0, 3), tick("A", None, 3), tick("Z", 5.0, None)]
    write_files(place.files, [lines])
    query = start_quarantine(feed(spark, place), place.out, place.checkpoint, once=True, strict=False)
    drain(query)
    found = spark.read.parquet(place.out).collect()
    assert sorted(r.defect for r in found) == ["code missing", "time missing"]


def test_empty_input_writes_nothing(spark, place):
    write_files(place.files, [["not json"]])
    run(spark, place)
    assert place.store.ohlcv.current(spark).count() == 0


def random_walk(n=240):
    rng = random.Random(5)
    return [tick(rng.choice("AB"), round(50 + rng.random() * 50, 2), 4 * i) for i in range(n)]


def zero_thresholds(spark, store):
    rows = [(c, 0.0, 0.0, 0.0, START) for c in "AB"]
    store.anomaly_threshold.append(spark.createDataFrame(rows, THRESHOLD), 0, 0)


def test_stopped_and_restarted_equals_batch(spark, place):
    """Time-sorted files, stopped after two of four, equal the batch result in every table."""
    zero_thresholds(spark, place.store)
    lines = random_walk()
    parts = [lines[i : i + 60] for i in range(0, 240, 60)]
    write_files(place.files, parts[:2])
    run(spark, place)
    write_files(place.files, parts[2:], first=2)
    run(spark, place)

    ticks = parse_ticks(read_messages(spark, "text", place.files))
    bars = bars_of(ticks)
    stored = place.store.ohlcv.current(spark).drop("created_at")
    assert sorted(stored.collect()) == sorted(bars.collect())
    want = {
        (r.code, r.window_start): r.prev_close
        for r in previous_close(bars).filter(F.col("prev_close").isNotNull()).collect()
    }
    log = place.store.anomaly_log.current(spark).collect()
    assert {(r.code, r.window_start) for r in log} == set(want)
    assert place.store.alerts.versions(spark).count() == len(want)


def test_a_fresh_checkpoint_never_overwrites(spark, place, tmp_path):
    """It gets an epoch of its own, and may not take one that was written."""
    write_files(place.files, [[tick("A", 1.0, 1), tick("A", 1.0, 61)]])
    run(spark, place)
    write_files(place.files, [[tick("B", 2.0, 1), tick("A", 3.0, 1)]])
    first, place.checkpoint = place.checkpoint, str(tmp_path / "second")
    with pytest.raises(ValueError):
        run(spark, place, epoch=1)
    run(spark, place)
    found = place.store.ohlcv.current(spark).orderBy("code", "window_start").collect()
    assert [(r.code, r.close) for r in found] == [("A", 3.0), ("A", 1.0), ("B", 2.0)]
    assert place.store.ohlcv.last_epoch(spark) == 2
    assert claim_epoch(spark, place.store, first) == 1
    assert claim_epoch(spark, place.store, place.checkpoint, 2) == 2
    with pytest.raises(ValueError):
        claim_epoch(spark, place.store, first, 2)


def test_console_and_file_publishing(spark, place, tmp_path):
    write_files(place.files, [[tick("A", 1.5, 1)]])
    query = drain(print_messages(feed(spark, place, parse=False), place.checkpoint, once=True))
    assert "Console" in query.recentProgress[0].sink.description
    assert query.recentProgress[0].numInputRows == 1

    messages = read_messages(spark, "text", place.files)
    write_messages(messages, "parquet", place.out)
    assert read_messages(spark, "parquet", place.out).count() == 1
    again = stream_messages(spark, "parquet", place.out)
    writer = write_messages(again, "parquet", str(tmp_path / "copy"))
    drain(
        writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 1


PRINTING = """
import sys
from pyspark.sql import functions as F
from tickspan.session import local_session
from tickspan.streaming import drain, print_messages

place, spark = sys.argv[1], local_session(2, 2)
for number in (60_000, 21, 20):
    value = F.concat(F.lit("x" * 90), F.col("id").cast("string")).cast("binary")
    rows = spark.range(0, number, 1, 3 if number > 21 else 1)
    rows.select(F.lit(b"A").alias("key"), value.alias("value")).write.parquet(f"{place}/{number}")
    raw = spark.readStream.schema("key binary, value binary").parquet(f"{place}/{number}")
    query = drain(print_messages(raw, f"{place}/checkpoint-{number}", once=True))
    print("taken", sum(p.numInputRows for p in query.recentProgress), flush=True)
"""


def test_the_console_takes_only_what_it_shows_to_the_driver(tmp_path):
    """Some 6 MB of messages, of which the driver may be sent one: all read, the first 20 shown."""
    env = os.environ | {
        "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
        "PYSPARK_SUBMIT_ARGS": "--conf spark.driver.maxResultSize=1m pyspark-shell",
    }
    command = [sys.executable, "-c", PRINTING, str(tmp_path)]
    done = subprocess.run(command, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    large, larger_by_one, all_shown, rest = done.stdout.split("taken ")
    assert (larger_by_one[:6], all_shown[:3], rest.strip()) == ("60000\n", "21\n", "20")
    for shown in (large, larger_by_one, all_shown):
        assert shown.count("Batch: 0") == 1
        assert shown.count("|" + "x" * 90) == 20
        assert ("only showing top 20 rows" in shown) == (shown is not all_shown)


def test_bar_times_do_not_depend_on_the_batch_order(spark, place):
    """Ticks of one bar spread over batches in any order give the same open and close."""
    lines = [tick("A", float(s), s) for s in range(50)]
    random.Random(2).shuffle(lines)
    write_files(place.files, [lines[:20], lines[20:35], lines[35:]])
    run(spark, place)
    (row,) = place.store.ohlcv.current(spark).collect()
    assert (row.open, row.close, row.trade_count, row.window_start) == (0.0, 49.0, 50, at(0))
