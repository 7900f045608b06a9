"""Previous closes in the state store, bars that are still open, bars made of finer bars."""

import random

import pytest
from helpers import START, at, tick, write_files
from pyspark.sql import functions as F

from tickspan.operators import bars_of, previous_close, wider_bars
from tickspan.sources import parse_ticks, read_messages, stream_messages
from tickspan.streaming import (
    drain,
    final_bars,
    final_wider_bars,
    open_bars,
    start_final_bars,
    start_quarantine,
    with_previous_close,
)
from tickspan.streaming.unfinished import bar_operator

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

    return Place


def feed(spark, place):
    return parse_ticks(stream_messages(spark, "text", place.files, {"maxFilesPerTrigger": "1"}))


def priced(spark, place):
    bars = with_previous_close(final_bars(feed(spark, place)))
    return drain(
        start_final_bars(bars, place.out, place.checkpoint, once=True, state_partitions=2)
    )


def found(spark, place):
    rows = spark.read.parquet(place.out).orderBy("code", "window_start").collect()
    minute = [int((r.window_start - START).total_seconds() // 60) for r in rows]
    return [(r.code, m, r.open, r.close, r.trade_count, r.prev_close) for m, r in zip(minute, rows)]


def test_state_gives_previous_closes_across_batches_and_a_restart(spark, place):
    write_files(place.files, FIVE_FILES[:3])
    priced(spark, place)
    assert found(spark, place) == [("A", 0, 100.0, 98.0, 4, None)]
    write_files(place.files, FIVE_FILES[3:], first=3)
    priced(spark, place)
    assert [r[1:] for r in found(spark, place)] == [
        (0, 100.0, 98.0, 4, None),
        (1, 101.0, 101.0, 1, 98.0),
        (2, 110.0, 111.0, 2, 101.0),
    ]


def test_a_hot_code_closes_many_bars_at_once(spark, place):
    """1,200 bars of one code close in one micro-batch, in any order, beside a calm code."""
    rng = random.Random(3)
    lines = [tick("HOT", 1000.0 + i, 60 * i + 5) for i in range(1200) if i % 7]
    lines += [tick("calm", 1.0, 60), tick("calm", None, 600), tick("calm", 3.0, 6000)]
    rng.shuffle(lines)
    write_files(place.files, [lines, [tick("HOT", 7.0, 80_000)], [tick("X", 1.0, 90_000)]])
    priced(spark, place)
    rows = spark.read.parquet(place.out)
    ticks = parse_ticks(read_messages(spark, "text", place.files))
    wanted = previous_close(bars_of(ticks)).filter("code <> 'X'")
    assert sorted(rows.collect()) == sorted(wanted.select(rows.columns).collect())
    hot = rows.filter("code = 'HOT'").orderBy("window_start").collect()
    assert len(hot) > 1000 and [r.prev_close for r in hot][1:] == [r.close for r in hot][:-1]
    calm = rows.filter("code = 'calm'").orderBy("window_start").collect()
    assert [r.prev_close for r in calm] == [None, 1.0, None]  # a bar without a price in between


def test_open_bars_are_what_append_mode_holds_back(spark, place):
    write_files(place.files, FIVE_FILES)
    bars = final_bars(feed(spark, place))
    drain(start_final_bars(bars, place.out, place.checkpoint, once=True, state_partitions=3))
    held = open_bars(spark, place.checkpoint)
    assert [(r.code, r.window_start, r.close) for r in held.collect()] == [("A", at(300), 112.0)]
    closed = spark.read.parquet(place.out)
    assert held.schema.fieldNames() == closed.schema.fieldNames()
    ticks = parse_ticks(read_messages(spark, "text", place.files))
    on_time = ticks.filter("trade_price <> 999.0")
    every = held.unionByName(closed)
    assert sorted(every.select("code", "window_start").collect()) == sorted(
        bars_of(on_time).select("code", "window_start").collect()
    )


def test_open_bars_of_an_earlier_batch_and_of_ties(spark, place):
    write_files(place.files, FIVE_FILES[:2])
    numbered = feed(spark, place).withColumn("n", F.col("timestamp"))
    bars = final_bars(numbered, tie_break="n")
    drain(start_final_bars(bars, place.out, place.checkpoint, once=True, state_partitions=1))
    at_first = open_bars(spark, place.checkpoint, batch=0).collect()
    assert [(r.open, r.close, r.volume, r.trade_count) for r in at_first] == [(100.0, 105.0, 2.0, 2)]
    now = open_bars(spark, place.checkpoint).orderBy("window_start").collect()
    assert [(r.open, r.close, r.trade_count) for r in now] == [(100.0, 98.0, 3), (101.0, 101.0, 1)]


def test_open_bars_beside_kept_closes(spark, place):
    """The state of previous closes lies in the same checkpoint; the bars are found all the same."""
    write_files(place.files, FIVE_FILES)
    priced(spark, place)
    assert [r.close for r in open_bars(spark, place.checkpoint).collect()] == [112.0]
    with pytest.raises(ValueError):
        open_bars(spark, place.checkpoint, operator=0).collect()


def test_a_checkpoint_without_bars_is_refused(spark, place):
    write_files(place.files, [["not json"]])
    drain(start_quarantine(feed(spark, place), place.out, place.checkpoint, once=True))
    with pytest.raises(Exception, match="state|makes bars"):
        bar_operator(spark, place.checkpoint)


def faulty_ticks():
    rng = random.Random(9)
    lines = []
    for i in range(900):
        price = None if rng.random() < 0.2 else round(50 + rng.random() * 50, 2)
        volume = None if rng.random() < 0.2 else float(rng.randrange(5))
        lines.append(tick(rng.choice("ABC"), price, 20 * i + rng.random() * 15, volume))
    lines += [tick("D", None, 30, 4.0), tick("E", 2.0, 90, None)]
    return lines


def test_wider_bars_are_those_of_the_ticks(spark, place):
    write_files(place.files, [faulty_ticks()])
    ticks = parse_ticks(read_messages(spark, "text", place.files))
    fine = bars_of(ticks)
    for width in ("5 minutes", "1 hour", "1 day"):
        assert sorted(map(str, wider_bars(fine, width).collect())) == sorted(
            map(str, bars_of(ticks, width).collect())
        )
    twice = wider_bars(wider_bars(fine, "15 minutes"), "1 hour")
    assert sorted(map(str, twice.collect())) == sorted(map(str, bars_of(ticks, "1 hour").collect()))


def test_wider_bars_on_a_stream_close_with_the_watermark(spark, place):
    lines = [line for line in faulty_ticks()[:900]]
    parts = [lines[i : i + 300] for i in range(0, 900, 300)]
    write_files(place.files, [*parts, [tick("Z", 1.0, 20_000)]])
    bars = final_wider_bars(feed(spark, place), "1 hour")
    drain(start_final_bars(bars, place.out, place.checkpoint, once=True, state_partitions=2))
    ticks = parse_ticks(read_messages(spark, "text", place.files)).filter("code <> 'Z'")
    closed = bars_of(ticks, "1 hour").filter(F.col("window_end") <= F.lit(at(19_990)))
    found = spark.read.parquet(place.out)
    assert sorted(map(str, found.select(closed.columns).collect())) == sorted(
        map(str, closed.collect())
    )
    assert found.count() == 15
