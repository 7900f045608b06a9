"""Alerts read as a stream, counts over many micro-batches, paced input."""

from datetime import datetime

import pytest
from helpers import START, bar, bars_frame, tick, write_files
from pyspark.sql import functions as F

from tickspan.catalog.streams import PACE, paced
from tickspan.plans.detection import apply_bars
from tickspan.plans.store import Store
from tickspan.schemas import ALERT
from tickspan.sources import file_source_options, kafka_source_options, parse_ticks, stream_messages
from tickspan.streaming import (
    Tally,
    counted,
    drain,
    final_bars,
    start_alert_feed,
    start_final_bars,
    tallied,
)


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path / "store"))


def put(spark, store, batch, rows):
    apply_bars(spark, store, bars_frame(spark, rows), 1, batch)


def read_feed(spark, store, tmp_path):
    drain(
        start_alert_feed(
            spark, store, str(tmp_path / "out"), str(tmp_path / "cp"), once=True, state_partitions=1
        )
    )
    rows = spark.read.schema(ALERT).parquet(str(tmp_path / "out")).collect()
    return sorted((r.code, int((r.window_start - START).total_seconds() // 60)) for r in rows)


def test_each_alert_comes_once_after_replays_and_restarts(spark, store, tmp_path):
    assert read_feed(spark, store, tmp_path) == []  # nothing was written yet
    first = [bar("A", 0, 100.0), bar("A", 1, 110.0), bar("B", 0, 10.0)]
    put(spark, store, 0, first)
    assert read_feed(spark, store, tmp_path) == [("A", 1)]
    put(spark, store, 0, first)  # writes its files anew
    assert read_feed(spark, store, tmp_path) == [("A", 1)]
    second = [bar("A", 1, 120.0), bar("B", 5, 20.0), bar("A", -60 * 24 * 30, 50.0)]
    put(spark, store, 1, second)
    put(spark, store, 1, second)
    found = read_feed(spark, store, tmp_path)
    assert found == [("A", 1), ("B", 5)]
    put(spark, store, 2, [bar("A", -60 * 24 * 29, 75.0)])  # an alert for a bar of a month ago
    assert read_feed(spark, store, tmp_path) == [("A", -60 * 24 * 29), ("A", 1), ("B", 5)]


def test_late_ticks_are_counted_over_more_batches_than_a_query_remembers(spark, tmp_path):
    """A late tick in every file but the first two, 115 files, one per micro-batch."""
    n = 115
    files = [[tick("A", 1.0, 600), tick("A", 1.0, 601)], [tick("A", 1.0, 700)]]
    files += [[tick("A", 1.0, 700 + i), tick("A", 2.0, 5), tick("A", None, 6)] for i in range(1, n - 1)]
    write_files(str(tmp_path / "files"), files)
    raw = stream_messages(spark, "text", str(tmp_path / "files"), file_source_options(1))
    tally = Tally()
    spark.streams.addListener(tally)
    try:
        bars = final_bars(counted(parse_ticks(raw)))
        out, place = str(tmp_path / "out"), str(tmp_path / "tally")
        query = start_final_bars(bars, out, str(tmp_path / "cp"), once=True, state_partitions=1)
        drain(query)
        tally.wait(query)
    finally:
        spark.streams.removeListener(tally)
    assert len(query.recentProgress) <= 100
    totals = tally.totals(query)
    assert totals["batches"] >= n
    assert totals["rows"] == sum(map(len, files))
    assert totals["ticks"] == 3 + 2 * (n - 2)  # ticks without a price are in no count
    assert totals["dropped"] == n - 2  # a partial bar in each file
    for _ in range(2):  # writing again replaces the run's row
        tally.write(spark, place)
    (row,) = tallied(spark, place).collect()
    assert (row["query"], row["runs"], row["dropped"]) == (str(query.id), 1, n - 2)


def test_an_empty_tally(spark, tmp_path):
    Tally().write(spark, str(tmp_path / "tally"))
    assert tallied(spark, str(tmp_path / "tally")).count() == 0


def test_paced_input_makes_a_batch_per_file_at_its_time(spark, data):
    store, query = paced(spark, data)
    started = [
        datetime.fromisoformat(p.timestamp.rstrip("Z"))
        for p in query.recentProgress
        if p.numInputRows
    ]
    assert len(started) == 3
    gaps = [(b - a).total_seconds() for a, b in zip(started, started[1:])]
    assert min(gaps) > PACE - 0.1
    batches = store.ohlcv.versions(spark).agg(F.count_distinct("batch")).first()[0]
    assert batches == 3


def test_rate_limits_are_options_of_the_sources():
    assert file_source_options() == {}
    assert file_source_options(5) == {"maxFilesPerTrigger": "5"}
    assert kafka_source_options("a:1", "t", per_trigger=9)["maxOffsetsPerTrigger"] == "9"
    assert "maxOffsetsPerTrigger" not in kafka_source_options("a:1", "t")
