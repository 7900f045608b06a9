"""Reports over stored tables: newest detections, SQL views, hours of closed days."""

import glob
import random
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from helpers import START, at, bar, bars_frame
from pyspark.sql import functions as F

from tickspan.operators import keyed_table
from tickspan.plans import detection
from tickspan.plans.detection import apply_bars, store_bars
from tickspan.plans.reports import create_views, newest_anomalies, panel, stored_anomalies, stored_series
from tickspan.plans.store import Store
from tickspan.plans.thresholds import update_thresholds


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path / "store"))


def put(spark, store, batch, rows, seen):
    apply_bars(
        spark, store, bars_frame(spark, rows), 1, batch, detected_at=F.lit(seen).cast("timestamp")
    )


def keys(df):
    return [(r["code"], r["window_start"], r["detected_at"], r["close"]) for r in df.collect()]


def whole_log(spark, store, n):
    return keys(newest_anomalies(store.anomaly_log.current(spark), n))


def test_newest_detections_are_those_of_the_whole_log(spark, store, monkeypatch):
    """Batches of random bars, some repeated, some late, with stamps that tie and go back."""
    monkeypatch.setattr(detection, "KEPT_DETECTIONS", 7)
    monkeypatch.setattr("tickspan.plans.reports.KEPT_DETECTIONS", 7)
    rng = random.Random(4)
    batches = []
    for number in range(9):
        rows = {(c, m): bar(c, m, rng.choice([10.0, 20.0, 40.0])) for c in "ABC"
                for m in rng.sample(range(6 * number, 6 * number + 9), 2)}
        batches.append((number, list(rows.values()), at(100 * (number // 2))))
    for number, rows, seen in [*batches[:5], batches[4], batches[2], *batches[5:], batches[8]]:
        put(spark, store, number, rows, seen)
        for n in (1, 5, 7):
            assert keys(stored_anomalies(spark, store, n)) == whole_log(spark, store, n)
    assert len(whole_log(spark, store, 50)) > 10
    assert keys(stored_anomalies(spark, store, 50)) == whole_log(spark, store, 50)
    assert store.newest.newest(spark)[1].count() == 7


def test_ties_at_the_edge(spark, store):
    """Seventy bars detected in one batch, sixty in the next at the same time."""
    first = [bar("A", m, 10.0 * (1 + m % 2)) for m in range(71)]
    second = [bar("B", m, 10.0 * (1 + m % 2)) for m in range(61)]
    put(spark, store, 0, first, at(0))
    put(spark, store, 1, second, at(0))
    found = keys(stored_anomalies(spark, store))
    assert len(found) == 50 and found == whole_log(spark, store, 50)
    assert found[0][:2] == ("A", at(70 * 60)) and {k[0] for k in found} == {"A", "B"}


def test_files_read_stay_constant_as_the_log_grows(spark, store):
    """Each day one batch with detections; the report opens the days of its bars only."""
    opened = []
    for day in range(12):
        rows = [bar("A", 1440 * day + m, 10.0 * (1 + m % 2)) for m in range(40)]
        put(spark, store, day, rows, at(86400 * day))
        found = stored_anomalies(spark, store, 20)
        assert [k[1] for k in keys(found)] == [at(86400 * day + 60 * m) for m in range(39, 19, -1)]
        opened.append(len(found.inputFiles()))
    assert opened[3:] == [opened[3]] * 9


def test_a_store_from_before_makes_its_list_from_the_log(spark, store, monkeypatch):
    monkeypatch.setattr(detection, "keep_detections", lambda *_: None)
    put(spark, store, 0, [bar("A", 0, 1.0), bar("A", 1, 2.0)], at(0))
    assert len(keys(stored_anomalies(spark, store))) == 1
    monkeypatch.undo()
    put(spark, store, 1, [bar("A", 2, 4.0)], at(60))
    assert [k[1] for k in keys(stored_anomalies(spark, store))] == [at(120), at(60)]


def test_an_empty_store(spark, store):
    assert stored_anomalies(spark, store).count() == 0
    for name in ("anomalies", "thresholds", "bars", "log"):
        assert panel(spark, store, name).count() == 0
    assert panel(spark, store, "close", START, at(60)).count() == 0


def test_views_hold_the_tables_and_cut_days(spark, store):
    bars = [bar(c, 60 * h, 10.0 + h % 3) for c in "AB" for h in range(24 * 5)]
    store_bars(store, bars_frame(spark, bars), 1, 0, remember=False)
    update_thresholds(spark, store, START + timedelta(days=5))
    assert set(create_views(spark, store)) == {
        "ohlcv", "anomaly_log", "alerts", "anomaly_threshold", "newest_anomalies",
    }
    assert spark.sql("SELECT count(*) FROM ohlcv").first()[0] == 240
    assert spark.sql("SELECT max(close) FROM ohlcv WHERE code = :c", args={"c": "A"}).first()[0] == 12.0
    assert spark.sql("SELECT count(*) FROM anomaly_threshold").first()[0] == 2
    since, until = START + timedelta(days=2, hours=3), START + timedelta(days=2, hours=7)
    found = panel(spark, store, "close", since, until)
    assert [r["time"] for r in found.collect()][::2] == [since + timedelta(hours=h) for h in range(5)]
    opened = found.inputFiles()
    assert opened and all("dt=2024-01-03" in f for f in opened)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(window_start" in plan


def test_an_hour_of_a_closed_day_is_a_small_share_of_its_row_groups(spark, store, monkeypatch):
    monkeypatch.setattr(keyed_table, "GROUP_BYTES", 1 << 17)
    minutes = spark.range(60 * 1440).select(
        F.concat(F.lit("code-"), F.col("id") % 60).alias("code"),
        F.timestamp_seconds(F.lit(1704067200) + 60 * F.floor(F.col("id") / 60)).alias("window_start"),
    )
    value = F.xxhash64("code", "window_start").cast("double")
    bars = minutes.select(
        "code",
        "window_start",
        (F.col("window_start") + F.expr("interval 1 minute")).alias("window_end"),
        *(value.alias(c) for c in ("open", "high", "low", "close", "volume")),
        F.lit(1).cast("long").alias("trade_count"),
    ).repartition(4)
    store_bars(store, bars, 1, 0, remember=False)
    store_bars(store, bars_frame(spark, [bar("x", 3 * 1440, 1.0)]), 1, 1, remember=False)
    store.ohlcv.close_days(spark, date(2024, 1, 1))
    since, until = datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 10)
    groups = held = 0
    for path in glob.glob(f"{store.ohlcv.path}-merged/cut=1/dt=2024-01-01/*.parquet"):
        described = pq.ParquetFile(path).metadata
        column = described.schema.to_arrow_schema().get_field_index("window_start")
        for i in range(described.num_row_groups):
            seen = described.row_group(i).column(column).statistics
            groups += 1
            held += seen.min.replace(tzinfo=None) <= until and seen.max.replace(tzinfo=None) >= since
    assert groups >= 20 and held <= groups / 6
    found = stored_series(spark, store, "close", since, until)
    assert found.count() == 60 * 61
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(window_start" in plan
