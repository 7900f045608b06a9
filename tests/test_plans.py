"""The plans have the shape that scales: partial hash aggregation, pruning, no Python, no cross."""

import re
from datetime import timedelta

import pytest
from helpers import bar, bars_frame
from pyspark.sql import functions as F

from tickspan.catalog import BATCH
from tickspan.operators import bars_of, previous_close, valid_ticks
from tickspan.plans.detection import store_bars, with_recent_close
from tickspan.plans.store import Store
from tickspan.sources import load, only_symbols, parse_ticks, ticks_from_events

STORED = {
    "threshold_upsert",
    "threshold_empty_noop",
    "ohlcv_upsert_latest",
    "anomaly_log_upsert",
    "alert_new_only",
    "stored_close_series",
    "stored_top50",
    "stored_threshold_table",
    "ohlcv_after_compaction",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


@pytest.mark.parametrize("name", sorted(set(BATCH) - STORED))
def test_no_python_workers_and_no_cross_joins(spark, data, name):
    text = plan(BATCH[name](spark, data))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize("tie_break", [None, "event_id"])
def test_bars_use_partial_hash_aggregation(spark, data, tie_break):
    ticks = ticks_from_events(load(spark, data, "events"))
    text = plan(bars_of(ticks, "1 hour", tie_break))
    assert "SortAggregate" not in text
    assert text.count("HashAggregate") == 2
    assert text.count("Exchange hashpartitioning") == 1


def test_ticks_are_scanned_once_for_the_previous_close(spark, data):
    ticks = ticks_from_events(load(spark, data, "events"))
    bars = bars_of(ticks, "1 hour").select("code", "window_start", "close")
    text = final_plan(previous_close(bars))
    assert text.count("FileScan") == 1
    assert "ReusedExchange" in text


def test_no_window_runs_over_a_whole_code_of_bars(spark, data):
    ticks = ticks_from_events(load(spark, data, "events"))
    bars = bars_of(ticks, "1 hour").select("code", "window_start", "close")
    whole = [x for x in plan(previous_close(bars)).splitlines() if re.search(r"Window \[lag\(_last", x)]
    rest = [x for x in plan(previous_close(bars)).splitlines() if re.search(r"Window \[row_number", x)]
    assert whole and rest
    assert all("_bucket" in x for x in rest)


def test_time_and_symbol_filters_reach_the_scan(spark, data):
    ticks = ticks_from_events(load(spark, data, "events"), since="2024-01-24 00:00:00")
    text = plan(only_symbols(ticks, ["click", "view"]).select("code", "trade_price"))
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in text
    assert "In(event_type, [click,view])" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text


@pytest.mark.parametrize(
    "name", ["dashboard_close_series", "dashboard_volume_series", "time_range_last_hour"]
)
def test_a_report_range_reaches_the_scan(spark, data, name):
    text = plan(BATCH[name](spark, data))
    assert "GreaterThanOrEqual(ts,2024-01-" in text
    assert "LessThan(ts,2024-01-20T" in text


def test_thresholds_read_their_horizon_only(spark, data):
    text = plan(BATCH["anomaly_threshold_7d"](spark, data))
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in text
    assert "LessThan(ts,2024-01-31T01:00)" in text


def test_a_message_is_parsed_once(spark):
    raw = spark.range(1).selectExpr("cast(concat('{', id, '}') as binary) AS value")
    assert plan(bars_of(valid_ticks(parse_ticks(raw)))).count("from_json") == 1


def test_a_batch_reads_only_its_recent_days_and_columns(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    rows = [bar("A", 1440 * d, float(d)) for d in range(5)]
    store_bars(store, bars_frame(spark, rows), 1, 0)
    found = store_bars(store, bars_frame(spark, [bar("A", 1440 * 4 + 1, 9.0)]), 1, 1)
    start = found[0] - timedelta(hours=1)
    stored = store.ohlcv.versions(spark, start.date(), found[1].date())
    recent = with_recent_close(stored.filter(F.col("window_start") >= start), store, 1, 1)
    assert [r.prev_close for r in recent.collect()] == [4.0]
    text = plan(recent)
    assert "GreaterThanOrEqual(window_start" in text
    assert "ReadSchema: struct<code:string,window_start:timestamp,close:double>" in text
    assert len(stored.inputFiles()) == 3  # of six: one on the day of `start`, two on the last


def test_the_current_view_is_a_hash_aggregation(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    store_bars(store, bars_frame(spark, [bar("A", 0, 1.0)]), 1, 0)
    assert "SortAggregate" not in plan(store.ohlcv.current(spark))


def test_top_fifty_needs_no_global_sort(spark, data):
    assert "TakeOrderedAndProject" in plan(BATCH["dashboard_anomaly_top50"](spark, data))
