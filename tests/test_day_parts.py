"""Thresholds out of daily parts."""

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import START, bars_frame
from pyspark.sql import functions as F

from tickspan.operators import change_statistics, day_parts, merged_statistics
from tickspan.plans.detection import store_bars
from tickspan.plans.store import Store
from tickspan.plans.thresholds import (
    bars_of_days,
    summarise_days,
    update_thresholds,
    update_thresholds_from_days,
)


def bar_at(code, moment, close):
    return (code, moment, moment + timedelta(minutes=1), close, close, close, close, 1.0, 1)


def random_bars(codes="AB", days=10, seed=1, every=90):
    rng = random.Random(seed)
    rows = []
    for code in codes:
        for minute in range(0, days * 1440, every):
            if rng.random() < 0.8:
                close = rng.choice([0.0, None]) if rng.random() < 0.05 else 50 + 50 * rng.random()
                rows.append(bar_at(code, START + timedelta(minutes=minute), close))
    return rows


def same(one, other):
    one, other = (
        {r["code"]: tuple(r)[1:3] for r in df.select("code", "avg_change", "std_change").collect()}
        for df in (one, other)
    )
    assert set(one) == set(other) and one
    for code, values in one.items():
        assert values == pytest.approx(other[code], rel=1e-12, nan_ok=True) or (
            values[1] is None and other[code][1] is None and values[0] == pytest.approx(other[code][0])
        )


def test_parts_merge_to_the_statistics_of_all_bars(spark):
    bars = bars_frame(spark, random_bars()).repartition(4)
    same(merged_statistics(day_parts(bars)), change_statistics(bars))


def test_spans_may_be_cut_anywhere(spark):
    bars = bars_frame(spark, random_bars(seed=2))
    cut = F.lit(START + timedelta(days=4, hours=7, minutes=30))
    early, late = (day_parts(bars.filter(c)) for c in (F.col("window_start") < cut, F.col("window_start") >= cut))
    late = late.withColumn("day_start", F.greatest("day_start", cut))
    same(merged_statistics(early.unionByName(late)), change_statistics(bars))


def test_few_bars(spark):
    day = timedelta(days=1)
    rows = [
        bar_at("one", START, 5.0),  # no change
        bar_at("two", START, 100.0), bar_at("two", START + day, 110.0),  # one, across midnight
        bar_at("three", START, 100.0), bar_at("three", START + day, 110.0),
        bar_at("three", START + 2 * day, 99.0),
        bar_at("zero", START, 0.0), bar_at("zero", START + day, 3.0),  # unknown
        bar_at("gap", START, 100.0), bar_at("gap", START + 6 * day, 150.0),
    ]
    found = {r["code"]: tuple(r)[1:] for r in merged_statistics(day_parts(bars_frame(spark, rows))).collect()}
    assert found == {
        "two": (10.0, None),
        "three": (pytest.approx(10.0), pytest.approx(0.0, abs=1e-9)),
        "gap": (50.0, None),
    }
    assert merged_statistics(day_parts(bars_frame(spark, []))).count() == 0


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path / "store"))


def thresholds(spark, store):
    rows = store.anomaly_threshold.current(spark).collect()
    return {r["code"]: tuple(r)[1:] for r in rows}


def close_to(one, other):
    assert set(one) == set(other) and one
    for code, (threshold, avg, std, moment) in one.items():
        assert (threshold, avg, std) == pytest.approx(other[code][:3]) and moment == other[code][3]


@pytest.mark.parametrize("moment", [START + timedelta(days=9), START + timedelta(days=8, hours=13, minutes=37)])
def test_the_daily_job_equals_the_weekly_scan(spark, store, tmp_path, moment):
    bars = bars_frame(spark, random_bars(seed=3))
    other = Store(str(tmp_path / "other"))
    for s in (store, other):
        store_bars(s, bars, 1, 0, remember=False)
    update_thresholds_from_days(spark, store, moment)
    update_thresholds(spark, other, moment)
    close_to(thresholds(spark, store), thresholds(spark, other))


def test_a_new_day_reads_that_day_only(spark, store):
    bars = bars_frame(spark, random_bars(seed=4))
    until = lambda n: F.col("window_start") < F.lit(START + timedelta(days=n))
    store_bars(store, bars.filter(until(8)), 1, 0, remember=False)
    first = update_thresholds_from_days(spark, store, START + timedelta(days=8))
    assert first == [date(2024, 1, 2) + timedelta(days=n) for n in range(7)]
    store_bars(store, bars.filter(until(9) & ~until(8)), 1, 1, remember=False)
    assert update_thresholds_from_days(spark, store, START + timedelta(days=9)) == [date(2024, 1, 9)]
    files = bars_of_days(spark, store, [date(2024, 1, 9)]).inputFiles()
    assert files and all("dt=2024-01-09" in f for f in files)
    # the same call again reads nothing, and a late bar has its day read again
    assert update_thresholds_from_days(spark, store, START + timedelta(days=9)) == []
    late = bars_frame(spark, [bar_at("A", START + timedelta(days=5, seconds=30), 500.0)])
    store_bars(store, late, 1, 2, remember=False)
    assert update_thresholds_from_days(spark, store, START + timedelta(days=9)) == [date(2024, 1, 6)]
    again = thresholds(spark, store)
    update_thresholds(spark, store, START + timedelta(days=9))
    close_to(again, thresholds(spark, store))


def test_merged_days_are_not_read_again(spark, store):
    bars = bars_frame(spark, random_bars(seed=5))
    store_bars(store, bars, 1, 0, remember=False)
    assert summarise_days(spark, store, date(2024, 1, 1), date(2024, 1, 7))
    store_bars(store, bars_frame(spark, [bar_at("A", START + timedelta(days=8), 1.0)]), 1, 1, remember=False)
    store.ohlcv.close_days(spark, date(2024, 1, 7))
    assert summarise_days(spark, store, date(2024, 1, 1), date(2024, 1, 7)) == []


def test_no_bars_change_nothing(spark, store):
    assert update_thresholds_from_days(spark, store, datetime(2024, 1, 9)) == []
    assert thresholds(spark, store) == {}
    store_bars(store, bars_frame(spark, random_bars()), 1, 0, remember=False)
    update_thresholds_from_days(spark, store, datetime(2025, 1, 9, 3, 0))
    assert thresholds(spark, store) == {}
