"""Bars, as-of lookups, thresholds and detection against small or brute-force results."""

import bisect
import random
from datetime import timedelta

import pytest
from helpers import START, at, bar, bars_frame, tick
from pyspark.sql import functions as F

from tickspan.operators import (
    aggregate_ohlcv,
    asof_join,
    bars_of,
    detect,
    duplicate_keys,
    latest_bars,
    previous_close,
    recompute_thresholds,
    valid_ticks,
    with_threshold,
)
from tickspan.operators.quality import quarantined_ticks
from tickspan.schemas import THRESHOLD
from tickspan.sources import only_symbols, parse_ticks, pick_fields


def ticks_of(spark, lines, precision="millis"):
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    return parse_ticks(raw, precision)


def test_bar_values(spark):
    rows = [tick("A", 100.0, 10), tick("A", 130.0, 20), tick("A", 90.0, 59.5), tick("A", 7.0, 60)]
    first, second = bars_of(ticks_of(spark, rows)).orderBy("window_start").collect()
    assert (first.open, first.high, first.low, first.close) == (100.0, 130.0, 90.0, 90.0)
    assert (first.volume, first.trade_count) == (3.0, 3)
    assert (first.window_start, first.window_end) == (START, at(60))
    assert (second.open, second.trade_count) == (7.0, 1)


def test_bars_nest_the_window(spark):
    found = aggregate_ohlcv(ticks_of(spark, [tick("A", 1.0, 0)]))
    assert found.columns[:2] == ["window", "code"]


def test_a_missing_price_opens_and_closes_no_bar(spark):
    rows = [tick("A", None, 1), tick("A", 5.0, 2), tick("A", 6.0, 3), tick("A", None, 4)]
    found = bars_of(ticks_of(spark, rows)).first()
    assert (found.open, found.close, found.trade_count, found.volume) == (5.0, 6.0, 2, 4.0)


def test_tie_break_orders_equal_times(spark):
    rows = [("A", 5.0, 1.0, at(1), 30), ("A", 6.0, 1.0, at(1), 10), ("A", 7.0, 1.0, at(1), 20)]
    schema = (
        "code string, trade_price double, trade_volume double, event_time timestamp, id long"
    )
    found = bars_of(spark.createDataFrame(rows, schema), tie_break="id").first()
    assert (found.open, found.close) == (6.0, 5.0)


def test_tie_break_takes_the_largest_long(spark):
    top = 2**63 - 1
    rows = [("A", 5.0, 1.0, at(1), top), ("A", 6.0, 1.0, at(1), top - 1), ("A", 7.0, 1.0, at(2), 0)]
    schema = (
        "code string, trade_price double, trade_volume double, event_time timestamp, id long"
    )
    found = bars_of(spark.createDataFrame(rows, schema), tie_break="id").first()
    assert (found.open, found.close) == (6.0, 7.0)


def test_second_precision_cuts_the_fraction(spark):
    found = ticks_of(spark, [tick("A", 1.0, 7.999)], "second").first()
    assert found.event_time == at(7)


def test_malformed_values(spark):
    rows = ["not json", '{"coin":"BTC","price":1}', None, '{"code":"A","trade_price":"x"}']
    found = ticks_of(spark, rows).collect()
    assert [r.code for r in found] == [None, None, None, "A"]
    assert found[3].trade_price is None


def test_missing_fields_are_published_as_null(spark):
    raw = spark.createDataFrame([('{"code":"A","extra":1}',)], "value string")
    found = pick_fields(raw).first()
    assert found.key == bytearray(b"A")
    assert bytes(found.value).decode() == (
        '{"code":"A","trade_price":null,"trade_volume":null,"timestamp":null,"ask_bid":null}'
    )


def test_quarantine_and_valid_ticks_split_the_input(spark):
    rows = [
        tick("A", 1.0, 1),
        tick(None, 1.0, 1),
        tick("A" * 21, 1.0, 1),
        tick("A" * 20, 1.0, 1),
        tick("A", 1.0, None),
        tick("A", None, 1),
        tick("A", 1.0, 1, None),
        "junk",
    ]
    ticks = ticks_of(spark, rows)
    assert valid_ticks(ticks).count() == 2
    defects = sorted(r.defect for r in quarantined_ticks(ticks).collect())
    assert defects == [
        "code missing",
        "code missing",
        "code too long",
        "price missing",
        "time missing",
        "volume missing",
    ]


def test_only_symbols_by_list_and_table(spark):
    ticks = ticks_of(spark, [tick(c, 1.0, 1) for c in ("KRW-BTC", "A", "KRW-ADA")])
    assert only_symbols(ticks).count() == 2
    table = spark.createDataFrame([("A",)], "code string")
    assert [r.code for r in only_symbols(ticks, table).collect()] == ["A"]


def test_previous_close_skips_gaps_and_excludes_equality(spark):
    bars = bars_frame(spark, [bar("A", 0, 10.0), bar("A", 1, 11.0), bar("A", 5, 12.0)])
    found = previous_close(bars).orderBy("window_start").collect()
    assert [r.prev_close for r in found] == [None, 10.0, 11.0]


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
def test_previous_close_matches_brute_force_with_a_hot_code(spark, bucket):
    rng = random.Random(7)
    rows = []
    for code in ["hot", *(f"c{i}" for i in range(12))]:
        n = 600 if code == "hot" else rng.randint(1, 40)
        for minute in rng.sample(range(0, 9000), n):
            rows.append(bar(code, minute, rng.random()))
    expected = {}
    for code in {r[0] for r in rows}:
        before = None
        for r in sorted((r for r in rows if r[0] == code), key=lambda r: r[1]):
            expected[r[0], r[1]] = before
            before = r[6]
    found = previous_close(bars_frame(spark, rows), bucket).collect()
    assert {(r.code, r.window_start): r.prev_close for r in found} == expected
    assert len(found) == len(rows)


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("bucket", ["minute", "hour", "month"])
def test_asof_join_matches_brute_force(spark, strict, bucket):
    rng = random.Random(11)
    codes = ["hot", "a", "b", "left only", None]
    right = {}
    for code in codes[:3] + [None]:
        for s in rng.sample(range(0, 40000), 60):
            right.setdefault(code, {})[s] = rng.random()
    left = []
    for i in range(400):
        code = "hot" if i % 2 else rng.choice(codes)
        # Every third probe hits a right time exactly.
        s = rng.choice(list(right["hot"])) if i % 3 == 0 else rng.randint(-50, 50000)
        left.append((i, code, at(s)))
    builds = [(c, at(s), v, -v) for c, d in right.items() for s, v in d.items()]
    found = asof_join(
        spark.createDataFrame(left, "id long, code string, t timestamp"),
        spark.createDataFrame(builds, "code string, at timestamp, v double, w double"),
        ["code"],
        "t",
        "at",
        ["v", "w"],
        strict=strict,
        bucket=bucket,
    ).collect()
    assert len(found) == len(left)
    for r in found:
        times = sorted(right.get(r.code, {})) if r.code is not None else []
        second = (r.t - START).total_seconds()
        side = bisect.bisect_left if strict else bisect.bisect_right
        i = side(times, second)
        want = right[r.code][times[i - 1]] if i else None
        assert (r.v, r.w) == (want, None if want is None else -want)


def test_asof_join_keeps_a_null_value_of_the_latest_row(spark):
    left = spark.createDataFrame([("A", at(7200)), ("A", at(20))], "code string, t timestamp")
    right = spark.createDataFrame(
        [("A", at(1), 1.0), ("A", at(10), None)], "code string, at timestamp, v double"
    )
    found = asof_join(left, right, ["code"], "t", "at", ["v"]).collect()
    assert [r.v for r in found] == [None, None]


def threshold_rows(spark, closes, as_of=None):
    bars = bars_frame(spark, [bar("A", i, c) for i, c in enumerate(closes)])
    found = recompute_thresholds(bars, as_of or (START + timedelta(days=1)).isoformat(sep=" "))
    return found.collect()


def test_threshold_is_mean_plus_three_deviations(spark):
    (row,) = threshold_rows(spark, [100.0, 110.0, 99.0])
    assert row.avg_change == pytest.approx(10.0)
    assert row.std_change == pytest.approx(0.0, abs=1e-9)
    assert row.threshold == pytest.approx(10.0)


def test_single_change_gives_the_default_threshold(spark):
    (row,) = threshold_rows(spark, [100.0, 110.0])
    assert (row.std_change, row.threshold) == (None, 3.0)


def test_single_bar_gives_no_threshold(spark):
    assert threshold_rows(spark, [100.0]) == []


def test_change_after_a_zero_close_is_left_out(spark):
    (row,) = threshold_rows(spark, [100.0, 0.0, 50.0, 60.0])
    assert row.avg_change == pytest.approx((100 + 20) / 2)


def test_horizon_is_cut_before_the_lag(spark):
    rows = [bar("A", 0, 1.0), bar("A", 10, 100.0), bar("A", 11, 110.0), bar("A", 12, 99.0)]
    as_of = START + timedelta(days=7, minutes=5)
    (row,) = recompute_thresholds(bars_frame(spark, rows), str(as_of)).collect()
    assert row.avg_change == pytest.approx(10.0)


def test_threshold_lookup(spark):
    known = spark.createDataFrame([("A", 2.5, 1.0, 0.5, START), ("B", 9.0, 1.0, 1.0, START)], THRESHOLD)
    bars = bars_frame(spark, [bar("A", 0, 1.0), bar("C", 0, 1.0)])
    found = {r.code: r.threshold for r in with_threshold(bars, known).collect()}
    assert found == {"A": 2.5, "C": 3.0}


def test_constant_price_flags_every_bar_with_a_predecessor(spark):
    bars = bars_frame(spark, [bar("A", i, 5.0) for i in range(4)])
    found = detect(bars, recompute_thresholds(bars, str(START + timedelta(days=1))))
    assert sorted(r.window_start for r in found.collect()) == [at(60), at(120), at(180)]


def test_zero_close_makes_the_next_change_zero(spark):
    bars = bars_frame(spark, [bar("A", 0, 5.0), bar("A", 1, 0.0), bar("A", 2, 50.0)])
    none = spark.createDataFrame([], THRESHOLD)
    found = detect(bars, none).collect()
    assert [(r.window_start, r.change_rate) for r in found] == [(at(60), -100.0)]


def test_latest_bars_and_duplicate_keys(spark):
    bars = bars_frame(spark, [bar("A", 0, 1.0), bar("A", 9, 2.0), bar("B", 3, 3.0)])
    assert {(r.code, r.close) for r in latest_bars(bars).collect()} == {("A", 2.0), ("B", 3.0)}
    twice = bars.unionByName(bars.filter("code = 'B'"))
    found = duplicate_keys(twice, ["code", "window_start"]).collect()
    assert [(r.code, r.n_rows) for r in found] == [("B", 2)]


def test_bars_do_not_depend_on_input_order(spark):
    rng = random.Random(3)
    rows = [tick(rng.choice("AB"), float(i), i * 7) for i in range(60)]
    one = bars_of(ticks_of(spark, rows)).orderBy("code", "window_start").collect()
    rng.shuffle(rows)
    frame = ticks_of(spark, rows).repartition(5, F.rand(1))
    assert bars_of(frame).orderBy("code", "window_start").collect() == one
