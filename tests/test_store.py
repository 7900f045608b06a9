"""Keyed tables: upserts, replays, partition pruning, compaction; the jobs over them."""

import time
from datetime import date, datetime, timedelta, timezone

import pytest
from helpers import START, at, bar, bars_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickspan.operators import KeyedTable
from tickspan.plans.detection import apply_bars, store_bars
from tickspan.plans.reports import stored_series
from tickspan.plans.store import Store
from tickspan.plans.thresholds import update_thresholds
from tickspan.schemas import THRESHOLD
from tickspan.session import new_folder, shared_folder


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path / "store"))


def stamp(text):
    return F.lit(text).cast("timestamp")


def put(spark, store, batch, rows, **kw):
    apply_bars(spark, store, bars_frame(spark, rows), 1, batch, **kw)


def set_thresholds(spark, store, values):
    rows = [(c, t, None, None, START) for c, t in values.items()]
    store.anomaly_threshold.append(spark.createDataFrame(rows, THRESHOLD), 0, 0)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_empty_table_has_its_schema(spark, store):
    found = store.ohlcv.current(spark)
    assert found.columns == store.ohlcv.schema.fieldNames()
    assert found.count() == 0
    assert store.ohlcv.current(spark, date(2024, 1, 1), date(2024, 1, 2)).count() == 0
    assert store.ohlcv.last_epoch(spark) == 0


def test_upsert_replaces_values_and_keeps_created_at(spark, store):
    store_bars(store, bars_frame(spark, [bar("A", 0, 1.0), bar("B", 0, 5.0)]), 1, 0, stamp(at(100)))
    store_bars(store, bars_frame(spark, [bar("A", 0, 2.0)]), 1, 1, stamp(at(200)))
    found = rows_of(store.ohlcv.current(spark), "code", "close", "created_at")
    assert found == [("A", 2.0, at(100)), ("B", 5.0, at(100))]


def test_higher_epoch_wins_over_any_batch_number(spark, store):
    store_bars(store, bars_frame(spark, [bar("A", 0, 1.0)]), 1, 5000)
    assert store.ohlcv.last_epoch(spark) == 1
    store_bars(store, bars_frame(spark, [bar("A", 0, 2.0)]), 2, 0)
    assert rows_of(store.ohlcv.current(spark), "close") == [(2.0,)]


def test_store_bars_reports_the_time_range(spark, store):
    rows = [bar("A", 3, 1.0), bar("A", 3000, 1.0), bar("B", 70, 1.0)]
    found = store_bars(store, bars_frame(spark, rows), 1, 0)
    assert [t.replace(tzinfo=None) for t in found] == [at(180), at(180000)]
    assert all(t.utcoffset() == timedelta(0) for t in found)
    assert store_bars(store, bars_frame(spark, []), 1, 1) is None


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 2), st.integers(0, 99)), max_size=12))
def test_versions_may_be_written_in_any_order(spark, tmp_path_factory, writes):
    """Three versions, written newest first, fold to the same view as a dictionary does."""
    store = Store(str(tmp_path_factory.mktemp("store")))
    versions = [{}, {}, {}]
    for i, (code, minute, close) in enumerate(writes):
        versions[i % 3][code, minute] = float(close)
    for number in (2, 0, 1):
        rows = [bar(c, m, v) for (c, m), v in versions[number].items()]
        store_bars(store, bars_frame(spark, rows), 1, number)
    want = versions[0] | versions[1] | versions[2]
    found = rows_of(store.ohlcv.current(spark), "code", "window_start", "close")
    assert found == sorted((c, at(60 * m), v) for (c, m), v in want.items())


def test_a_range_read_lists_only_its_days(spark, store):
    rows = [bar("A", 1440 * d, float(d)) for d in range(10)]
    store_bars(store, bars_frame(spark, rows), 1, 0)
    found = store.ohlcv.versions(spark, date(2024, 1, 3), date(2024, 1, 5))
    assert rows_of(found, "close") == [(2.0,), (3.0,), (4.0,)]
    assert len(found.inputFiles()) == 3
    wide = store.ohlcv.versions(spark, date(2020, 1, 1), date(2024, 1, 5))
    assert wide.count() == 5
    assert len(wide.inputFiles()) == 5
    assert store.ohlcv.versions(spark, None, date(2024, 1, 2)).count() == 2


def test_closed_days_keep_the_view_beside_a_writer(spark, store):
    """Days are merged between batches; late bars and replays of the newest batch still count."""
    table, want = store.ohlcv, {}
    for batch in range(6):
        rows = [bar("A", 1440 * d, 10.0 * batch + d) for d in range(batch, batch + 3)]
        rows.append(bar("B", 0, float(batch)))  # late, once the first day is closed
        store_bars(store, bars_frame(spark, rows), 1, batch, stamp(at(batch)))
        want |= {(r[0], r[1]): r[6] for r in rows}
        if batch in (2, 3, 5):
            table.close_days(spark, date(2024, 1, batch))
        found = rows_of(table.current(spark), "code", "window_start", "close")
        assert found == sorted((*k, v) for k, v in want.items())
    again = bars_frame(spark, [bar("A", 1440 * 5, 77.0)])
    store_bars(store, again, 1, 5, stamp(at(5)))
    (row,) = table.current(spark).filter("close = 77").collect()
    assert row.created_at == at(3)
    first = table.current(spark, date(2024, 1, 1), date(2024, 1, 1)).collect()
    assert {r.code: (r.close, r.created_at) for r in first} == {"A": (0.0, at(0)), "B": (5.0, at(0))}


def test_a_closed_day_is_read_from_its_merged_files(spark, store):
    table, day = store.ohlcv, date(2024, 1, 1)
    for batch in range(8):
        store_bars(store, bars_frame(spark, [bar("A", batch, 1.0), bar("A", 3000, 2.0)]), 1, batch)
    before = table.current(spark).collect()
    table.close_days(spark, day)
    rows = table.versions(spark, day, day)
    used = {r.f for r in rows.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len([f for f in used if "/ohlcv-merged/" in f]) == 1
    assert len([f for f in used if "/ohlcv/" in f]) == 1  # the newest batch, never merged
    assert sorted(table.current(spark).collect()) == sorted(before)
    table.close_days(spark, day)  # nothing new: the same again
    assert sorted(table.current(spark).collect()) == sorted(before)


def test_a_micro_batch_is_written_by_many_tasks(spark, store):
    """One day and many codes: without adaptive execution every task writes its own file."""
    rows = [bar(f"code{i}", 0, 1.0) for i in range(400)]
    frame = bars_frame(spark, rows).repartition(8, "code")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        store_bars(store, frame, 1, 0, remember=False)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(store.ohlcv.versions(spark).inputFiles()) == 8


def test_previous_close_comes_from_an_older_day(spark, store):
    """The predecessor lies far behind the look-back; another code has one in its own batch."""
    set_thresholds(spark, store, {"A": 0.0, "B": 0.0})
    put(spark, store, 0, [bar("A", 0, 100.0), bar("A", 5, 104.0)])
    put(spark, store, 1, [bar("A", 1440 * 30, 110.0), bar("B", 1440 * 30, 1.0), bar("B", 1440 * 30 + 1, 2.0)])
    log = store.anomaly_log.current(spark)
    assert rows_of(log, "code", "close", "prev_close") == [
        ("A", 104.0, 100.0),
        ("A", 110.0, 104.0),
        ("B", 2.0, 1.0),
    ]


def test_previous_close_at_every_distance(spark, store):
    """Inside each look-back, at their edges and beyond; a near code must not hide a far one."""
    month = 30 * 1440
    gaps = [1, 59, 60, 61, 1439, 1440, 1441, month - 1, month, month + 1, 500000]
    codes = {f"after {gap}": gap for gap in gaps}
    set_thresholds(spark, store, dict.fromkeys(codes, 0.0))
    now = 600000
    old = [bar(code, now - gap, float(gap)) for code, gap in codes.items()]
    older = [bar(code, now - gap - 1, 5.0) for code, gap in codes.items()]
    store_bars(store, bars_frame(spark, old + older), 1, 0)
    put(spark, store, 1, [bar(code, now, 1.5) for code in [*codes, "new"]])
    log = store.anomaly_log.current(spark).collect()
    assert {r.code: r.prev_close for r in log} == {c: float(g) for c, g in codes.items()}


def test_bars_later_than_the_kept_ones_find_their_predecessor(spark, store):
    """Late bars, older than all that is at hand: between stored ones, before them, and many."""
    codes = ("A", "B", "C")
    set_thresholds(spark, store, dict.fromkeys(codes, 0.0))
    old = [bar(c, 1440 * 40 * d + 10 * m, 100.0 * d + m) for c in codes for d in (0, 1) for m in range(12)]
    put(spark, store, 0, old)
    far = [bar("new", 5, 1.0), bar("A", 1440 * 40, 7.5), bar("A", 45, 6.5), bar("B", 1440 * 40 + 5, 3.5),
           bar("C", -5, 2.5), bar("C", 1440 * 39, 1.5), bar("C", 1440 * 39 + 1, 2.25)]
    put(spark, store, 1, far)
    found = {(r.code, r.window_start): r.prev_close for r in store.anomaly_log.current(spark).collect()}

    def prev(code, minute):
        return found.get((code, at(60 * minute)))

    assert prev("A", 1440 * 40) == 11.0 and prev("A", 45) == 4.0
    assert prev("B", 1440 * 40 + 5) == 100.0
    assert prev("C", -5) is None and prev("new", 5) is None
    assert prev("C", 1440 * 39) == 11.0 and prev("C", 1440 * 39 + 1) == 1.5


def test_a_batch_reads_a_constant_number_of_files(spark, store, monkeypatch, request):
    """Steady batches, a new code among them, never open the bars of other batches."""
    set_thresholds(spark, store, {"A": 0.0})
    opened, versions = [], KeyedTable.versions
    bars_path = store.ohlcv.path

    def watched(table, *args, **kw):
        if table.path in (bars_path, store.anomaly_log.path):
            opened.append(table.path)
        return versions(table, *args, **kw)

    spark.conf.set("spark.sql.shuffle.partitions", "1")  # twenty small batches
    request.addfinalizer(lambda: spark.conf.set("spark.sql.shuffle.partitions", "8"))
    put(spark, store, 0, [bar("A", 0, 1.0)])
    monkeypatch.setattr(KeyedTable, "versions", watched)
    files = set()
    for batch in range(1, 21):
        new = [bar(f"new{batch}", batch, 1.0)] if batch % 10 == 0 else []
        put(spark, store, batch, [bar("A", batch - 1, 1.5 * batch), bar("A", batch, 2.0 * batch), *new])
        if batch % 10 == 0:
            rows = store.recent.newest(spark)[1]
            assert rows.count() <= 8 + batch // 10
            files.add(len(store.ohlcv.version(spark, 1, batch, date(2024, 1, 1), date(2024, 1, 1)).inputFiles()))
    assert opened == [] and len(files) == 1
    monkeypatch.undo()
    log = store.anomaly_log.current(spark).collect()
    assert len(log) == 20 and all(r.code == "A" for r in log)
    assert {r.window_start: r.prev_close for r in log}[at(1200)] == 1.5 * 20


def test_an_updated_older_close_is_the_one_found(spark, store):
    set_thresholds(spark, store, {"A": 0.0})
    put(spark, store, 0, [bar("A", 0, 100.0)])
    put(spark, store, 1, [bar("A", 0, 50.0)])
    put(spark, store, 2, [bar("A", 1440 * 9, 75.0)])
    assert rows_of(store.anomaly_log.current(spark), "close", "prev_close") == [(75.0, 50.0)]


def latch(spark, store, last):
    set_thresholds(spark, store, {"A": 5.0})
    steps = [
        [bar("A", 0, 100.0), bar("A", 1, 110.0, open=101.0, volume=1.0)],
        [bar("A", 0, 100.0), bar("A", 1, 101.0, open=102.0, volume=2.0)],
        [bar("A", 0, 102.0), bar("A", 1, 120.0, open=103.0, volume=3.0, trade_count=9)],
    ]
    for batch, rows in enumerate(steps[: last + 1]):
        put(spark, store, batch, rows, detected_at=stamp(at(1000 + batch)))


def test_log_keeps_first_values_and_takes_last_ones(spark, store):
    latch(spark, store, 2)
    (row,) = store.anomaly_log.current(spark).collect()
    assert (row.prev_close, row.open, row.detected_at) == (100.0, 101.0, at(1000))
    assert (row.close, row.volume, row.trade_count) == (120.0, 3.0, 9)
    assert row.change_rate == pytest.approx((120 - 102) / 102 * 100)
    (alert,) = store.alerts.current(spark).collect()
    assert (alert.close, alert.direction) == (110.0, "🚀 급등")


def test_log_keeps_a_bar_that_calmed_down(spark, store):
    latch(spark, store, 1)
    (row,) = store.anomaly_log.current(spark).collect()
    assert (row.close, row.detected_at) == (110.0, at(1000))


def test_replaying_a_batch_changes_nothing(spark, store):
    latch(spark, store, 2)
    tables = (store.ohlcv, store.anomaly_log, store.alerts)

    def state():
        return [
            rows_of(t.versions(spark).drop("created_at", "detected_at"), "*") for t in tables
        ]

    before = state()
    rows = [bar("A", 0, 102.0), bar("A", 1, 120.0, open=103.0, volume=3.0, trade_count=9)]
    put(spark, store, 2, rows)
    assert state() == before


def test_a_replay_is_judged_as_the_first_try_was(spark, store):
    """Thresholds that changed since do not touch what the first try logged."""
    set_thresholds(spark, store, {"A": 5.0, "B": 5.0})
    put(spark, store, 0, [bar(c, 0, 100.0) for c in "AB"])
    rows = [bar("A", 1, 110.0), bar("B", 1440, 120.0)]
    put(spark, store, 1, rows)

    def state():
        return [sorted(t.versions(spark).collect()) for t in (store.anomaly_log, store.alerts)]

    before = state()
    assert [len(x) for x in before] == [2, 2]
    for moment, values in ((1, {"A": 5.0, "B": 50.0}), (2, {"A": 50.0, "B": 50.0}), (3, {"A": 0.0})):
        limits = [(c, t, None, None, START) for c, t in values.items()]
        store.anomaly_threshold.append(spark.createDataFrame(limits, THRESHOLD), 0, moment)
        put(spark, store, 1, rows)
        assert state() == before


def test_an_older_batch_may_be_repeated(spark, store):
    set_thresholds(spark, store, {"A": 0.0})
    for batch in range(4):
        put(spark, store, batch, [bar("A", batch, 10.0 + batch)])
    before = sorted(store.anomaly_log.current(spark).collect())
    put(spark, store, 1, [bar("A", 1, 11.0)])
    assert sorted(store.anomaly_log.current(spark).collect()) == before
    put(spark, store, 4, [bar("A", 4, 20.0)])
    assert [r.prev_close for r in store.anomaly_log.current(spark).filter("close = 20").collect()] == [13.0]


def test_replay_of_the_first_detection_alerts_again_only_in_place(spark, store):
    latch(spark, store, 0)
    put(spark, store, 0, [bar("A", 0, 100.0), bar("A", 1, 110.0, open=101.0)])
    assert store.alerts.versions(spark).count() == 1


def test_days_are_utc_whatever_the_time_zone_of_the_driver(spark, store, monkeypatch):
    """Bars on both sides of midnight UTC, seen from a zone nine hours ahead and one behind."""
    set_thresholds(spark, store, {"A": 0.0})
    try:
        for batch, zone in enumerate(("Asia/Seoul", "America/New_York")):
            monkeypatch.setenv("TZ", zone)
            time.tzset()
            for step, (start, close) in enumerate([("01 23:50:00", 10.0), ("02 00:10:00", 11.0)]):
                month = f"2024-0{batch + 1}"
                bars = spark.sql(
                    f"""SELECT 'A' AS code, TIMESTAMP '{month}-{start}' AS window_start,
                    TIMESTAMP '{month}-{start}' + INTERVAL 1 MINUTE AS window_end,
                    {close}D AS open, {close}D AS high, {close}D AS low, {close}D AS close,
                    1D AS volume, 1L AS trade_count"""
                )
                apply_bars(spark, store, bars, 1, 2 * batch + step)
    finally:
        monkeypatch.undo()
        time.tzset()
    log = store.anomaly_log.current(spark).orderBy("window_start").collect()
    assert [(r.close, r.prev_close) for r in log] == [(11.0, 10.0), (10.0, 11.0), (11.0, 10.0)]


def test_first_bar_is_never_flagged(spark, store):
    set_thresholds(spark, store, {"A": 0.0})
    put(spark, store, 0, [bar("A", 0, 100.0)])
    assert store.anomaly_log.current(spark).count() == 0


def test_threshold_job_upserts_and_leaves_other_codes(spark, store):
    early = [bar("OLD", m, 100.0 + 10 * (m % 2)) for m in range(4)]
    late = [bar("A", 1440 * 20 + m, c) for m, c in enumerate([100.0, 110.0, 99.0])]
    store_bars(store, bars_frame(spark, early + late), 1, 0)
    update_thresholds(spark, store, START + timedelta(days=1))
    update_thresholds(spark, store, START + timedelta(days=21))
    found = store.anomaly_threshold.current(spark)
    assert rows_of(found, "code", "calculated_at") == [
        ("A", START + timedelta(days=21)),
        ("OLD", START + timedelta(days=1)),
    ]
    before = found.collect()
    update_thresholds(spark, store, datetime(2030, 1, 1))
    update_thresholds(spark, store, START + timedelta(days=21))
    assert sorted(store.anomaly_threshold.current(spark).collect()) == sorted(before)


def test_threshold_job_uses_the_current_versions(spark, store):
    store_bars(store, bars_frame(spark, [bar("A", m, 7.0) for m in range(3)]), 1, 0)
    fixed = [bar("A", m, c) for m, c in enumerate([100.0, 110.0, 99.0])]
    store_bars(store, bars_frame(spark, fixed), 1, 1)
    update_thresholds(spark, store, START + timedelta(days=1))
    assert store.anomaly_threshold.current(spark).first().threshold == pytest.approx(10.0)


def test_reports_read_stored_days_only(spark, store):
    rows = [bar("A", 1440 * d, float(d)) for d in range(10)]
    store_bars(store, bars_frame(spark, rows), 1, 0)
    found = stored_series(spark, store, "close", datetime(2024, 1, 3), datetime(2024, 1, 4))
    assert [(r.time.day, r.value, r.metric) for r in found.collect()] == [
        (3, 2.0, "A"),
        (4, 3.0, "A"),
    ]
    assert len(found.inputFiles()) == 2


def test_a_range_in_another_zone_finds_the_same_bars(spark, store):
    rows = [bar("A", 60 * h, float(h)) for h in range(48)]
    store_bars(store, bars_frame(spark, rows), 1, 0)
    zone = timezone(timedelta(hours=9))
    since = datetime(2024, 1, 2, 7, 30, tzinfo=zone)
    until = datetime(2024, 1, 2, 10, 0, tzinfo=zone)
    there = stored_series(spark, store, "close", since, until)
    here = stored_series(spark, store, "close", datetime(2024, 1, 1, 22, 30), datetime(2024, 1, 2, 1))
    assert [r.value for r in there.collect()] == [r.value for r in here.collect()] == [23.0, 24.0, 25.0]


class Session:
    """The parts of a session that `shared_folder` asks for."""

    def __init__(self, master, setting=None):
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext = self
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_comes_from_the_session():
    session = Session("yarn", "hdfs://shared/place/")
    assert shared_folder(session) == "hdfs://shared/place"
    assert new_folder(session, "x").startswith("hdfs://shared/place/x-")
    assert session.folder is None


def test_only_a_local_master_falls_back_to_a_temporary_folder():
    with pytest.raises(RuntimeError):
        shared_folder(Session("yarn"))
    session = Session("local[2]")
    assert shared_folder(session) == session.folder == shared_folder(session)
