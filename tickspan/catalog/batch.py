"""Batch queries: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alert_message, change_rate
from ..operators import (
    asof_join,
    bars_of,
    detect,
    duplicate_keys,
    latest_bars,
    previous_close,
    recompute_thresholds,
    tick_defect,
    valid_ticks,
    wider_bars,
    with_threshold,
)
from ..operators.anomaly import judge
from ..operators.asof import with_percent_change
from ..plans.detection import apply_bars, store_bars
from ..plans.reports import (
    DEFAULT_RANGE,
    anomalies_by_bar,
    last_range,
    newest_anomalies,
    panel,
    preview,
    series,
    stored_anomalies,
    stored_series,
    threshold_list,
    with_severity,
)
from ..plans.store import Store
from ..plans.thresholds import HORIZON_DAYS, update_thresholds, update_thresholds_from_days
from ..schemas import TICK
from ..session import as_table, configure, new_folder
from ..sources import (
    load,
    only_symbols,
    parse_ticks,
    pick_fields,
    ticks_from_events,
    ticks_from_orders,
    to_messages,
)

AS_OF = "2024-01-31 00:00:00"
EARLIER = "2024-01-15 00:00:00"
MIDDAY = "2024-01-22 13:30:00"
RANGE = ("2024-01-10 06:00:00", "2024-01-20 18:00:00")
NOW = datetime(2024, 1, 20, 12, 0)
WATCHED = ("click", "purchase", "view")


def ticks(spark: SparkSession, folder: str, **options) -> DataFrame:
    configure(spark)
    return ticks_from_events(load(spark, folder, "events"), **options)


def hourly(spark: SparkSession, folder: str, **options) -> DataFrame:
    return bars_of(ticks(spark, folder, **options), "1 hour")


def whole_bars(since: str, until: str, width: timedelta) -> dict[str, str]:
    """The ticks of all bars that start in since..until, both ends included: start and end."""
    start, end = (datetime.fromisoformat(t) for t in (since, until))
    first = start - (start - datetime.min) % width
    last = end - (end - datetime.min) % width + width
    return {"since": str(first), "until": str(last)}


def stored_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars as a written table, for plans with several branches over them."""
    return as_table(hourly(spark, folder), "bars")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums, means and quotients depend on the order of additions; compare six digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def as_doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# ---- parsing ---------------------------------------------------------------------------------


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return to_messages(ticks(spark, folder), keep=["event_id"])


def parse_trades(spark, folder):
    return parse_ticks(messages(spark, folder), keep=["event_id"])


def raw_value_text(spark, folder):
    return messages(spark, folder).select("event_id", F.col("value").cast("string").alias("value"))


def event_time_millis(spark, folder):
    return ticks(spark, folder).select("event_id", "event_time")


def event_time_second(spark, folder):
    return ticks(spark, folder, precision="second").select("event_id", "event_time")


def keyed_json_sink(spark, folder):
    """A feed with further fields, reduced to the five of a tick."""
    raw = ticks(spark, folder).select(
        "event_id",
        F.encode(
            F.to_json(F.struct(*TICK.fieldNames(), F.col("event_id").alias("sequential_id"))),
            "UTF-8",
        ).alias("value"),
    )
    return pick_fields(raw, keep=["event_id"]).select(
        "event_id", F.col("key").cast("string"), F.col("value").cast("string")
    )


def faulty_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a message; the kind of fault depends on its type."""
    kind = F.col("code")
    good = F.to_json(F.struct(*TICK.fieldNames()))
    wrong_shape = F.to_json(
        F.struct(kind.alias("coin"), F.col("trade_price").cast("long").alias("price"))
    )
    text_price = F.to_json(
        F.struct("code", F.lit("n/a").alias("trade_price"), "trade_volume", "timestamp", "ask_bid")
    )
    long_code = F.to_json(
        F.struct(
            F.concat(kind, F.lit("-with-a-very-long-name")).alias("code"),
            *TICK.fieldNames()[1:],
        )
    )
    text = (
        F.when(kind == "error", F.lit("not json"))
        .when(kind == "signup", wrong_shape)
        .when(kind == "view", text_price)
        .when((kind == "click") & (F.col("ask_bid") == "ASK"), long_code)
        .otherwise(good)
    )
    return ticks(spark, folder).select("event_id", F.encode(text, "UTF-8").alias("value"))


def malformed_json_dropped(spark, folder):
    parsed = parse_ticks(faulty_messages(spark, folder), keep=["event_id"])
    return valid_ticks(parsed)


def null_quarantine(spark, folder):
    parsed = parse_ticks(faulty_messages(spark, folder), keep=["event_id"])
    return parsed.select(
        "event_id", "code", "trade_price", F.coalesce(tick_defect(), F.lit("ok")).alias("outcome")
    )


def symbol_filter(spark, folder):
    return only_symbols(ticks(spark, folder), WATCHED).select("event_id", "code", "trade_price")


def symbol_table_filter(spark, folder):
    """The symbols of a table: those whose bars reach the highest price of all."""
    wanted = ticks(spark, folder).groupBy("code").agg(F.max("trade_price").alias("high"))
    return only_symbols(ticks(spark, folder), wanted.filter("high >= 420")).select(
        "event_id", "code", "trade_price"
    )


# ---- bars ------------------------------------------------------------------------------------


def ohlcv(width: str):
    def query(spark, folder):
        return rounded(bars_of(ticks(spark, folder), width), "volume")

    return query


def ohlcv_second_ties(spark, folder):
    by_second = ticks(spark, folder, precision="second")
    return rounded(bars_of(by_second, "1 minute", tie_break="event_id"), "volume")


def ohlcv_orders_1d(spark, folder):
    configure(spark)
    daily = ticks_from_orders(load(spark, folder, "orders"))
    return rounded(bars_of(daily, "1 day", tie_break="o_orderkey"), "volume")


def latest_bar_per_code(spark, folder):
    return rounded(latest_bars(hourly(spark, folder)), "volume")


def ohlcv_1d_from_1m(spark, folder):
    """Daily bars out of stored minute bars; no tick is read for them."""
    store = Store(new_folder(spark, "store"))
    store_bars(store, bars_of(ticks(spark, folder)), 1, 0, remember=False)
    return rounded(wider_bars(store.ohlcv.current(spark), "1 day"), "volume")


def unique_key_check(spark, folder):
    return duplicate_keys(ticks(spark, folder, precision="second"), ["code", "event_time"])


# ---- previous close and change ---------------------------------------------------------------


def prev_close_asof(spark, folder):
    bars = hourly(spark, folder).select("code", "window_start", "close")
    return previous_close(bars)


def prev_close_orders(spark, folder):
    configure(spark)
    daily = bars_of(
        ticks_from_orders(load(spark, folder, "orders")), "1 day", tie_break="o_orderkey"
    )
    return previous_close(daily.select("code", "window_start", "close"), bucket="month")


def asof_two_table(spark, folder):
    """Every tick with the close of the last hourly bar that started before it."""
    left = ticks(spark, folder).select("event_id", "code", "event_time", "trade_price")
    right = hourly(spark, folder).select("code", "window_start", "close")
    return asof_join(left, right, ["code"], "event_time", "window_start", ["close"])


def asof_completed_bar(spark, folder):
    """Every tick with the newest bar that was complete at its time, the end included."""
    left = ticks(spark, folder).select("event_id", "code", "event_time")
    right = hourly(spark, folder).select("code", "window_end", "close", "high")
    return asof_join(
        left, right, ["code"], "event_time", "window_end", ["close", "high"], strict=False
    )


def change_rate_query(spark, folder):
    bars = prev_close_asof(spark, folder)
    rate = change_rate(F.col("close"), F.col("prev_close"))
    return rounded(bars.withColumn("change_rate", rate), "change_rate")


def bar_change_rate(spark, folder):
    bars = hourly(spark, folder).select("code", "window_start", "close")
    return rounded(with_percent_change(bars), "change_rate")


def bar_change_rate_1m(spark, folder):
    bars = bars_of(ticks(spark, folder)).select("code", "window_start", "close")
    return rounded(with_percent_change(bars), "change_rate")


# ---- thresholds ------------------------------------------------------------------------------


def thresholds_at(spark: SparkSession, folder: str, as_of: str) -> DataFrame:
    """Only the ticks of the bars in the horizon before as_of are read."""
    moment = datetime.fromisoformat(as_of)
    since = moment - timedelta(days=HORIZON_DAYS)
    cut = whole_bars(str(since), str(moment), timedelta(hours=1))
    return recompute_thresholds(hourly(spark, folder, **cut), as_of, f"{HORIZON_DAYS} days")


def anomaly_threshold_7d(spark, folder):
    found = thresholds_at(spark, folder, AS_OF)
    return rounded(found, "threshold", "avg_change", "std_change")


def threshold_lookup_default(spark, folder):
    """Thresholds known for the watched codes only; the others get the default."""
    known = only_symbols(thresholds_at(spark, folder, AS_OF), WATCHED)
    bars = hourly(spark, folder).select("code", "window_start", "close")
    return rounded(with_threshold(bars, known), "threshold")


def threshold_store(spark: SparkSession, folder: str, *moments: str) -> DataFrame:
    """Run the daily job at each moment over stored bars; the table afterwards."""
    store = Store(new_folder(spark, "store"))
    store_bars(store, hourly(spark, folder), 1, 0, remember=False)
    for moment in moments:
        update_thresholds(spark, store, datetime.fromisoformat(moment))
    found = store.anomaly_threshold.current(spark)
    return rounded(found, "threshold", "avg_change", "std_change")


def threshold_upsert(spark, folder):
    return threshold_store(spark, folder, EARLIER, AS_OF)


def threshold_empty_noop(spark, folder):
    return threshold_store(spark, folder, AS_OF, "2025-06-01 00:00:00")


def threshold_from_days(spark, folder):
    """The daily job over stored bars on two days in a row; the second reads the new day alone."""
    store = Store(new_folder(spark, "store"))
    store_bars(store, hourly(spark, folder), 1, 0, remember=False)
    last = datetime.fromisoformat(AS_OF)
    for moment in (last - timedelta(days=1), last):
        update_thresholds_from_days(spark, store, moment)
    found = store.anomaly_threshold.current(spark)
    return rounded(found, "threshold", "avg_change", "std_change")


def threshold_from_cut_days(spark, folder):
    """The same at midday: two days of the horizon are cut, six come from their parts."""
    store = Store(new_folder(spark, "store"))
    store_bars(store, hourly(spark, folder), 1, 0, remember=False)
    update_thresholds_from_days(spark, store, datetime.fromisoformat(MIDDAY))
    found = store.anomaly_threshold.current(spark)
    return rounded(found, "threshold", "avg_change", "std_change")


# ---- detection -------------------------------------------------------------------------------


def detected(spark: SparkSession, folder: str) -> DataFrame:
    bars = stored_hourly(spark, folder)
    return detect(bars, recompute_thresholds(bars, AS_OF))


def anomaly_detect(spark, folder):
    return rounded(detected(spark, folder), "volume", "change_rate", "threshold")


def judged_bars(spark, folder):
    """The verdict on every bar, not only the anomalous ones."""
    bars = stored_hourly(spark, folder)
    found = judge(previous_close(bars), recompute_thresholds(bars, AS_OF))
    return rounded(
        found.select("code", "window_start", "prev_close", "change_rate", "threshold", "is_anomaly"),
        "change_rate",
        "threshold",
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """The anomalies as if each had been detected when its bar ended."""
    return detected(spark, folder).withColumn("detected_at", F.col("window_end"))


SEEN_AT = ("2024-02-01 00:00:00", "2024-02-02 00:00:00")


def two_versions(spark: SparkSession, folder: str) -> Store:
    """Each hourly bar written twice: as it stood at half past, then complete."""
    store = Store(new_folder(spark, "store"))
    all_ticks = ticks(spark, folder)
    full = as_table(bars_of(all_ticks, "1 hour"), "bars")
    half = bars_of(all_ticks.filter(F.minute("event_time") < 30), "1 hour")
    store.anomaly_threshold.append(recompute_thresholds(full, AS_OF), 0, 0)
    for batch, bars in enumerate((half, full)):
        stamp = F.lit(SEEN_AT[batch]).cast("timestamp")
        apply_bars(spark, store, bars, 1, batch, created_at=stamp, detected_at=stamp)
    return store


def ohlcv_upsert_latest(spark, folder):
    store = Store(new_folder(spark, "store"))
    all_ticks = ticks(spark, folder)
    half = bars_of(all_ticks.filter(F.minute("event_time") < 30), "1 hour")
    for batch, bars in enumerate((half, bars_of(all_ticks, "1 hour"))):
        store_bars(store, bars, 1, batch, F.lit(SEEN_AT[batch]).cast("timestamp"), remember=False)
    return rounded(store.ohlcv.current(spark), "volume")


def anomaly_log_upsert(spark, folder):
    log = two_versions(spark, folder).anomaly_log.current(spark)
    return rounded(log, "volume", "change_rate")


def alert_new_only(spark, folder):
    alerts = two_versions(spark, folder).alerts
    return rounded(
        alerts.versions(spark).select("code", "window_start", "batch", "close", "change_rate"),
        "change_rate",
    )


def alert_message_query(spark, folder):
    text = alert_message(F.col("code"), F.col("close"), F.col("change_rate"))
    return detected(spark, folder).select("code", "window_start", text.alias("message"))


# ---- reports ---------------------------------------------------------------------------------


HOURS = whole_bars(*RANGE, timedelta(hours=1))


def dashboard_close_series(spark, folder):
    return series(hourly(spark, folder, **HOURS), "close", *RANGE)


def dashboard_volume_series(spark, folder):
    return rounded(series(hourly(spark, folder, **HOURS), "volume", *RANGE), "value")


def time_range_last_hour(spark, folder):
    span = whole_bars(str(NOW - DEFAULT_RANGE), str(NOW), timedelta(minutes=1))
    bars = bars_of(ticks(spark, folder, **span))
    return last_range(bars, NOW).select("code", "window_start", "close")


def dashboard_anomaly_top50(spark, folder):
    return as_doubles(newest_anomalies(event_log(spark, folder)), "change_rate")


def dashboard_anomaly_by_bar(spark, folder):
    return as_doubles(anomalies_by_bar(event_log(spark, folder)), "change_rate")


def dashboard_severity(spark, folder):
    """The colour of every anomaly; the panel itself shows the newest fifty."""
    found = with_severity(event_log(spark, folder))
    return rounded(found.select("code", "window_start", "change_rate", "severity"), "change_rate")


def dashboard_threshold_table(spark, folder):
    found = threshold_list(thresholds_at(spark, folder, AS_OF))
    return as_doubles(found, "threshold", "avg_change", "std_change")


def half_and_full(spark: SparkSession, folder: str) -> Store:
    """A store of bars alone, each written twice."""
    store = Store(new_folder(spark, "store"))
    all_ticks = ticks(spark, folder)
    half = bars_of(all_ticks.filter(F.minute("event_time") < 30), "1 hour")
    for batch, bars in enumerate((half, bars_of(all_ticks, "1 hour"))):
        store_bars(store, bars, 1, batch, F.lit(SEEN_AT[batch]).cast("timestamp"), remember=False)
    return store


def stored_close_series(spark, folder):
    """The panel's range out of stored bars that were written twice."""
    store = half_and_full(spark, folder)
    since, until = (datetime.fromisoformat(t) for t in RANGE)
    return stored_series(spark, store, "close", since, until)


def stored_top50(spark, folder):
    """The newest fifty out of a log that was written over two days."""
    found = stored_anomalies(spark, two_versions(spark, folder))
    return as_doubles(found, "change_rate")


def sql_series(column: str):
    """A panel's SQL over the views of the store."""

    def query(spark, folder):
        since, until = (datetime.fromisoformat(t) for t in RANGE)
        return rounded(panel(spark, half_and_full(spark, folder), column, since, until), "value")

    return query


def sql_bars(spark, folder):
    return rounded(panel(spark, half_and_full(spark, folder), "bars"), "volume")


def sql_anomalies(spark, folder):
    return as_doubles(panel(spark, two_versions(spark, folder), "anomalies"), "change_rate")


def sql_log(spark, folder):
    return rounded(panel(spark, two_versions(spark, folder), "log"), "volume", "change_rate")


def sql_thresholds(spark, folder):
    store = Store(new_folder(spark, "store"))
    store_bars(store, hourly(spark, folder), 1, 0, remember=False)
    update_thresholds(spark, store, datetime.fromisoformat(AS_OF))
    found = panel(spark, store, "thresholds")
    return as_doubles(found, "threshold", "avg_change", "std_change")


def closed_close_series(spark, folder):
    """The panel's range out of days that were merged, in the order of time."""
    store = half_and_full(spark, folder)
    last = store_bars(store, hourly(spark, folder), 1, 2, remember=False)[1]
    store.ohlcv.close_days(spark, last.date())
    since, until = (datetime.fromisoformat(t) for t in RANGE)
    return stored_series(spark, store, "close", since, until)


def stored_threshold_table(spark, folder):
    store = Store(new_folder(spark, "store"))
    store_bars(store, hourly(spark, folder), 1, 0, remember=False)
    update_thresholds(spark, store, datetime.fromisoformat(AS_OF))
    found = threshold_list(store.anomaly_threshold.current(spark))
    return as_doubles(found, "threshold", "avg_change", "std_change")


def ohlcv_after_compaction(spark, folder):
    """Two versions of all bars; days are merged before, between and after, up to different days."""
    store = Store(new_folder(spark, "store"))
    all_ticks = ticks(spark, folder)
    half = bars_of(all_ticks.filter(F.minute("event_time") < 30), "1 hour")
    days = ("2024-01-12", "2024-01-20")
    for batch, bars in enumerate((half, bars_of(all_ticks, "1 hour"))):
        stamp = F.lit(SEEN_AT[batch]).cast("timestamp")
        store_bars(store, bars, 1, batch, stamp, remember=False)
        store.ohlcv.close_days(spark, date.fromisoformat(days[batch]))
    return rounded(store.ohlcv.current(spark), "volume")


def limit_preview(spark, folder):
    return rounded(preview(hourly(spark, folder)), "volume")


BATCH = {
    "parse_trades": parse_trades,
    "raw_value_text": raw_value_text,
    "event_time_millis": event_time_millis,
    "event_time_second": event_time_second,
    "keyed_json_sink": keyed_json_sink,
    "malformed_json_dropped": malformed_json_dropped,
    "null_quarantine": null_quarantine,
    "symbol_filter": symbol_filter,
    "symbol_table_filter": symbol_table_filter,
    "ohlcv_1m": ohlcv("1 minute"),
    "ohlcv_1h": ohlcv("1 hour"),
    "ohlcv_1d": ohlcv("1 day"),
    "ohlcv_second_ties": ohlcv_second_ties,
    "ohlcv_orders_1d": ohlcv_orders_1d,
    "ohlcv_1d_from_1m": ohlcv_1d_from_1m,
    "latest_bar_per_code": latest_bar_per_code,
    "unique_key_check": unique_key_check,
    "prev_close_asof": prev_close_asof,
    "prev_close_orders": prev_close_orders,
    "asof_two_table": asof_two_table,
    "asof_completed_bar": asof_completed_bar,
    "change_rate": change_rate_query,
    "bar_change_rate": bar_change_rate,
    "bar_change_rate_1m": bar_change_rate_1m,
    "anomaly_threshold_7d": anomaly_threshold_7d,
    "threshold_lookup_default": threshold_lookup_default,
    "threshold_upsert": threshold_upsert,
    "threshold_empty_noop": threshold_empty_noop,
    "threshold_from_days": threshold_from_days,
    "threshold_from_cut_days": threshold_from_cut_days,
    "anomaly_detect": anomaly_detect,
    "judged_bars": judged_bars,
    "ohlcv_upsert_latest": ohlcv_upsert_latest,
    "anomaly_log_upsert": anomaly_log_upsert,
    "alert_new_only": alert_new_only,
    "alert_message": alert_message_query,
    "dashboard_close_series": dashboard_close_series,
    "dashboard_volume_series": dashboard_volume_series,
    "time_range_last_hour": time_range_last_hour,
    "dashboard_anomaly_top50": dashboard_anomaly_top50,
    "dashboard_anomaly_by_bar": dashboard_anomaly_by_bar,
    "dashboard_severity": dashboard_severity,
    "dashboard_threshold_table": dashboard_threshold_table,
    "stored_close_series": stored_close_series,
    "stored_top50": stored_top50,
    "stored_threshold_table": stored_threshold_table,
    "ohlcv_after_compaction": ohlcv_after_compaction,
    "closed_close_series": closed_close_series,
    "sql_close_series": sql_series("close"),
    "sql_volume_series": sql_series("volume"),
    "sql_anomalies": sql_anomalies,
    "sql_thresholds": sql_thresholds,
    "sql_bars": sql_bars,
    "sql_log": sql_log,
    "limit_preview": limit_preview,
}
