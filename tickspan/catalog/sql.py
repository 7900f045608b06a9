"""SQL (DuckDB) for every query whose result SQL can state, over the same tables.

Written on its own terms (LAG, ASOF joins, full outer joins), not from the Spark plans.
"""

from __future__ import annotations

TRADES = """
trades AS (
  SELECT event_id, event_type AS code, value AS trade_price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS trade_volume,
         epoch_us(ts) // 1000 AS timestamp,
         CASE WHEN user_id % 2 = 0 THEN 'ASK' ELSE 'BID' END AS ask_bid,
         date_trunc('millisecond', ts) AS event_time
  FROM events)"""

JSON_TEXT = """
  '{"code":"' || code || '","trade_price":' || CAST(trade_price AS VARCHAR)
  || ',"trade_volume":' || CAST(trade_volume AS VARCHAR)
  || ',"timestamp":' || CAST(timestamp AS VARCHAR)
  || ',"ask_bid":"' || ask_bid || '"}'"""


def bars(
    unit: str = "hour",
    source: str = "trades",
    name: str = "bars",
    order: str = "event_time",
    time: str = "event_time",
) -> str:
    return f"""
{name} AS (
  SELECT code, date_trunc('{unit}', {time})::TIMESTAMP AS window_start,
         date_trunc('{unit}', {time})::TIMESTAMP + INTERVAL 1 {unit} AS window_end,
         arg_min(trade_price, {order}) AS open, max(trade_price) AS high,
         min(trade_price) AS low, arg_max(trade_price, {order}) AS close,
         sum(trade_volume) AS volume, count(trade_price) AS trade_count
  FROM {source} GROUP BY ALL)"""


def priced(source: str = "bars", name: str = "priced") -> str:
    """Bars with their previous close and both change rates."""
    return f"""
{name} AS (
  SELECT b.*, p.close AS prev_close,
         (b.close - p.close) / NULLIF(p.close, 0) * 100 AS pct,
         COALESCE((b.close - p.close) / NULLIF(p.close, 0) * 100, 0.0) AS rate
  FROM {source} b ASOF LEFT JOIN {source} p
    ON b.code = p.code AND b.window_start > p.window_start)"""


def thresholds(as_of: str = "2024-01-31 00:00:00", source: str = "bars", name: str = "thr") -> str:
    return f"""
{name} AS (
  SELECT code, COALESCE(avg(abs(c)) + 3 * stddev_samp(abs(c)), 3.0) AS threshold,
         avg(abs(c)) AS avg_change, stddev_samp(abs(c)) AS std_change,
         TIMESTAMP '{as_of}' AS calculated_at
  FROM (SELECT code, (close - lag(close) OVER w) / NULLIF(lag(close) OVER w, 0) * 100 AS c
        FROM {source}
        WHERE window_start >= TIMESTAMP '{as_of}' - INTERVAL 7 DAY
          AND window_start < TIMESTAMP '{as_of}'
        WINDOW w AS (PARTITION BY code ORDER BY window_start))
  WHERE c IS NOT NULL GROUP BY code)"""


def flagged(source: str = "priced", name: str = "flagged") -> str:
    return f"""
{name} AS (
  SELECT p.*, COALESCE(t.threshold, 3.0) AS threshold
  FROM {source} p LEFT JOIN thr t ON p.code = t.code
  WHERE p.prev_close IS NOT NULL AND abs(p.rate) >= COALESCE(t.threshold, 3.0))"""


def message(rate: str = "rate") -> str:
    return f"""
  '[이상 탐지] ' || code || chr(10)
  || CASE WHEN {rate} > 0 THEN '🚀 급등' ELSE '📉 급락' END || ' '
  || printf('%+.2f', CAST(round(CAST({rate} AS DECIMAL(38,10)), 2) AS DOUBLE)) || '%' || chr(10)
  || '현재가: ' || format('{{:,}}', CAST(round(CAST(close AS DECIMAL(38,10)), 0) AS BIGINT)) || '원'"""


def with_(*parts: str) -> str:
    return "WITH" + ",".join(parts) + "\n"


def r2(column: str) -> str:
    return f"CAST(round(CAST({column} AS DECIMAL(38,10)), 2) AS DOUBLE)"


BAR_COLUMNS = (
    "code, window_start, window_end, open, high, low, close, round(volume, 6) AS volume, trade_count"
)
THRESHOLD_COLUMNS = (
    "code, round(threshold, 6) AS threshold, round(avg_change, 6) AS avg_change, "
    "round(std_change, 6) AS std_change, calculated_at"
)
HOURLY = (TRADES, bars())
DETECTED = (*HOURLY, priced(), thresholds(), flagged())
ORDER_TICKS = """
trades AS (
  SELECT o_orderpriority AS code, o_totalprice AS trade_price, 1.0::DOUBLE AS trade_volume,
         o_orderdate AS event_time, o_orderkey
  FROM orders)"""
ORDER_BARS = (ORDER_TICKS, bars("day", order="(event_time, o_orderkey)"))

FAULTY = """
faulty AS (
  SELECT event_id,
         CASE WHEN code IN ('error', 'signup') THEN NULL
              WHEN code = 'click' AND ask_bid = 'ASK' THEN code || '-with-a-very-long-name'
              ELSE code END AS code,
         CASE WHEN code IN ('error', 'signup', 'view') THEN NULL ELSE trade_price END AS trade_price,
         CASE WHEN code IN ('error', 'signup') THEN 'code missing'
              WHEN code = 'click' AND ask_bid = 'ASK' THEN 'code too long'
              WHEN code = 'view' THEN 'price missing' ELSE 'ok' END AS outcome,
         trade_volume, timestamp, ask_bid, event_time
  FROM trades)"""

# Two versions of every hourly bar: its first half hour, then all of it.
VERSIONS = (
    TRADES,
    bars(),
    "\nhalf_trades AS (SELECT * FROM trades WHERE date_part('minute', event_time) < 30)",
    bars(source="half_trades", name="half"),
    thresholds(),
    priced("half", "priced0"),
    priced("bars", "priced1"),
    flagged("priced0", "f0"),
    flagged("priced1", "f1"),
)

ON_TIME = (
    TRADES,
    "\non_time AS (SELECT * FROM trades WHERE NOT (code = 'error' "
    "AND event_time < TIMESTAMP '2024-01-05 00:00:00'))",
    bars(source="on_time"),
)

NULL_FIELDS = (
    TRADES,
    """
faulty AS (
  SELECT CASE WHEN event_id % 13 = 0 THEN code || '-with-a-very-long-name' ELSE code END AS code,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE trade_price END AS trade_price,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE trade_volume END AS trade_volume, event_time
  FROM trades)""",
    bars(source="faulty"),
)

RANGE = "BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00'"
BY_KEY = " AND ".join(f"{{0}}.{c} = {{1}}.{c}" for c in ("code", "window_start"))
TOP50 = f"""
top50 AS (
  SELECT window_end AS detected_at, code, window_start, close, prev_close, {r2("rate")} AS change_rate
  FROM flagged ORDER BY window_end DESC, window_start DESC, code LIMIT 50)"""
ANOMALY_COLUMNS = f"{BAR_COLUMNS}, prev_close, round(rate, 6) AS change_rate"

SQL = {
    "parse_trades": with_(TRADES)
    + "SELECT event_id, code, trade_price, trade_volume, timestamp, ask_bid, event_time FROM trades",
    "raw_value_text": with_(TRADES) + f"SELECT event_id, {JSON_TEXT} AS value FROM trades",
    "event_time_millis": with_(TRADES) + "SELECT event_id, event_time FROM trades",
    "event_time_second": with_(TRADES)
    + "SELECT event_id, date_trunc('second', event_time) AS event_time FROM trades",
    "keyed_json_sink": with_(TRADES)
    + f"SELECT event_id, code AS key, {JSON_TEXT} AS value FROM trades",
    "malformed_json_dropped": with_(TRADES, FAULTY)
    + """SELECT event_id, code, trade_price, trade_volume, timestamp, ask_bid, event_time
FROM faulty WHERE outcome = 'ok'""",
    "null_quarantine": with_(TRADES, FAULTY)
    + "SELECT event_id, code, trade_price, outcome FROM faulty",
    "symbol_filter": with_(TRADES)
    + "SELECT event_id, code, trade_price FROM trades WHERE code IN ('click', 'purchase', 'view')",
    "symbol_table_filter": with_(TRADES)
    + """SELECT event_id, code, trade_price FROM trades
WHERE code IN (SELECT code FROM trades GROUP BY code HAVING max(trade_price) >= 420)""",
    "ohlcv_1m": with_(TRADES, bars("minute")) + f"SELECT {BAR_COLUMNS} FROM bars",
    "ohlcv_1h": with_(*HOURLY) + f"SELECT {BAR_COLUMNS} FROM bars",
    "ohlcv_1d": with_(TRADES, bars("day")) + f"SELECT {BAR_COLUMNS} FROM bars",
    "ohlcv_second_ties": with_(
        TRADES, bars("minute", order="(date_trunc('second', event_time), event_id)")
    )
    + f"SELECT {BAR_COLUMNS} FROM bars",
    "ohlcv_orders_1d": with_(*ORDER_BARS) + f"SELECT {BAR_COLUMNS} FROM bars",
    "latest_bar_per_code": with_(*HOURLY)
    + f"""SELECT {BAR_COLUMNS} FROM bars
QUALIFY row_number() OVER (PARTITION BY code ORDER BY window_start DESC) = 1""",
    "unique_key_check": with_(TRADES)
    + """SELECT code, date_trunc('second', event_time) AS event_time, count(*) AS n_rows
FROM trades GROUP BY ALL HAVING count(*) > 1""",
    "prev_close_asof": with_(*HOURLY, priced())
    + "SELECT code, window_start, close, prev_close FROM priced",
    "prev_close_orders": with_(*ORDER_BARS, priced())
    + "SELECT code, window_start, close, prev_close FROM priced",
    "asof_two_table": with_(*HOURLY)
    + """SELECT t.event_id, t.code, t.event_time, t.trade_price, b.close
FROM trades t ASOF LEFT JOIN bars b ON t.code = b.code AND t.event_time > b.window_start""",
    "asof_completed_bar": with_(*HOURLY)
    + """SELECT t.event_id, t.code, t.event_time, b.close, b.high
FROM trades t ASOF LEFT JOIN bars b ON t.code = b.code AND t.event_time >= b.window_end""",
    "change_rate": with_(*HOURLY, priced())
    + "SELECT code, window_start, close, prev_close, round(rate, 6) AS change_rate FROM priced",
    "bar_change_rate": with_(*HOURLY, priced())
    + "SELECT code, window_start, close, prev_close, round(pct, 6) AS change_rate FROM priced",
    "bar_change_rate_1m": with_(TRADES, bars("minute"), priced())
    + "SELECT code, window_start, close, prev_close, round(pct, 6) AS change_rate FROM priced",
    "anomaly_threshold_7d": with_(*HOURLY, thresholds()) + f"SELECT {THRESHOLD_COLUMNS} FROM thr",
    "threshold_from_cut_days": with_(*HOURLY, thresholds("2024-01-22 13:30:00"))
    + f"SELECT {THRESHOLD_COLUMNS} FROM thr",
    "threshold_lookup_default": with_(*HOURLY, thresholds())
    + """SELECT b.code, b.window_start, b.close, round(COALESCE(t.threshold, 3.0), 6) AS threshold
FROM bars b LEFT JOIN thr t ON b.code = t.code AND t.code IN ('click', 'purchase', 'view')""",
    "threshold_upsert": with_(
        *HOURLY, thresholds("2024-01-15 00:00:00", name="thr0"), thresholds(name="thr1")
    )
    + f"""SELECT {THRESHOLD_COLUMNS} FROM (
  SELECT * FROM thr1 UNION ALL
  SELECT * FROM thr0 WHERE code NOT IN (SELECT code FROM thr1))""",
    "threshold_empty_noop": with_(*HOURLY, thresholds()) + f"SELECT {THRESHOLD_COLUMNS} FROM thr",
    "anomaly_detect": with_(*DETECTED)
    + f"SELECT {ANOMALY_COLUMNS}, round(threshold, 6) AS threshold FROM flagged",
    "judged_bars": with_(*DETECTED)
    + """SELECT p.code, p.window_start, p.prev_close, round(p.rate, 6) AS change_rate,
       round(COALESCE(t.threshold, 3.0), 6) AS threshold,
       p.prev_close IS NOT NULL AND abs(p.rate) >= COALESCE(t.threshold, 3.0) AS is_anomaly
FROM priced p LEFT JOIN thr t ON p.code = t.code""",
    "ohlcv_upsert_latest": with_(*VERSIONS)
    + f"""SELECT {BAR_COLUMNS},
       CASE WHEN (code, window_start) IN (SELECT (code, window_start) FROM half)
            THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-02-02 00:00:00'
       END AS created_at
FROM bars""",
    "anomaly_log_upsert": with_(*VERSIONS)
    + f"""SELECT COALESCE(f0.code, f1.code) AS code,
       COALESCE(f0.window_start, f1.window_start) AS window_start,
       COALESCE(f0.window_end, f1.window_end) AS window_end,
       CASE WHEN f0.code IS NOT NULL THEN f0.open ELSE f1.open END AS open,
       CASE WHEN f0.code IS NOT NULL THEN f0.prev_close ELSE f1.prev_close END AS prev_close,
       CASE WHEN f0.code IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE TIMESTAMP '2024-02-02 00:00:00' END AS detected_at,
       CASE WHEN f1.code IS NOT NULL THEN f1.high ELSE f0.high END AS high,
       CASE WHEN f1.code IS NOT NULL THEN f1.low ELSE f0.low END AS low,
       CASE WHEN f1.code IS NOT NULL THEN f1.close ELSE f0.close END AS close,
       CASE WHEN f1.code IS NOT NULL THEN round(f1.volume, 6) ELSE round(f0.volume, 6) END AS volume,
       CASE WHEN f1.code IS NOT NULL THEN f1.trade_count ELSE f0.trade_count END AS trade_count,
       CASE WHEN f1.code IS NOT NULL THEN round(f1.rate, 6) ELSE round(f0.rate, 6) END AS change_rate
FROM f0 FULL OUTER JOIN f1 ON {BY_KEY.format("f0", "f1")}""",
    "alert_new_only": with_(*VERSIONS)
    + """SELECT code, window_start, 0::BIGINT AS batch, close, round(rate, 6) AS change_rate FROM f0
UNION ALL
SELECT code, window_start, 1::BIGINT, close, round(rate, 6) FROM f1
WHERE (code, window_start) NOT IN (SELECT (code, window_start) FROM f0)""",
    "alert_message": with_(*DETECTED)
    + f"SELECT code, window_start, {message()} AS message FROM flagged",
    "dashboard_close_series": with_(*HOURLY)
    + f"""SELECT window_start AS time, close AS value, code AS metric FROM bars
WHERE window_start {RANGE} ORDER BY 1, 3""",
    "dashboard_volume_series": with_(*HOURLY)
    + f"""SELECT window_start AS time, round(volume, 6) AS value, code AS metric FROM bars
WHERE window_start {RANGE} ORDER BY 1, 3""",
    "time_range_last_hour": with_(TRADES, bars("minute"))
    + """SELECT code, window_start, close FROM bars
WHERE window_start BETWEEN TIMESTAMP '2024-01-20 11:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "dashboard_anomaly_top50": with_(*DETECTED, TOP50) + "SELECT * FROM top50",
    "dashboard_anomaly_by_bar": with_(*DETECTED, TOP50)
    + "SELECT * FROM top50 ORDER BY window_start DESC, code",
    "dashboard_severity": with_(*DETECTED)
    + """SELECT code, window_start, round(rate, 6) AS change_rate,
       CASE WHEN rate >= 3 THEN 'red' ELSE 'green' END AS severity FROM flagged""",
    "dashboard_threshold_table": with_(*HOURLY, thresholds())
    + f"""SELECT code, {r2("threshold")} AS threshold, {r2("avg_change")} AS avg_change,
       {r2("std_change")} AS std_change, calculated_at FROM thr ORDER BY code""",
    "limit_preview": with_(*HOURLY)
    + f"SELECT {BAR_COLUMNS} FROM bars ORDER BY code, window_start LIMIT 10",
    "stream_ohlcv_update_final": with_(*HOURLY) + f"SELECT {BAR_COLUMNS} FROM bars",
    "stream_ohlcv_append": with_(*HOURLY)
    + f"""SELECT {BAR_COLUMNS} FROM bars
WHERE window_end <= (SELECT max(event_time) - INTERVAL 10 SECOND FROM trades)""",
    "stream_restart": with_(*HOURLY) + f"SELECT {BAR_COLUMNS} FROM bars",
    "stream_late_data": with_(*ON_TIME) + f"SELECT {BAR_COLUMNS} FROM bars",
    "stream_anomaly_log": with_(*DETECTED) + f"SELECT {ANOMALY_COLUMNS} FROM flagged",
    "stream_alerts": with_(*DETECTED)
    + f"SELECT code, window_start, {message()} AS message FROM flagged",
    "stream_prev_close": with_(*HOURLY, priced())
    + """SELECT code, window_start, close, prev_close, round(rate, 6) AS change_rate
FROM priced WHERE prev_close IS NOT NULL""",
    "stream_prev_close_state": with_(*HOURLY, priced())
    + """SELECT code, window_start, close, prev_close, round(rate, 6) AS change_rate
FROM priced WHERE window_end <= (SELECT max(event_time) - INTERVAL 10 SECOND FROM trades)""",
    "stream_open_bars": with_(*HOURLY)
    + f"""SELECT {BAR_COLUMNS} FROM bars
WHERE window_end > (SELECT max(event_time) - INTERVAL 10 SECOND FROM trades)""",
    "stream_late_count": with_(TRADES)
    + """SELECT 3::BIGINT AS runs, count(*) AS ticks, count(*) FILTER (NOT is_late) AS in_bars,
       count(*) FILTER (is_late) AS late
FROM (SELECT *, code = 'error' AND event_time < TIMESTAMP '2024-01-05 00:00:00' AS is_late
      FROM trades)""",
    "stream_json_bars": with_(TRADES, bars("minute")) + f"SELECT {BAR_COLUMNS} FROM bars",
    "stream_quarantine": with_(TRADES, FAULTY)
    + "SELECT event_id, code, outcome AS defect FROM faulty WHERE outcome <> 'ok'",
    "stored_close_series": with_(*HOURLY)
    + f"""SELECT window_start AS time, close AS value, code AS metric FROM bars
WHERE window_start {RANGE} ORDER BY 1, 3""",
    "stored_top50": with_(*VERSIONS)
    + f"""SELECT CASE WHEN f0.code IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE TIMESTAMP '2024-02-02 00:00:00' END AS detected_at,
       COALESCE(f0.code, f1.code) AS code,
       COALESCE(f0.window_start, f1.window_start) AS window_start,
       CASE WHEN f1.code IS NOT NULL THEN f1.close ELSE f0.close END AS close,
       CASE WHEN f0.code IS NOT NULL THEN f0.prev_close ELSE f1.prev_close END AS prev_close,
       CASE WHEN f1.code IS NOT NULL THEN {r2("f1.rate")} ELSE {r2("f0.rate")} END AS change_rate
FROM f0 FULL OUTER JOIN f1 ON {BY_KEY.format("f0", "f1")}
ORDER BY 1 DESC, 3 DESC, 2 LIMIT 50""",
    "stored_threshold_table": with_(*HOURLY, thresholds())
    + f"""SELECT code, {r2("threshold")} AS threshold, {r2("avg_change")} AS avg_change,
       {r2("std_change")} AS std_change, calculated_at FROM thr ORDER BY code""",
    "stream_null_fields": with_(*NULL_FIELDS) + f"SELECT {BAR_COLUMNS} FROM bars",
    "stream_flushed_append": with_(*HOURLY) + f"SELECT {BAR_COLUMNS} FROM bars",
    "stream_trigger_interval": with_(*HOURLY) + f"SELECT {BAR_COLUMNS} FROM bars",
    "stream_replay_log": with_(*DETECTED)
    + f"SELECT {ANOMALY_COLUMNS}, 1::BIGINT AS alerts FROM flagged",
    "console_sink": with_(TRADES) + "SELECT count(*) AS n_messages FROM trades",
}
# The same results by other ways.
SQL["ohlcv_after_compaction"] = SQL["ohlcv_upsert_latest"]
SQL["ohlcv_1d_from_1m"] = SQL["ohlcv_1d"]
SQL["threshold_from_days"] = SQL["anomaly_threshold_7d"]
SQL["closed_close_series"] = SQL["sql_close_series"] = SQL["stored_close_series"]
SQL["sql_volume_series"] = SQL["dashboard_volume_series"]
SQL["sql_anomalies"] = SQL["stored_top50"]
SQL["sql_thresholds"] = SQL["stored_threshold_table"]
SQL["sql_bars"] = SQL["ohlcv_upsert_latest"] + "\nORDER BY code, window_start LIMIT 10"
SQL["sql_log"] = SQL["anomaly_log_upsert"] + "\nORDER BY code, window_start LIMIT 10"
SQL["stream_prev_close_carried"] = SQL["stream_prev_close_state"]
SQL["stream_alert_feed"] = SQL["stream_alerts"]
SQL["stream_1h_from_1m"] = SQL["stream_ohlcv_append"]
