"""The dashboard's queries over stored tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import round2, severity
from .detection import KEPT_DETECTIONS, first_detections, newest_first
from .store import BAR_KEY, Store

TOP_ANOMALIES = 50
DEFAULT_RANGE = timedelta(hours=1)


def in_range(bars: DataFrame, since: str, until: str) -> DataFrame:
    """Both ends included."""
    start, end = (F.lit(t).cast("timestamp") for t in (since, until))
    return bars.filter(F.col("window_start").between(start, end))


def last_range(bars: DataFrame, now: datetime, span: timedelta = DEFAULT_RANGE) -> DataFrame:
    return in_range(bars, str(now - span), str(now))


def series(bars: DataFrame, column: str, since: str, until: str) -> DataFrame:
    """(time, value, metric) of one bar column, in time order."""
    return (
        in_range(bars, since, until)
        .select(
            F.col("window_start").alias("time"),
            F.col(column).alias("value"),
            F.col("code").alias("metric"),
        )
        .orderBy("time", "metric")
    )


def utc(moment: datetime) -> datetime:
    """The same moment in UTC, without a zone; a moment without one is UTC already."""
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def stored_series(
    spark: SparkSession, store: Store, column: str, since: datetime, until: datetime
) -> DataFrame:
    """The same over the stored bars; lists and reads the days of the range alone.

    The range reaches the scan: rows are cut before their versions are merged.
    """
    since, until = utc(since), utc(until)
    rows = in_range(store.ohlcv.versions(spark, since.date(), until.date()), str(since), str(until))
    return series(store.ohlcv.merge(rows, [column]), column, str(since), str(until))


def stored_anomalies(spark: SparkSession, store: Store, n: int = TOP_ANOMALIES) -> DataFrame:
    """The n anomalies detected last, out of the stored log.

    A logged bar keeps the time of its first detection, so the newest first detections, which are
    kept at hand, name the bars. Only the days of these bars are opened in the log, however long
    it is. For more than KEPT_DETECTIONS the first detections come from the log itself.
    """
    table = store.anomaly_log
    version, kept = store.newest.newest(spark) if 0 < n <= KEPT_DETECTIONS else (None, None)
    if version is None:
        rows = table.versions(spark)
        wanted = newest_first(first_detections(table, rows), n)
    else:
        wanted = newest_first(kept, n)
        day = F.date_from_unix_date(F.floor(F.unix_seconds("window_start") / 86400).cast("int"))
        days = [r["day"] for r in wanted.select(day.alias("day")).distinct().collect()]
        rows = table.versions(spark, min(days), max(days)).filter(F.col("dt").isin(days))
    chosen = rows.join(wanted.select(*BAR_KEY), list(BAR_KEY), "left_semi")
    return newest_anomalies(table.merge(chosen), n)


def newest_anomalies(log: DataFrame, n: int = TOP_ANOMALIES) -> DataFrame:
    """The n anomalies detected last; bars of one batch share detected_at, so ties are ordered."""
    return (
        log.select(
            "detected_at",
            "code",
            "window_start",
            "close",
            "prev_close",
            round2(F.col("change_rate")).alias("change_rate"),
        )
        .orderBy(F.desc("detected_at"), F.desc("window_start"), "code")
        .limit(n)
    )


def anomalies_by_bar(log: DataFrame, n: int = TOP_ANOMALIES) -> DataFrame:
    return newest_anomalies(log, n).orderBy(F.desc("window_start"), "code")


def with_severity(anomalies: DataFrame) -> DataFrame:
    return anomalies.withColumn("severity", severity(F.col("change_rate")))


def threshold_list(thresholds: DataFrame) -> DataFrame:
    return thresholds.select(
        "code",
        *(round2(F.col(c)).alias(c) for c in ("threshold", "avg_change", "std_change")),
        "calculated_at",
    ).orderBy("code")


def preview(bars: DataFrame, n: int = 10) -> DataFrame:
    return bars.orderBy("code", "window_start").limit(n)


# ---- SQL over the stored tables ----------------------------------------------------------------

#: The dashboard's panels and the previews as SQL over the views of `create_views`.
PANELS = {
    "close": """
        SELECT window_start AS time, close AS value, code AS metric FROM ohlcv
        WHERE window_start BETWEEN CAST(:since AS TIMESTAMP) AND CAST(:until AS TIMESTAMP)
        ORDER BY time, metric""",
    "volume": """
        SELECT window_start AS time, volume AS value, code AS metric FROM ohlcv
        WHERE window_start BETWEEN CAST(:since AS TIMESTAMP) AND CAST(:until AS TIMESTAMP)
        ORDER BY time, metric""",
    "anomalies": """
        SELECT detected_at, code, window_start, close, prev_close,
               round(CAST(change_rate AS DECIMAL(38, 10)), 2) AS change_rate
        FROM newest_anomalies ORDER BY detected_at DESC, window_start DESC, code LIMIT 50""",
    "thresholds": """
        SELECT code, round(CAST(threshold AS DECIMAL(38, 10)), 2) AS threshold,
               round(CAST(avg_change AS DECIMAL(38, 10)), 2) AS avg_change,
               round(CAST(std_change AS DECIMAL(38, 10)), 2) AS std_change, calculated_at
        FROM anomaly_threshold ORDER BY code""",
    "bars": "SELECT * FROM ohlcv ORDER BY code, window_start LIMIT 10",
    "log": "SELECT * FROM anomaly_log ORDER BY code, window_start LIMIT 10",
}


def create_views(
    spark: SparkSession, store: Store, since: datetime | None = None, until: datetime | None = None
) -> list[str]:
    """The stored tables as temporary views for SQL; the names of the views.

    ohlcv, anomaly_log, alerts and anomaly_threshold are the tables as they stand when a query over
    the view is planned: files written later need the views made anew. With since and until (UTC
    unless zoned) the first three hold the bars that start between them, and only their days are
    listed and opened; a condition on window_start inside the query reaches the scan as well.
    newest_anomalies holds the newest detections that are kept at hand, whatever their days.
    """
    days = [None if t is None else utc(t).date() for t in (since, until)]
    views = {name: getattr(store, name) for name in ("ohlcv", "anomaly_log", "alerts")}
    for name, table in views.items():
        rows = table.versions(spark, *days)
        if since is not None:
            rows = rows.filter(F.col("window_start") >= F.lit(str(utc(since))).cast("timestamp"))
        if until is not None:
            rows = rows.filter(F.col("window_start") <= F.lit(str(utc(until))).cast("timestamp"))
        table.merge(rows).select(*table.schema.fieldNames()).createOrReplaceTempView(name)
    store.anomaly_threshold.current(spark).createOrReplaceTempView("anomaly_threshold")
    newest = stored_anomalies(spark, store, KEPT_DETECTIONS)
    newest.createOrReplaceTempView("newest_anomalies")
    return [*views, "anomaly_threshold", "newest_anomalies"]


def panel(
    spark: SparkSession,
    store: Store,
    name: str,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """One of PANELS over the store as it is now; the first two need a range."""
    create_views(spark, store, since, until)
    given = {"since": since, "until": until}
    arguments = {k: str(utc(t)) for k, t in given.items() if f":{k}" in PANELS[name]}
    return spark.sql(PANELS[name], args=arguments)
