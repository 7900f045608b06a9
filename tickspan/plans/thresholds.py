"""The daily job: recompute and store the thresholds."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import day_parts, merged_statistics, recompute_thresholds
from ..operators.anomaly import thresholds_of
from ..operators.keyed_table import BATCH_BITS
from ..operators.moments import DAY_PART
from .reports import utc
from .store import Store

HORIZON_DAYS = 7


def update_thresholds(spark: SparkSession, store: Store, as_of: datetime | None = None) -> None:
    """Upsert thresholds from the bars of the week before as_of (UTC unless it has a zone, default now).

    Reads only that week's day partitions. Codes without statistics keep their row, and a run
    with no bars at all changes nothing. Repeating a run of the same as_of replaces it.
    """
    as_of = as_of or datetime.now(timezone.utc)
    as_of = utc(as_of)
    first_day = (as_of - timedelta(days=HORIZON_DAYS)).date()
    table = store.ohlcv
    rows = table.versions(spark, first_day, as_of.date())
    closes = table.merge(rows, ["close"])
    thresholds = recompute_thresholds(closes, as_of.isoformat(sep=" "), f"{HORIZON_DAYS} days")
    moment = int(as_of.replace(tzinfo=timezone.utc).timestamp())
    store.anomaly_threshold.append(thresholds, 0, moment)


def stale_days(spark: SparkSession, store: Store, since: date, until: date) -> dict[date, int]:
    """Days since..until whose stored bars have a version that their parts don't hold: that version.

    At most a row per day comes to the driver; of the bars only the versions are looked at.
    """
    there = store.ohlcv.versions(spark, since, until).groupBy("dt").agg(
        F.max("version").alias("newest")
    )
    have = store.day_parts.versions(spark, since, until).groupBy("dt").agg(
        F.max("covers").alias("covers")
    )
    known = there.join(have, "dt", "left")
    stale = known.filter(F.col("covers").isNull() | (F.col("newest") > F.col("covers")))
    return {r["dt"]: r["newest"] for r in stale.collect()}


def bars_of_days(spark: SparkSession, store: Store, days: list[date]) -> DataFrame:
    """(code, window_start, close, dt) of the stored bars of some days; opens these days alone."""
    table = store.ohlcv
    rows = [table.versions(spark, d, d) for d in days]
    return table.merge(reduce(DataFrame.unionByName, rows), ["close"])


def summarise_days(spark: SparkSession, store: Store, since: date, until: date) -> list[date]:
    """Bring the day parts of since..until up to date; the days that were read for it.

    A day is read when it has bars that its parts don't hold: once after it is over, and again
    only if bars are added to it later. Repeating a call changes nothing.
    """
    stale = stale_days(spark, store, since, until)
    if not stale:
        return []
    parts = day_parts(bars_of_days(spark, store, sorted(stale)))
    newest = max(stale.values())
    epoch, batch = newest >> BATCH_BITS, newest & ((1 << BATCH_BITS) - 1)
    covers = F.lit(newest).cast("long").alias("covers")
    store.day_parts.append(parts.select("*", covers), epoch, batch)
    return sorted(stale)


def parts_between(
    spark: SparkSession, store: Store, since: datetime, until: datetime
) -> DataFrame:
    """Rows of DAY_PART for the bars in [since, until), which are UTC.

    Whole days come from the stored parts; only the days that an end cuts are read themselves.
    """
    first = since.date() + timedelta(days=since.time() > time.min)
    after = until.date()
    cut = {since.date()} if since.time() > time.min else set()
    cut |= {until.date()} if until.time() > time.min else set()
    names = DAY_PART.fieldNames()
    found = []
    if first < after:
        last = after - timedelta(days=1)
        found.append(store.day_parts.current(spark, first, last).select(*names))
    if cut:
        inside = F.col("window_start")
        begin, end = (F.lit(str(t)).cast("timestamp") for t in (since, until))
        bars = bars_of_days(spark, store, sorted(cut)).filter((inside >= begin) & (inside < end))
        found.append(day_parts(bars).select(*names))
    if not found:
        return spark.createDataFrame([], DAY_PART)
    return reduce(DataFrame.unionByName, found)


def update_thresholds_from_days(
    spark: SparkSession, store: Store, as_of: datetime | None = None
) -> list[date]:
    """`update_thresholds` without reading the week again; the days whose bars were summarised.

    At midnight one new day is read and summarised; the other six are their stored parts. At
    another time the two days that the horizon cuts are read as well. The first bar of the horizon
    stays without predecessor. The thresholds are those of `update_thresholds`, up to rounding.
    """
    as_of = utc(as_of or datetime.now(timezone.utc))
    since = as_of - timedelta(days=HORIZON_DAYS)
    first = since.date() + timedelta(days=since.time() > time.min)
    read = summarise_days(spark, store, first, as_of.date() - timedelta(days=1))
    parts = parts_between(spark, store, since, as_of)
    moment = as_of.isoformat(sep=" ")
    thresholds = thresholds_of(merged_statistics(parts), moment)
    version = int(as_of.replace(tzinfo=timezone.utc).timestamp())
    store.anomaly_threshold.append(thresholds, 0, version)
    return read
