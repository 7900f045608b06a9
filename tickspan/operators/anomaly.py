"""Thresholds learned from past changes, and the test of bars against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    DEFAULT_THRESHOLD,
    change_rate,
    is_anomaly,
    threshold_of,
)
from .asof import previous_close, with_percent_change

# Fixed value.
HORIZON = "7 days"


def _moment(as_of: str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def recent(bars: DataFrame, as_of: str | Column | None = None, horizon: str = HORIZON) -> DataFrame:
    """Bars that start inside [as_of - horizon, as_of)."""
    end = _moment(as_of)
    start = end - F.expr(f"interval {horizon}")
    return bars.filter((F.col("window_start") >= start) & (F.col("window_start") < end))


def change_statistics(bars: DataFrame) -> DataFrame:
    """Mean and sample deviation of the absolute change per code.

    The first of the given bars has no predecessor and a change after a zero close is unknown;
    both are left out. A single change gives a null deviation.
    """
    size = F.abs("change_rate")
    return (
        with_percent_change(bars.select("code", "window_start", "close"))
        .filter(F.col("change_rate").isNotNull())
        .groupBy("code")
        .agg(F.avg(size).alias("avg_change"), F.stddev_samp(size).alias("std_change"))
    )


def recompute_thresholds(
    bars: DataFrame, as_of: str | Column | None = None, horizon: str = HORIZON
) -> DataFrame:
    """Threshold per code = mean + 3 deviations of the changes over the horizon before as_of."""
    return thresholds_of(change_statistics(recent(bars, as_of, horizon)), as_of)


def thresholds_of(statistics: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Rows of the threshold table from (code, avg_change, std_change)."""
    return statistics.select(
        "code",
        threshold_of(F.col("avg_change"), F.col("std_change")).alias("threshold"),
        "avg_change",
        "std_change",
        _moment(as_of).alias("calculated_at"),
    )


def with_threshold(bars: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Bars with the threshold of their code, or the default where none is stored.

    There is no broadcast hint: Spark broadcasts the thresholds when their size, known from the
    files or measured at run time, is below its limit, and otherwise merges and splits a
    skewed code.
    """
    known = thresholds.select("code", F.col("threshold").alias("_threshold"))
    return (
        bars.join(known, "code", "left")
        .withColumn("threshold", F.coalesce("_threshold", F.lit(DEFAULT_THRESHOLD)))
        .drop("_threshold")
    )


def judge(bars: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Bars that carry prev_close, with change_rate, threshold and the anomaly flag.

    A bar without predecessor has rate 0.0 and is never flagged, even at threshold 0.
    """
    rate = change_rate(F.col("close"), F.col("prev_close"))
    flagged = is_anomaly(F.col("change_rate"), F.col("threshold")) & F.col("prev_close").isNotNull()
    return with_threshold(bars.withColumn("change_rate", rate), thresholds).withColumn(
        "is_anomaly", flagged
    )


def detect(bars: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The anomalous ones among final bars.

    Give bars that are a stored table (see `as_table`): they are read more than once here.
    """
    return judge(previous_close(bars), thresholds).filter("is_anomaly").drop("is_anomaly")
