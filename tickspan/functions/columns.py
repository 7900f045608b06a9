"""Scalar functions, each from Column to Column and evaluated in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DEFAULT_THRESHOLD = 3.0
SIGMAS = 3.0
SEVERITY_LIMIT = 3.0
UP, DOWN = "🚀 급등", "📉 급락"
ALERT_FORMAT = "[이상 탐지] %s\n%s %+.2f%%\n현재가: %s원"


def event_time(millis: Column, precision: str = "millis") -> Column:
    """Epoch milliseconds as a timestamp; precision "second" cuts the fraction off."""
    exact = F.timestamp_millis(millis)
    if precision == "millis":
        return exact
    if precision == "second":
        return F.date_trunc("second", exact)
    raise ValueError(f"precision must be 'millis' or 'second', not {precision!r}")


def percent_change(close: Column, prev: Column) -> Column:
    """Change in percent; null when the previous close is null or zero."""
    return (close - prev) / F.nullif(prev, F.lit(0.0)) * 100


def change_rate(close: Column, prev: Column) -> Column:
    """Change in percent; 0.0 when the previous close is null or zero."""
    unknown = prev.isNull() | (prev == 0)
    return F.when(unknown, F.lit(0.0)).otherwise(percent_change(close, prev))


def is_anomaly(rate: Column, threshold: Column | float = DEFAULT_THRESHOLD) -> Column:
    """|rate| >= threshold. Spark sorts NaN above every number, so it is excluded here."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return ~F.isnan(rate) & (F.abs(rate) >= limit)


def threshold_of(avg_change: Column, std_change: Column, sigmas: float = SIGMAS) -> Column:
    return F.coalesce(avg_change + F.lit(sigmas) * std_change, F.lit(DEFAULT_THRESHOLD))


def round2(value: Column) -> Column:
    """Two decimals, halves away from zero, computed on a decimal."""
    return F.round(value.cast("decimal(38,10)"), 2)


def direction(rate: Column) -> Column:
    return F.when(rate > 0, F.lit(UP)).otherwise(F.lit(DOWN))


def severity(rate: Column, limit: float = SEVERITY_LIMIT) -> Column:
    """Colour by the signed rate: a fall stays green."""
    return F.when(rate >= limit, F.lit("red")).otherwise(F.lit("green"))


def alert_message(code: Column, close: Column, rate: Column) -> Column:
    price = F.format_number(F.round(close.cast("decimal(38,10)"), 0), 0)
    return F.format_string(
        ALERT_FORMAT, code, direction(rate), round2(rate).cast("double"), price
    )
