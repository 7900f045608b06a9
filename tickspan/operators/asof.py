"""Backward as-of lookups that split a hot key by time.

A window over a whole key would put all rows of one symbol into one task. Here every key is cut
into time buckets: the lookup runs inside a bucket, and the one row that enters a bucket from an
earlier one (its carry) comes from a table with one row per (key, bucket). Only that table is
ordered per key, so a task holds at most one bucket of rows or one row per bucket of history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent_change


def _bucket(column: str, width: str) -> Column:
    return F.date_trunc(width, F.col(column))


def previous_close(bars: DataFrame, bucket: str = "day") -> DataFrame:
    """Add prev_close: the close of the latest bar of the code strictly before this one.

    `bars` holds one row per (code, window_start); `bucket` is a date_trunc unit.
    """
    days = bars.withColumn("_bucket", _bucket("window_start", bucket))
    inside = Window.partitionBy("code", "_bucket").orderBy("window_start")
    across = Window.partitionBy("code").orderBy("_bucket")
    carry = (
        days.groupBy("code", "_bucket")
        .agg(F.max_by("close", "window_start").alias("_last"))
        .select("code", "_bucket", F.lag("_last").over(across).alias("_carry"))
    )
    near = days.withColumn("_n", F.row_number().over(inside)).withColumn(
        "_near", F.lag("close").over(inside)
    )
    entering = F.when(F.col("_n") == 1, F.col("_carry")).otherwise(F.col("_near"))
    return (
        near.join(carry, ["code", "_bucket"], "left")
        .withColumn("prev_close", entering)
        .select(*bars.columns, "prev_close")
    )


def with_percent_change(bars: DataFrame, bucket: str = "day") -> DataFrame:
    """Bars with prev_close and their change in percent (null after a null or zero close)."""
    return previous_close(bars, bucket).withColumn(
        "change_rate", percent_change(F.col("close"), F.col("prev_close"))
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    values: Sequence[str],
    strict: bool = True,
    bucket: str = "hour",
) -> DataFrame:
    """Each left row with `values` of the latest right row of its key before it.

    strict: right time < left time, otherwise <=. Unmatched left rows get nulls. `right` holds
    one row per (by, right_on); a null key matches nothing. Pick `bucket` (a date_trunc unit) so
    that one bucket of the hottest key fits a task; left rows are shuffled once, never multiplied.
    """
    by = list(by)
    right = right.dropna(subset=by)
    probe_side, build_side = (0, 1) if strict else (1, 0)
    probes = left.select(
        *by,
        F.col(left_on).alias("_t"),
        F.lit(probe_side).alias("_side"),
        F.struct(*left.columns).alias("_left"),
        F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("_right"),
    )
    builds = right.select(
        *by,
        F.col(right_on).alias("_t"),
        F.lit(build_side).alias("_side"),
        F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_left"),
        F.struct(*values).alias("_right"),
    )
    both = probes.unionByName(builds).withColumn("_bucket", _bucket("_t", bucket))

    # One row per (key, bucket): its last right row, and what earlier buckets hand over.
    # Buckets that hold probes only are needed too. Both parts are aggregated before the shuffle.
    right_part = right.select(
        *by,
        _bucket(right_on, bucket).alias("_bucket"),
        F.col(right_on).alias("_t"),
        *(F.col(v).alias(f"_v_{v}") for v in values),
    )
    names = [f"_v_{v}" for v in values]
    last = right_part.groupBy(*by, "_bucket").agg(
        F.max("_t").alias("_t"), *(F.max_by(n, "_t").alias(n) for n in names)
    )
    asked = left.select(*by, _bucket(left_on, bucket).alias("_bucket")).distinct()
    across = (
        Window.partitionBy(*by).orderBy("_bucket", "_probe")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    marks = last.select(
        *by, "_bucket", F.lit(1).alias("_probe"), F.struct(*names).alias("_last")
    ).unionByName(
        asked.select(*by, "_bucket", F.lit(0).alias("_probe")), allowMissingColumns=True
    )
    carry = (
        marks.withColumn("_carry", F.last("_last", ignorenulls=True).over(across))
        .filter(F.col("_probe") == 0)
        .select(*by, "_bucket", "_carry")
    )

    inside = (
        Window.partitionBy(*by, "_bucket").orderBy("_t", "_side")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    matched = both.withColumn("_near", F.last("_right", ignorenulls=True).over(inside)).filter(
        F.col("_side") == probe_side
    )
    picked = [
        F.when(F.col("_near").isNotNull(), F.col(f"_near.{v}"))
        .otherwise(F.col(f"_carry._v_{v}"))
        .alias(v)
        for v in values
    ]
    return matched.join(carry, [*by, "_bucket"], "left").select("_left.*", *picked)
