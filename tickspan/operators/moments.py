"""Change statistics out of mergeable parts, one per code and day.

A part holds the moments of the absolute changes inside its day (how many, their mean, the sum of
squares around it) and the day's first and last close. What a week needs besides its parts are the
changes across midnight, from one day's last close to the next one's first: one row per code and
day. So a day is read once, when it is over, and never again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import percent_change

DAY_PART = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("day_start", T.TimestampType()),
        T.StructField("changes", T.LongType()),
        T.StructField("mean", T.DoubleType()),  # null without a change
        T.StructField("squares", T.DoubleType()),
        T.StructField("first_close", T.DoubleType()),
        T.StructField("last_close", T.DoubleType()),
    ]
)


def day_parts(bars: DataFrame) -> DataFrame:
    """Rows of DAY_PART from bars (code, window_start, close); days are those of UTC.

    A day's first bar has no predecessor here; a change after a zero or null close is unknown and
    left out, as in `change_statistics`. A task orders one day of one code at a time.
    """
    seconds = F.floor(F.unix_seconds("window_start") / 86400) * 86400
    days = bars.withColumn("day_start", F.timestamp_seconds(seconds))
    inside = Window.partitionBy("code", "day_start").orderBy("window_start")
    change = percent_change(F.col("close"), F.lag("close").over(inside))
    size = F.abs("_change")
    return (
        days.withColumn("_change", change)
        .groupBy("code", "day_start")
        .agg(
            F.count("_change").alias("changes"),
            F.avg(size).alias("mean"),
            (F.var_pop(size) * F.count("_change")).alias("squares"),
            F.min_by("close", "window_start").alias("first_close"),
            F.max_by("close", "window_start").alias("last_close"),
        )
        .select(*DAY_PART.fieldNames())
    )


def merged_statistics(parts: DataFrame) -> DataFrame:
    """(code, avg_change, std_change) of all changes inside the parts' days and between them.

    `parts` are rows of DAY_PART, one per code and span of time; spans may be cut at any moment, as
    long as `day_start` orders them. The first bar of all has no predecessor. Equal to
    `change_statistics` of the bars, up to rounding. Codes without a known change are left out.
    """
    in_order = Window.partitionBy("code").orderBy("day_start")
    between = percent_change(F.col("first_close"), F.lag("last_close").over(in_order))
    spans = parts.withColumn("_between", F.abs(between))
    both = F.explode(
        F.array(
            F.struct("changes", "mean", "squares"),
            F.struct(
                F.lit(1).cast("long").alias("changes"),
                F.col("_between").alias("mean"),
                F.lit(0.0).alias("squares"),
            ),
        )
    )
    rows = spans.select("code", both.alias("p")).select("code", "p.*")
    rows = rows.filter((F.col("changes") > 0) & F.col("mean").isNotNull())
    whole = Window.partitionBy("code")
    total = F.sum(F.col("changes") * F.col("mean")).over(whole) / F.sum("changes").over(whole)
    rows = rows.withColumn("_mean", total)
    # squares around the common mean: those around the own one, and the own one's distance to it
    moved = F.col("squares") + F.col("changes") * F.pow(F.col("mean") - F.col("_mean"), 2)
    return (
        rows.groupBy("code")
        .agg(
            F.first("_mean").alias("avg_change"),
            F.sum(moved).alias("_squares"),
            F.sum("changes").alias("_n"),
        )
        .select(
            "code",
            "avg_change",
            F.when(F.col("_n") > 1, F.sqrt(F.col("_squares") / (F.col("_n") - 1))).alias(
                "std_change"
            ),
        )
    )
