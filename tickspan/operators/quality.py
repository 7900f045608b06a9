"""Table constraints as data-quality operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MAX_CODE_LENGTH


def bar_defect() -> Column:
    """Why a parsed tick belongs to no bar, or null when it does. Bars leave out nothing else."""
    return F.when(F.col("code").isNull(), "code missing").when(
        F.col("event_time").isNull(), "time missing"
    )


def barless_ticks(ticks: DataFrame) -> DataFrame:
    """The ticks that no bar holds, in batch and on streams, with the reason."""
    return ticks.withColumn("defect", bar_defect()).filter(F.col("defect").isNotNull())


def tick_defect() -> Column:
    """What the tick table's constraints object to, or null. A tick with a defect may be in a bar."""
    return (
        F.when(F.col("code").isNull(), "code missing")
        .when(F.length("code") > MAX_CODE_LENGTH, "code too long")
        .when(F.col("event_time").isNull(), "time missing")
        .when(F.col("trade_price").isNull(), "price missing")
        .when(F.col("trade_volume").isNull(), "volume missing")
    )


def valid_ticks(ticks: DataFrame) -> DataFrame:
    return ticks.filter(tick_defect().isNull())


def quarantined_ticks(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("defect", tick_defect()).filter(F.col("defect").isNotNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
