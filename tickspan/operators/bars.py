"""Open/high/low/close/volume bars over tumbling event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BAR_COLUMNS

# Fixed values.
WIDTH = "1 minute"
LATENESS = "10 seconds"


def _order(tie_break: str | None) -> Column:
    """The ordering that picks open and close.

    All aggregation buffers stay fixed-width, so that Spark plans a hash aggregate: a struct
    (time, tie-break) would force a sort of every tick. With a tie-break (any long) time and
    tie-break are packed into one decimal instead.
    Rows without a price get a null ordering, which min_by and max_by skip.
    """
    order = F.col("event_time")
    if tie_break is not None:
        micros = F.unix_micros("event_time").cast("decimal(18,0)")
        shift = F.lit("10000000000000000000").cast("decimal(20,0)")
        least = F.lit("9223372036854775808").cast("decimal(19,0)")
        order = micros * shift + (F.col(tie_break).cast("decimal(19,0)") + least)
    return F.when(F.col("trade_price").isNotNull(), order)


def aggregate_ohlcv(
    ticks: DataFrame,
    width: str = WIDTH,
    lateness: str | None = None,
    tie_break: str | None = None,
) -> DataFrame:
    """Ticks to bars with a nested `window`. Give `lateness` on a stream.

    Ticks without a code or a time belong to no bar (`quality.barless_ticks` has them) and are left
    out; ticks without a price or volume add what they have. Map-side
    partial aggregation shrinks every input split to its distinct (window, code)
    pairs before the one shuffle, so a hot symbol costs no more than another.
    """
    if lateness is not None:
        ticks = ticks.withWatermark("event_time", lateness)
    order = _order(tie_break)
    return ticks.filter(F.col("code").isNotNull()).groupBy(F.window("event_time", width), "code").agg(
        F.min_by("trade_price", order).alias("open"),
        F.max("trade_price").alias("high"),
        F.min("trade_price").alias("low"),
        F.max_by("trade_price", order).alias("close"),
        F.sum("trade_volume").alias("volume"),
        F.count("trade_price").alias("trade_count"),
    )


def flatten_bars(bars: DataFrame) -> DataFrame:
    return bars.select(
        "code",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *BAR_COLUMNS[3:],
    )


def wider_ohlcv(bars: DataFrame, width: str) -> DataFrame:
    """Bars of a finer width to bars with a nested `window`; a fine bar lies in one wide one.

    `bars` are those of `aggregate_ohlcv` (with their nested window: on a stream this is a second
    stateful aggregation, and append mode emits a wide bar once the watermark has passed its end)
    or flat ones. No tick is looked at: the earliest open, the latest close, the highest and the
    lowest price, the sums of volumes and counts are what the ticks would give, ties aside, since
    no two fine bars share a tick. Bars without a price add their volume only.
    """
    if "window" in bars.columns:
        timed = bars.withColumn("_time", F.window_time("window"))
    else:
        timed = bars.withColumn("_time", F.col("window_start"))
    opened = F.when(F.col("open").isNotNull(), F.col("_time"))
    closed = F.when(F.col("close").isNotNull(), F.col("_time"))
    return timed.groupBy(F.window("_time", width), "code").agg(
        F.min_by("open", opened).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", closed).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
    )


def wider_bars(bars: DataFrame, width: str) -> DataFrame:
    """Flat bars to flat bars of a wider width."""
    return flatten_bars(wider_ohlcv(bars, width))


def bars_of(ticks: DataFrame, width: str = WIDTH, tie_break: str | None = None) -> DataFrame:
    return flatten_bars(aggregate_ohlcv(ticks, width, tie_break=tie_break))


def latest_bars(bars: DataFrame) -> DataFrame:
    """The newest bar of each code: one partial aggregation, no sort and no window."""
    others = [c for c in bars.columns if c not in ("code", "window_start")]
    return bars.groupBy("code").agg(
        F.max("window_start").alias("window_start"),
        *(F.max_by(c, "window_start").alias(c) for c in others),
    )
