"""Schemas of ticks, bars and the stored tables."""

from pyspark.sql import types as T

# Field names and types of the tick message.
TICK = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("trade_price", T.DoubleType()),
        T.StructField("trade_volume", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),  # epoch milliseconds
        T.StructField("ask_bid", T.StringType()),
    ]
)

# Columns of the three stored tables.
BAR = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("trade_count", T.LongType()),
    ]
)
STORED_BAR = T.StructType(BAR.fields + [T.StructField("created_at", T.TimestampType())])
ANOMALY = T.StructType(
    BAR.fields
    + [
        T.StructField("prev_close", T.DoubleType()),
        T.StructField("change_rate", T.DoubleType()),
        T.StructField("detected_at", T.TimestampType()),
    ]
)
THRESHOLD = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("avg_change", T.DoubleType()),
        T.StructField("std_change", T.DoubleType()),  # null when only one change is known
        T.StructField("calculated_at", T.TimestampType()),
    ]
)
ALERT = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("change_rate", T.DoubleType()),
        T.StructField("direction", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

# The newest bars of each code, and when its first bar of all started.
RECENT = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("logged", T.BooleanType()),
        T.StructField("first_start", T.TimestampType()),
    ]
)
# The bars whose first detection is newest.
NEWEST = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("detected_at", T.TimestampType()),
    ]
)
# What the first try of a batch was judged with.
TRY = T.StructType(
    [
        T.StructField("thresholds", T.LongType()),
        T.StructField("stamp", T.TimestampType()),
    ]
)

BAR_COLUMNS = BAR.fieldNames()
MAX_CODE_LENGTH = 20
