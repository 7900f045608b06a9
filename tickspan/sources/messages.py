"""Tick messages: JSON text in a binary value, keyed by the symbol's bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import event_time
from ..schemas import TICK

# The subscribed symbols.
DEFAULT_SYMBOLS = ("KRW-BTC", "KRW-ETH", "KRW-XRP", "KRW-SOL", "KRW-DOGE", "KRW-ADA")


def parse_ticks(
    messages: DataFrame, precision: str = "millis", keep: Sequence[str] = ()
) -> DataFrame:
    """(key, value) messages to ticks with an event time.

    Text that is no JSON object gives an all-null tick, a field of a wrong type gives null in
    that field only. `keep` names message columns (an offset, an id) to carry along.

    The struct is unnested by `inline` rather than "tick.*": filters on its fields then stay
    above the parsing, instead of being pushed below it with one more parse per field they use.
    """
    tick = F.from_json(F.col("value").cast("string"), TICK)
    parsed = messages.select(*keep, F.inline(F.array(tick)))
    return parsed.withColumn("event_time", event_time(F.col("timestamp"), precision))


def to_messages(ticks: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Ticks to keyed JSON messages. A missing field is written as an explicit null."""
    body = F.to_json(F.struct(*TICK.fieldNames()), {"ignoreNullFields": "false"})
    return ticks.select(
        *keep,
        F.encode(F.col("code"), "UTF-8").alias("key"),
        F.encode(body, "UTF-8").alias("value"),
    )


def pick_fields(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Any raw JSON feed to keyed messages holding the five tick fields alone."""
    return to_messages(parse_ticks(raw, keep=keep), keep=keep)


def only_symbols(ticks: DataFrame, symbols: Sequence[str] | DataFrame = DEFAULT_SYMBOLS) -> DataFrame:
    """Keep the listed symbols. A list becomes a pushed-down IN, a table a left-semi join."""
    if isinstance(symbols, DataFrame):
        return ticks.join(symbols.select("code"), "code", "left_semi")
    return ticks.filter(F.col("code").isin(list(symbols)))
