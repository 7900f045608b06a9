"""Final bars with their previous close, kept in the state store by `transformWithState`.

The state of a code is one value, its newest bar's close, and the bars of the running micro-batch
that wait for their turn. Rows are taken one at a time. A code with one new bar, the steady case, is
answered at once. Several bars of a code come in any order: each goes into a map in the state store
and sets a timer at its start; timers fire in time order, behind the rows of the same micro-batch,
so a backfill that closes years of one code never holds its bars in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schemas import BAR, BAR_COLUMNS

PRICED = T.StructType([*BAR.fields, T.StructField("prev_close", T.DoubleType())])
# Times cross to the state as microseconds: a timestamp would depend on the process's time zone.
_MOVED = ("window_start", "window_end")
_WAITING = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name in _MOVED else f.dataType)
        for f in BAR.fields
        if f.name not in ("code", "window_start")
    ]
)
_OUT = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name in _MOVED else f.dataType)
        for f in PRICED.fields
    ]
)
_ROW = Row(*_OUT.fieldNames())


class PreviousClose(StatefulProcessor):
    """Rows of BAR with times in microseconds; each comes out once, with prev_close."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "close double")
        self._waiting = handle.getMapState("waiting", "window_start long", _WAITING)

    def _priced(self, bar: tuple) -> Row:
        """The bar behind the one in the state, whose place it takes."""
        before = self._last.get()
        self._last.update((bar[BAR_COLUMNS.index("close")],))
        return _ROW(*bar, None if before is None else before[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, second = next(rows), next(rows, None)
        over = timerValues.getCurrentWatermarkInMs() * 1000
        if second is None and first["window_end"] <= over and not self._waiting.exists():
            yield self._priced(tuple(first))
            return
        for row in (first, second):
            if row is not None:
                self._wait(row)
        for row in rows:
            self._wait(row)

    def _wait(self, row: Row) -> None:
        start = row["window_start"]
        self._waiting.updateValue((start,), tuple(row[n] for n in _WAITING.fieldNames()))
        self._handle.registerTimer(start // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start = (expiredTimerInfo.getExpiryTimeInMs() * 1000,)
        found = self._waiting.getValue(start)
        self._waiting.removeKey(start)
        yield self._priced((key[0], start[0], *found))

    def close(self) -> None:
        pass


def with_previous_close(final_bars: DataFrame) -> DataFrame:
    """Final bars (append mode) with prev_close, out of the state store.

    prev_close is the close of the code's latest bar before, whatever the gap; the first bar's is
    null. Append mode gives each bar once and in the order of the watermark, so no bar comes
    behind a later one of an earlier micro-batch. Bars start at whole milliseconds. Write the result
    with `start_final_bars`; it needs the RocksDB state store, which `configure` sets.
    """
    moved = final_bars.select(
        *(F.unix_micros(c).alias(c) if c in _MOVED else F.col(c) for c in BAR_COLUMNS)
    )
    priced = moved.groupBy("code").transformWithState(
        statefulProcessor=PreviousClose(),
        outputStructType=_OUT,
        outputMode="Append",
        timeMode="EventTime",
    )
    return priced.select(
        *(F.timestamp_micros(c).alias(c) if c in _MOVED else F.col(c) for c in PRICED.fieldNames())
    )
