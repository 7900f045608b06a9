"""The stored tables under one root folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ..operators import KeyedTable, Slots
from ..operators.moments import DAY_PART
from ..schemas import ALERT, ANOMALY, NEWEST, RECENT, STORED_BAR, THRESHOLD

BAR_KEY = ("code", "window_start")


@dataclass(frozen=True)
class Store:
    root: str

    @property
    def ohlcv(self) -> KeyedTable:
        values = ("window_end", "open", "high", "low", "close", "volume", "trade_count")
        return KeyedTable(
            f"{self.root}/ohlcv", STORED_BAR, BAR_KEY, values, ("created_at",), "window_start"
        )

    @property
    def anomaly_log(self) -> KeyedTable:
        """A flagged bar stays, also when a later version of it calms down."""
        return KeyedTable(
            f"{self.root}/anomaly_log",
            ANOMALY,
            BAR_KEY,
            ("close", "high", "low", "volume", "trade_count", "change_rate"),
            ("window_end", "open", "prev_close", "detected_at"),
            "window_start",
        )

    @property
    def anomaly_threshold(self) -> KeyedTable:
        return KeyedTable(
            f"{self.root}/anomaly_threshold",
            THRESHOLD,
            ("code",),
            ("threshold", "avg_change", "std_change", "calculated_at"),
        )

    @property
    def day_parts(self) -> KeyedTable:
        """Change statistics per code and day, and the newest version of its bars they hold."""
        schema = T.StructType([*DAY_PART.fields, T.StructField("covers", T.LongType())])
        values = [n for n in schema.fieldNames() if n not in ("code", "day_start")]
        return KeyedTable(
            f"{self.root}/day_parts", schema, ("code", "day_start"), values, (), "day_start"
        )

    @property
    def alerts(self) -> KeyedTable:
        """The outbox: one row per bar, from its first detection."""
        return KeyedTable(
            f"{self.root}/alerts",
            ALERT,
            BAR_KEY,
            (),
            ("close", "change_rate", "direction", "message"),
            "window_start",
        )

    @property
    def recent(self) -> Slots:
        """The newest bars of every code: all that a steady stream needs to judge the next ones."""
        return Slots(f"{self.root}/recent", RECENT)

    @property
    def newest(self) -> Slots:
        """The bars detected last: where a reader of the newest anomalies begins."""
        return Slots(f"{self.root}/newest", NEWEST)

    def tries(self, epoch: int, batch: int) -> str:
        """Where a batch notes what its first try was judged with."""
        return f"{self.root}/tries/epoch={epoch}/batch={batch}"

    @property
    def epochs(self) -> str:
        """The epochs that checkpoints have claimed."""
        return f"{self.root}/epochs"
