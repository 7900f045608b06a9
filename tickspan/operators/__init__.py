from .anomaly import change_statistics, detect, recompute_thresholds, with_threshold
from .asof import asof_join, previous_close
from .bars import aggregate_ohlcv, bars_of, flatten_bars, latest_bars, wider_bars, wider_ohlcv
from .keyed_table import KeyedTable
from .moments import day_parts, merged_statistics
from .quality import barless_ticks, duplicate_keys, tick_defect, valid_ticks
from .slots import Slots

__all__ = [
    "KeyedTable",
    "Slots",
    "aggregate_ohlcv",
    "asof_join",
    "barless_ticks",
    "bars_of",
    "change_statistics",
    "day_parts",
    "detect",
    "duplicate_keys",
    "flatten_bars",
    "latest_bars",
    "merged_statistics",
    "previous_close",
    "recompute_thresholds",
    "tick_defect",
    "valid_ticks",
    "wider_bars",
    "wider_ohlcv",
    "with_threshold",
]
