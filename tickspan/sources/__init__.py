from .connectors import (
    file_source_options,
    jdbc_options,
    kafka_sink_options,
    kafka_source_options,
    read_jdbc,
    read_messages,
    stream_messages,
    write_messages,
)
from .messages import DEFAULT_SYMBOLS, only_symbols, parse_ticks, pick_fields, to_messages
from .tables import load, ticks_from_events, ticks_from_orders

__all__ = [
    "DEFAULT_SYMBOLS",
    "file_source_options",
    "jdbc_options",
    "kafka_sink_options",
    "kafka_source_options",
    "load",
    "only_symbols",
    "parse_ticks",
    "pick_fields",
    "read_jdbc",
    "read_messages",
    "stream_messages",
    "ticks_from_events",
    "ticks_from_orders",
    "to_messages",
    "write_messages",
]
