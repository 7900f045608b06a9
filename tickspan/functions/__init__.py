from .columns import (
    DEFAULT_THRESHOLD,
    alert_message,
    change_rate,
    direction,
    event_time,
    is_anomaly,
    percent_change,
    round2,
    severity,
    threshold_of,
)

__all__ = [
    "DEFAULT_THRESHOLD",
    "alert_message",
    "change_rate",
    "direction",
    "event_time",
    "is_anomaly",
    "percent_change",
    "round2",
    "severity",
    "threshold_of",
]
