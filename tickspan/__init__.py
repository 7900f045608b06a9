"""Tick analytics on Spark: bars, previous closes, thresholds, anomalies, alerts."""

__version__ = "0.1.0"
