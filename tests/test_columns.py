"""Scalar functions, including their null, zero and NaN cases."""

import pytest
from pyspark.sql import functions as F

from tickspan.functions import (
    alert_message,
    change_rate,
    event_time,
    is_anomaly,
    percent_change,
    round2,
    severity,
    threshold_of,
)


def value(spark, function, row=(None, None)):
    """Apply a function of two columns to one row of doubles."""
    frame = spark.createDataFrame([row], "a double, b double")
    return frame.select(function(F.col("a"), F.col("b")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "close, prev, expected",
    [
        (11000.0, 10000.0, 10.0),
        (9000.0, 10000.0, -10.0),
        (10000.0, 10000.0, 0.0),
        (10000.0, None, 0.0),
        (10000.0, 0.0, 0.0),
        (150000.0, 100000.0, 50.0),
    ],
)
def test_change_rate(spark, close, prev, expected):
    assert value(spark, change_rate, row=(close, prev)) == pytest.approx(expected)


@pytest.mark.parametrize("prev, expected", [(0.0, None), (None, None), (4.0, 25.0)])
def test_percent_change_is_null_without_a_base(spark, prev, expected):
    assert value(spark, percent_change, row=(5.0, prev)) == expected


@pytest.mark.parametrize(
    "rate, threshold, expected",
    [
        (5.0, 3.0, True),
        (2.0, 3.0, False),
        (3.0, 3.0, True),
        (-5.0, 3.0, True),
        (-1.0, 3.0, False),
        (0.0, 0.0, True),
        (float("nan"), 3.0, False),
    ],
)
def test_is_anomaly(spark, rate, threshold, expected):
    assert value(spark, is_anomaly, row=(rate, threshold)) is expected


@pytest.mark.parametrize("rate, expected", [(4.0, True), (2.0, False)])
def test_is_anomaly_default(spark, rate, expected):
    assert value(spark, lambda a, b: is_anomaly(a), row=(rate, None)) is expected


@pytest.mark.parametrize(
    "avg, std, expected", [(10.0, 0.0, 10.0), (1.0, 2.0, 7.0), (10.0, None, 3.0), (None, None, 3.0)]
)
def test_threshold_of(spark, avg, std, expected):
    assert value(spark, threshold_of, row=(avg, std)) == expected


@pytest.mark.parametrize("rate, expected", [(2.99, "green"), (3.0, "red"), (-40.0, "green")])
def test_severity_uses_the_signed_rate(spark, rate, expected):
    assert value(spark, lambda a, b: severity(a), row=(rate, None)) == expected


@pytest.mark.parametrize("x, expected", [(0.125, "0.13"), (-0.125, "-0.13"), (1.0, "1.00")])
def test_round2(spark, x, expected):
    assert str(value(spark, lambda a, b: round2(a), row=(x, None))) == expected


@pytest.mark.parametrize(
    "precision, expected", [("millis", "2024-01-01 00:00:07.999"), ("second", "2024-01-01 00:00:07")]
)
def test_event_time(spark, precision, expected):
    found = value(spark, lambda a, b: event_time(F.lit(1704067207999), precision).cast("string"))
    assert found == expected


def test_event_time_rejects_other_precisions(spark):
    with pytest.raises(ValueError):
        event_time(F.lit(0), "hour")


def test_alert_message(spark):
    def text(close, rate):
        return alert_message(F.lit("X-1"), close, rate)

    assert value(spark, text, (1234567.0, 5.25)) == (
        "[이상 탐지] X-1\n🚀 급등 +5.25%\n현재가: 1,234,567원"
    )
    assert value(spark, text, (99.0, -3.5)) == "[이상 탐지] X-1\n📉 급락 -3.50%\n현재가: 99원"
