"""Options of connectors whose jars or servers are absent here."""

from tickspan.sources import jdbc_options, kafka_sink_options, kafka_source_options


def test_kafka_source():
    assert kafka_source_options("a:1,b:2", "ticks") == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "ticks",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert kafka_source_options("a:1", "t", "earliest", True)["failOnDataLoss"] == "true"


def test_kafka_sink():
    assert kafka_sink_options("a:1", "t") == {"kafka.bootstrap.servers": "a:1", "topic": "t"}


def test_jdbc_reads_in_parallel_ranges_when_told_how():
    plain = jdbc_options("jdbc:x", "ohlcv", "u", "p")
    assert plain == {"url": "jdbc:x", "dbtable": "ohlcv", "user": "u", "password": "p"}
    split = jdbc_options("jdbc:x", "ohlcv", "u", "p", "window_start", ("a", "b"), 32)
    assert split["partitionColumn"] == "window_start"
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("a", "b", "32")
