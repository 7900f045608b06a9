"""Readers and writers that differ by configuration alone.

Kafka and JDBC need their connector jars on the cluster; the option builders are plain
dictionaries, so a job can be pointed at files instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

MESSAGE = "key binary, value binary"


def kafka_source_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka stream; `per_trigger` bounds the messages of one micro-batch."""
    paced = {} if per_trigger is None else {"maxOffsetsPerTrigger": str(per_trigger)}
    return paced | {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def file_source_options(per_trigger: int | None = None) -> dict[str, str]:
    """Options of a stream of files; `per_trigger` bounds the files of one micro-batch."""
    return {} if per_trigger is None else {"maxFilesPerTrigger": str(per_trigger)}


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 1,
) -> dict[str, str]:
    """JDBC options. With `split_on` and `bounds` Spark reads the table in parallel ranges."""
    options = {"url": url, "dbtable": table, "user": user, "password": password}
    if split_on and bounds:
        options |= {
            "partitionColumn": split_on,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(splits),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def _as_messages(df: DataFrame, fmt: str) -> DataFrame:
    if fmt == "text":
        return df.select(
            F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
        )
    return df


def read_messages(
    spark: SparkSession, fmt: str, path: str | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """A bounded read of raw messages: "kafka", "parquet"/"orc" with (key, value), or "text"
    with one JSON document per line."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt in ("parquet", "orc"):
        reader = reader.schema(MESSAGE)
    return _as_messages(reader.load(path) if path else reader.load(), fmt)


def stream_messages(
    spark: SparkSession, fmt: str, path: str | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """The streaming form of `read_messages`."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt in ("parquet", "orc"):
        reader = reader.schema(MESSAGE)
    return _as_messages(reader.load(path) if path else reader.load(), fmt)


def write_messages(
    messages: DataFrame, fmt: str, path: str | None = None, options: dict[str, str] | None = None
) -> DataStreamWriter | None:
    """Publish keyed messages: a bounded frame is written, a stream gets a writer to start."""
    if messages.isStreaming:
        writer = messages.writeStream.format(fmt).options(**(options or {}))
        return writer.option("path", path) if path else writer
    writer = messages.write.format(fmt).options(**(options or {}))
    if path:
        writer.mode("append").save(path)
    else:
        writer.save()
    return None
