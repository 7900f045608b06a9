"""Upserts on Parquet: append a version, read the current view.

Every write goes to its own (epoch, batch) partition, so a repeated micro-batch of the same rows
changes nothing. The current view is one hash aggregation over the keys. Closed days can be merged
beside a running writer, so readers of old days open one set of files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .slots import Slots

BATCH_BITS = 40
#: Bytes of a row group of a merged day: the least that a reader of a part of the day opens.
GROUP_BYTES = 1 << 23


def version_of(epoch: int, batch: int) -> int:
    return (epoch << BATCH_BITS) + batch


def _version() -> Column:
    return F.shiftleft(F.col("epoch"), BATCH_BITS) + F.col("batch")


def read_parquet(
    spark: SparkSession, schema: T.StructType, pattern: str, base: str | None = None
) -> DataFrame:
    """The files that match, no rows where there is none; `base` is the partitions' root."""
    reader = spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class KeyedTable:
    """A table with unique keys.

    replace: columns where the newest version wins; keep: columns where the first one stays.
    day_of: a timestamp key; its day is the leading partition, so reads of a time range list and
    scan only their days. A new checkpoint needs a higher epoch than the table holds (see
    `streaming.epochs`).
    """

    path: str
    schema: T.StructType
    keys: Sequence[str]
    replace: Sequence[str]
    keep: Sequence[str] = ()
    day_of: str | None = None

    def append(
        self,
        df: DataFrame,
        epoch: int,
        batch: int,
        files_per_day: int | None = None,
        watch: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Write df as version (epoch, batch), replacing an earlier try of the same version.

        With adaptive execution the rows are rebalanced, so that big days split and small ones
        share tasks. A micro-batch runs without it: every task writes what it holds, without a
        shuffle, unless `files_per_day` asks for another spread. `watch` may observe the rows as
        they are written.
        """
        out = df.select(
            *self.schema.fieldNames(),
            F.lit(epoch).cast("long").alias("epoch"),
            F.lit(batch).cast("long").alias("batch"),
        )
        folders = ["epoch", "batch"]
        if self.day_of is not None:
            day = F.floor(F.unix_seconds(self.day_of) / 86400).cast("int")  # UTC in any session
            out = out.withColumn("dt", F.date_from_unix_date(day))
            folders = ["dt", *folders]
        spread = [F.col("dt")] if self.day_of is not None else []
        if files_per_day is not None:
            out = out.repartition(*spread, F.pmod(F.hash(*self.keys), F.lit(files_per_day)))
        elif df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            out = out.hint("rebalance", *spread)
        if watch is not None:
            out = watch(out)
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folders)
            .parquet(self.path)
        )

    def _fields(self, *names: str) -> T.StructType:
        """The table's columns and the partition columns named."""
        day = [T.StructField("dt", T.DateType())] if self.day_of is not None else []
        return T.StructType([*self.schema.fields, *day, *(T.StructField(n, T.LongType()) for n in names)])

    @property
    def stored_schema(self) -> T.StructType:
        """The columns of the files as a plain reader of the folder finds them."""
        return self._fields("epoch", "batch")

    def exists(self, spark: SparkSession) -> bool:
        """Whether anything was ever written."""
        try:
            spark.read.schema(self.stored_schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def _days(self, since: date | None, until: date | None) -> str:
        """The folders of the days asked for, as a pattern."""
        if self.day_of is None:
            return ""
        if since is None or until is None:
            return "/dt=*"
        days = [str(since + timedelta(n)) for n in range((until - since).days + 1)]
        return f"/dt={{{','.join(days)}}}"

    def _open(self, spark: SparkSession, since: date | None, until: date | None) -> DataFrame:
        """All versions as they were written."""
        pattern = self.path if since is None or until is None else self.path + self._days(since, until)
        rows = read_parquet(spark, self._fields("epoch", "batch"), pattern, self.path)
        return rows.withColumn("version", _version())

    @property
    def _cuts(self) -> Slots:
        """Up to which day and version days have been merged, and how often."""
        schema = T.StructType(
            [T.StructField("last_day", T.DateType()), T.StructField("merged", T.LongType())]
        )
        return Slots(f"{self.path}-cuts", schema)

    def versions(
        self, spark: SparkSession, since: date | None = None, until: date | None = None
    ) -> DataFrame:
        """The stored versions of the days since..until, with a `version` column.

        Of days that were merged, each key's row carries its newest version, and only later
        versions are read besides. They merge to the same view as all versions would.
        """
        rows = self._open(spark, since, until)
        if self.day_of is not None:
            cut, state = self._cuts.newest(spark)
            if cut is not None:
                mark = state.first()
                later = (F.col("dt") > F.lit(mark["last_day"])) | (F.col("version") > mark["merged"])
                merged = read_parquet(
                    spark,
                    T.StructType([*self._fields().fields, T.StructField("version", T.LongType())]),
                    f"{self.path}-merged/cut=*{self._days(since, until)}",
                    f"{self.path}-merged",
                )
                merged = merged.withColumn(
                    "epoch", F.shiftright("version", BATCH_BITS)
                ).withColumn("batch", F.col("version").bitwiseAND(F.lit((1 << BATCH_BITS) - 1)))
                rows = rows.filter(later).unionByName(merged.select(rows.columns))
        if since is not None:
            rows = rows.filter(F.col("dt") >= F.lit(since))
        if until is not None:
            rows = rows.filter(F.col("dt") <= F.lit(until))
        return rows

    def version(
        self,
        spark: SparkSession,
        epoch: int,
        batch: int,
        since: date | None = None,
        until: date | None = None,
    ) -> DataFrame:
        """The rows that version (epoch, batch) wrote; lists and reads its folders alone."""
        pattern = f"{self.path}{self._days(since, until)}/epoch={epoch}/batch={batch}"
        rows = read_parquet(spark, self._fields("epoch", "batch"), pattern, self.path)
        return rows.select(*self.schema.fieldNames())

    def close_days(self, spark: SparkSession, until: date) -> None:
        """Merge the versions of each day up to `until` into one set of files.

        A writer may go on meanwhile, and write to these days later, too: all versions but the
        newest, which may still be under way or be repeated, are merged, and later ones are read
        besides until the next call merges them. Days without a version since the last call are
        not read again. Old files stay for readers that have listed them.

        A merged day is written in the order of time, in row groups of GROUP_BYTES, so a reader of
        an hour skips the groups of the others by their statistics.
        """
        newest = self._open(spark, None, None).agg(F.max("version")).first()[0]
        if newest is None:
            return
        cut, state = self._cuts.newest(spark)
        merged = newest - 1
        rows = self.versions(spark, None, until).filter(F.col("version") <= merged)
        fresh = self._open(spark, None, None).filter(
            (F.col("dt") <= F.lit(until)) & (F.col("version") <= merged)
        )
        if cut is not None:
            mark = state.first()
            fresh = fresh.filter(
                (F.col("dt") > F.lit(mark["last_day"])) | (F.col("version") > mark["merged"])
            )
            until = max(until, mark["last_day"])
        number = (cut or 0) + 1
        days = fresh.select("dt").distinct()
        day = F.floor(F.unix_seconds(self.day_of) / 86400).cast("int")
        view = self.merge(rows.join(days, "dt", "left_semi")).withColumn(
            "dt", F.date_from_unix_date(day)
        )
        (
            view.hint("rebalance", F.col("dt"))
            .sortWithinPartitions("dt", self.day_of, *self.keys)
            .write.mode("overwrite")
            .option("parquet.block.size", GROUP_BYTES)
            .partitionBy("dt")
            .parquet(f"{self.path}-merged/cut={number}")
        )
        mark = spark.createDataFrame([(until, merged)], self._cuts.schema)
        self._cuts.write(spark, mark, number)

    def merge(self, versions: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """One row per key out of any selection of versions, with its newest `version`."""
        wanted = [c for c in self.schema.fieldNames() if columns is None or c in columns]
        picks = [
            (F.min_by if c in self.keep else F.max_by)(c, "version").alias(c)
            for c in wanted
            if c not in self.keys
        ]
        return (
            versions.groupBy(*self.keys)
            .agg(*picks, F.max("version").alias("version"))
            .select(*dict.fromkeys([*self.keys, *wanted, "version"]))
        )

    def current(
        self, spark: SparkSession, since: date | None = None, until: date | None = None
    ) -> DataFrame:
        """The table as of now; every column in schema order."""
        return self.merge(self.versions(spark, since, until)).select(*self.schema.fieldNames())

    def last_epoch(self, spark: SparkSession) -> int:
        """The highest epoch written so far, 0 for an empty table."""
        row = self.versions(spark).agg(F.max("epoch").alias("e")).first()
        return row["e"] or 0
