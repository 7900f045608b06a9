"""A small table of which only the newest version counts, in two folders written in turn."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Slots:
    """A version (a number that grows) replaces the older one of the two folders.

    So a reader finds the version before whole while the next is written, and what is read does
    not grow with the number of versions. Every version holds at least one row.
    """

    path: str
    schema: T.StructType

    def _both(self, spark: SparkSession) -> DataFrame | None:
        extra = [T.StructField("version", T.LongType()), T.StructField("slot", T.IntegerType())]
        reader = spark.read.schema(T.StructType([*self.schema.fields, *extra]))
        try:
            return reader.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def held(self, spark: SparkSession) -> dict[int, int]:
        """The version in each slot."""
        both = self._both(spark)
        if both is None:
            return {}
        rows = both.groupBy("slot").agg(F.max("version").alias("version")).collect()
        return {row["slot"]: row["version"] for row in rows}

    def newest(
        self, spark: SparkSession, before: int | None = None, held: dict[int, int] | None = None
    ) -> tuple[int | None, DataFrame | None]:
        """The newest version, or the newest one below `before`, and its rows; else None twice.

        `held` spares the look at the slots where the caller has just done so.
        """
        held = self.held(spark) if held is None else held
        held = {s: v for s, v in held.items() if before is None or v < before}
        if not held:
            return None, None
        slot = max(held, key=held.get)
        rows = self._both(spark).filter(F.col("slot") == slot)
        return held[slot], rows.select(*self.schema.fieldNames())

    def write(
        self, spark: SparkSession, df: DataFrame, version: int, held: dict[int, int] | None = None
    ) -> None:
        """Write a version beside the newest one below it. Newer versions are given up."""
        held = self.held(spark) if held is None else held
        held = {s: v for s, v in held.items() if v < version}
        slot = 1 - max(held, key=held.get) if held else 0
        out = df.select(*self.schema.fieldNames(), F.lit(version).cast("long").alias("version"))
        out.write.mode("overwrite").parquet(f"{self.path}/slot={slot}")
