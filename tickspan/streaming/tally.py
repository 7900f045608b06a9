"""Counts over the whole life of streaming queries, added up as their progress is reported.

A query keeps the progress of its newest hundred micro-batches only. A listener hears of every one,
so it adds up what came in, what came too late, and what `counted` observed, one row of totals per
run of a query, in a table that all runs share.
"""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.keyed_table import read_parquet

COUNTED = "counted_ticks"
COUNTS = ("batches", "rows", "ticks", "dropped")
TOTALS = T.StructType(
    [T.StructField("query", T.StringType()), T.StructField("run", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in COUNTS]
)


def counted(ticks: DataFrame) -> DataFrame:
    """The same ticks; those that a bar counts (with code, time and price) are observed on the way."""
    whole = F.col("code").isNotNull() & F.col("event_time").isNotNull()
    ticks_in = F.count_if(whole & F.col("trade_price").isNotNull())
    return ticks.observe(COUNTED, ticks_in.alias("ticks"))


class Tally(StreamingQueryListener):
    """Totals per run: micro-batches; rows read; ticks observed by `counted`; rows dropped as late.

    Spark counts a dropped row after partial aggregation, so `dropped` counts partial bars; the
    exact number of late ticks is `ticks` less the trade counts of the bars. A micro-batch is
    reported when it has been committed, so one that is repeated after a failure counts once.
    Add it with `spark.streams.addListener` before the queries start.
    """

    def __init__(self) -> None:
        self._totals: dict[tuple[str, str], Counter] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._totals.setdefault((str(event.id), str(event.runId)), Counter())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics.get(COUNTED)
        with self._lock:
            total = self._totals.setdefault((str(progress.id), str(progress.runId)), Counter())
            total["batches"] += 1
            total["rows"] += progress.numInputRows
            total["ticks"] += (observed["ticks"] or 0) if observed is not None else 0
            total["dropped"] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until all of a query that has ended was reported; reports come behind its end."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"run {query.runId} was not reported to have ended")

    def totals(self, query: StreamingQuery) -> dict[str, int]:
        """What was counted in all runs of a query that this listener has heard of."""
        with self._lock:
            found = [t for (name, _), t in self._totals.items() if name == str(query.id)]
        return {c: sum(t[c] for t in found) for c in COUNTS}

    def write(self, spark: SparkSession, path: str) -> None:
        """Write the totals of the runs heard of; a row replaces what was written for its run."""
        with self._lock:
            rows = [(*run, *(t[c] for c in COUNTS)) for run, t in self._totals.items()]
        if rows:
            frame = spark.createDataFrame(rows, TOTALS).coalesce(1)
            writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("query", "run").parquet(path)


def tallied(spark: SparkSession, path: str) -> DataFrame:
    """(query, runs, batches, rows, ticks, dropped) of all runs that were written."""
    rows = read_parquet(spark, TOTALS, path)
    sums = (F.sum(c).alias(c) for c in COUNTS)
    return rows.groupBy("query").agg(F.count("run").alias("runs"), *sums)
