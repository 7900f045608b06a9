"""What one set of new bars does to the store: bars, previous closes, log, alerts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import alert_message, direction
from ..operators import previous_close
from ..operators.anomaly import judge
from ..operators.keyed_table import KeyedTable, read_parquet, version_of
from ..schemas import BAR_COLUMNS, NEWEST, RECENT, TRY
from .store import BAR_KEY, Store

#: Newest detections that are kept at hand; whoever asks for more reads the log.
KEPT_DETECTIONS = 200

#: Bars of a code that are kept at hand. A stream touches only the bars inside its lateness, so
#: with these it never looks into the stored bars.
KEPT = 8

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def store_bars(
    store: Store,
    bars: DataFrame,
    epoch: int,
    batch: int,
    created_at: Column | None = None,
    files_per_day: int | None = None,
    remember: bool = True,
) -> tuple[datetime, datetime] | None:
    """Write bars as version (epoch, batch); return their time range in UTC, None without bars.

    The range is observed while writing, so the bars are computed exactly once. It travels as
    microseconds: a timestamp would come back in the time zone of the Python process. `remember` keeps the recent bars of each code up to date.
    """
    spark = bars.sparkSession
    seen = Observation()
    stamp = created_at if created_at is not None else F.current_timestamp()
    stamped = bars.select(*BAR_COLUMNS, stamp.alias("created_at"))
    micros = F.unix_micros("window_start")

    def watch(rows: DataFrame) -> DataFrame:
        return rows.observe(seen, F.min(micros).alias("first"), F.max(micros).alias("last"))

    store.ohlcv.append(stamped, epoch, batch, files_per_day, watch)
    found = seen.get
    if found["first"] is None:
        return None
    first, last = (EPOCH + timedelta(microseconds=found[k]) for k in ("first", "last"))
    if remember:
        mine = version_of(epoch, batch)
        new = store.ohlcv.version(spark, epoch, batch, first.date(), last.date())
        new = new.select(*BAR_KEY, "close", F.lit(False).alias("logged"))
        held = store.recent.held(spark)
        kept = kept_bars(spark, store, mine, held)
        keep_recent(spark, store, mine, with_new(kept, new), held)
    return first, last


def keep_recent(
    spark: SparkSession, store: Store, mine: int, rows: DataFrame, held: dict[int, int]
) -> None:
    """Store the recent bars as of a version; after a version that comes late, those of them all."""
    newer = [v for v in held.values() if v > mine]
    if newer:
        mine = max(newer)
        rows = rebuilt(spark, store, mine + 1)
    store.recent.write(spark, rows, mine, held)


def kept_bars(spark: SparkSession, store: Store, before: int, held: dict[int, int]) -> DataFrame:
    """The recent bars of each code as they stood before a version."""
    version, rows = store.recent.newest(spark, before, held)
    return rows if version is not None else rebuilt(spark, store, before)


def rebuilt(spark: SparkSession, store: Store, before: int) -> DataFrame:
    """The same from the stored bars: for a store without recent bars, or a version long past."""
    earlier = F.col("version") < before
    table, log = store.ohlcv, store.anomaly_log
    bars = table.merge(table.versions(spark).filter(earlier), ["close"])
    logged = log.versions(spark).filter(earlier).select(*BAR_KEY).distinct()
    marked = bars.join(logged.withColumn("_logged", F.lit(True)), list(BAR_KEY), "left")
    rows = marked.select(*BAR_KEY, "close", F.coalesce("_logged", F.lit(False)).alias("logged"))
    return newest_of(rows.withColumn("first_start", F.col("window_start")))


def with_new(kept: DataFrame, new: DataFrame) -> DataFrame:
    """Recent bars after new ones (code, window_start, close, logged) came in."""
    both = kept.withColumn("_new", F.lit(0)).unionByName(
        new.withColumn("first_start", F.col("window_start")).withColumn("_new", F.lit(1))
    )
    merged = both.groupBy(*BAR_KEY).agg(
        F.max_by("close", "_new").alias("close"),
        F.max("logged").alias("logged"),
        F.min("first_start").alias("first_start"),
    )
    return newest_of(merged)


def newest_of(rows: DataFrame) -> DataFrame:
    """The KEPT newest rows of each code, all with the code's first start.

    The limit is applied before the shuffle as well, so a code's long history stays in its tasks.
    """
    first = rows.groupBy("code").agg(F.min("first_start").alias("first_start"))
    newest = Window.partitionBy("code").orderBy(F.desc("window_start"))
    top = rows.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= KEPT)
    return top.drop("_n", "first_start").join(first, "code").select(*RECENT.fieldNames())


def with_recent_close(rows: DataFrame, store: Store, epoch: int, batch: int) -> DataFrame:
    """The bars of version (epoch, batch) with the close of their latest predecessor in `rows`.

    `rows` are stored versions that include the batch; only the batch's codes are looked at.
    Versions written later are ignored, so that a replay sees what the first try saw.
    """
    mine = version_of(epoch, batch)
    bars = rows.filter(F.col("version") == mine).select(*BAR_COLUMNS)
    known = rows.filter(F.col("version") <= mine)
    codes = bars.select("code").distinct()
    view = store.ohlcv.merge(known.join(codes, "code", "left_semi"), ["close"])
    near = previous_close(view).filter(F.col("version") == mine).select(*BAR_KEY, "prev_close")
    return bars.join(near, list(BAR_KEY), "left")


def with_older_close(
    bars: DataFrame, rows: DataFrame, store: Store, epoch: int, batch: int
) -> DataFrame:
    """Fill a missing prev_close from `rows`, stored versions older than what was read so far.

    At most one bar per code lacks it, the first one in the range read so far; only the codes of
    those bars look through the older rows, each for its newest close.
    """
    seekers = bars.filter(F.col("prev_close").isNull()).select("code").distinct()
    known = rows.filter(F.col("version") <= version_of(epoch, batch))
    newest = (
        store.ohlcv.merge(known.join(seekers, "code", "left_semi"), ["close"])
        .groupBy("code")
        .agg(F.max_by("close", "window_start").alias("_older"))
    )
    return (
        bars.join(newest, "code", "left")
        .withColumn("prev_close", F.coalesce("prev_close", "_older"))
        .drop("_older")
    )


def at_hand(bars: DataFrame, kept: DataFrame) -> DataFrame:
    """New bars with prev_close, was_logged, and `unsure`: whether stored bars must be asked.

    The kept bars are the newest of their code. So a bar later than one of them has its
    predecessor among them and the new bars; a bar of a code without older bars than the kept
    ones has, too. Only a bar that comes later than KEPT newer ones of its code is unsure.
    """
    both = kept.select(*BAR_KEY, "close", F.lit(0).alias("_new")).unionByName(
        bars.select(*BAR_KEY, "close", F.lit(1).alias("_new"))
    )
    view = both.groupBy(*BAR_KEY).agg(
        F.max_by("close", "_new").alias("close"), F.max("_new").alias("_new")
    )
    near = previous_close(view).filter("_new = 1").select(*BAR_KEY, "prev_close")
    oldest = kept.groupBy("code").agg(
        F.min("window_start").alias("_oldest"), F.min("first_start").alias("first_start")
    )
    unsure = (F.col("first_start") < F.col("_oldest")) & (F.col("window_start") <= F.col("_oldest"))
    return (
        bars.join(near, list(BAR_KEY), "left")
        .join(kept.select(*BAR_KEY, F.col("logged").alias("_logged")), list(BAR_KEY), "left")
        .join(oldest, "code", "left")
        .select(
            *BAR_COLUMNS,
            "prev_close",
            F.coalesce("_logged", F.lit(False)).alias("was_logged"),
            F.coalesce(unsure, F.lit(False)).alias("unsure"),
            "first_start",
        )
    )


@contextmanager
def from_stored(
    spark: SparkSession, store: Store, epoch: int, batch: int, unsure: DataFrame
) -> Iterator[DataFrame]:
    """Unsure bars with their prev_close from the stored bars.

    Each step reads as far back again as all steps before it, and only while a bar still lacks its
    predecessor though its code has older bars; so no more than twice the way to it is read.
    """
    found = unsure.agg(F.unix_micros(F.min("window_start")), F.unix_micros(F.max("window_start")))
    first, last = (EPOCH + timedelta(microseconds=m) for m in found.first())
    table, time = store.ohlcv, F.col("window_start")
    back = timedelta(days=1)
    start = first - back
    rows = table.versions(spark, start.date(), last.date()).filter(time.between(start, last))
    rows = rows.join(unsure.select("code").distinct(), "code", "left_semi")
    bars = with_recent_close(rows, store, epoch, batch)
    begins = unsure.select(*BAR_KEY, "was_logged", "unsure", "first_start")
    bars = bars.join(begins, list(BAR_KEY)).persist()
    steps = [bars]
    try:
        while not bars.filter(
            F.col("prev_close").isNull() & (F.col("first_start") < F.lit(start))
        ).isEmpty():
            end, back = start, 2 * back
            start = end - back
            rows = table.versions(spark, start.date(), end.date())
            rows = rows.filter((time >= start) & (time < end))
            bars = with_older_close(bars, rows, store, epoch, batch).persist()
            steps.append(bars)
        yield bars
    finally:
        for step in steps:
            step.unpersist()


def record_anomalies(
    spark: SparkSession,
    store: Store,
    flagged: DataFrame,
    epoch: int,
    batch: int,
    stamp: Column,
    unsure_days: tuple[date, date] | None = None,
) -> None:
    """Log flagged bars and put an alert in the outbox for those not logged before.

    Whether a recent bar was logged is at hand; the log is read only for the days of unsure ones.
    """
    fresh = flagged.filter("NOT was_logged")
    if unsure_days is not None:
        logged = (
            store.anomaly_log.versions(spark, *unsure_days)
            .filter(F.col("version") < version_of(epoch, batch))
            .select(*BAR_KEY)
        )
        fresh = fresh.join(logged, list(BAR_KEY), "left_anti")
    rate = F.col("change_rate")
    alerts = fresh.select(
        *BAR_KEY,
        "close",
        rate,
        direction(rate).alias("direction"),
        alert_message(F.col("code"), F.col("close"), rate).alias("message"),
    )
    out = flagged.select(*BAR_COLUMNS, "prev_close", rate, stamp.alias("detected_at"))
    held = store.newest.held(spark)
    unlisted = not held and store.anomaly_log.exists(spark)
    store.anomaly_log.append(out, epoch, batch)
    store.alerts.append(alerts, epoch, batch)
    detections = fresh.select(*BAR_KEY, stamp.alias("detected_at"))
    keep_detections(spark, store, detections, held, unlisted)


def newest_first(detections: DataFrame, n: int) -> DataFrame:
    """The n newest of (code, window_start, detected_at), in a definite order."""
    return detections.orderBy(F.desc("detected_at"), F.desc("window_start"), "code").limit(n)


def first_detections(log: KeyedTable, versions: DataFrame) -> DataFrame:
    """(code, window_start, detected_at) of all logged bars; the first detection's time stays."""
    return log.merge(versions, ["detected_at"]).select(*NEWEST.fieldNames())


def keep_detections(
    spark: SparkSession, store: Store, fresh: DataFrame, held: dict[int, int], unlisted: bool
) -> None:
    """Put a batch's first detections among the newest ones that are kept at hand.

    The newest of all detections are the newest of those kept and the fresh ones, in whatever order
    batches come, and a repeated batch adds the same rows; so the list is exact. `held` are the
    versions of the list; with `unlisted` there is none yet beside a log, and it is made from that.
    """
    version, kept = store.newest.newest(spark, held=held)
    if unlisted:
        rows = first_detections(store.anomaly_log, store.anomaly_log.versions(spark))
    elif kept is None:
        rows = fresh
    else:
        both = kept.unionByName(fresh).groupBy(*BAR_KEY)
        rows = both.agg(F.min("detected_at").alias("detected_at"))
    number = 0 if version is None else version + 1
    store.newest.write(spark, newest_first(rows, KEPT_DETECTIONS), number, held)


def first_try(
    spark: SparkSession, store: Store, epoch: int, batch: int
) -> tuple[int, Column]:
    """The threshold version and the time stamp of the batch's first try, noted for replays."""
    place, micros = store.tries(epoch, batch), F.unix_micros("stamp").alias("stamp")
    noted = read_parquet(spark, TRY, place).select("thresholds", micros).first()
    if noted is None:
        newest = store.anomaly_threshold.versions(spark).agg(F.max("version")).first()[0]
        now = datetime.now(timezone.utc)
        noted = {
            "thresholds": -1 if newest is None else newest,
            "stamp": (now - EPOCH) // timedelta(microseconds=1),
        }
        row = spark.range(1).select(
            F.lit(noted["thresholds"]).cast("long").alias("thresholds"),
            F.timestamp_micros(F.lit(noted["stamp"])).alias("stamp"),
        )
        row.coalesce(1).write.mode("overwrite").parquet(place)
    return noted["thresholds"], F.timestamp_micros(F.lit(noted["stamp"]))


def apply_bars(
    spark: SparkSession,
    store: Store,
    bars: DataFrame,
    epoch: int,
    batch: int,
    created_at: Column | None = None,
    detected_at: Column | None = None,
    files_per_day: int | None = None,
) -> None:
    """Store new or updated bars, then judge them and record what they show.

    The bars are written first and everything else reads them back, so the incoming plan (often
    a stateful stream) runs once and a lost executor never makes it run again. `spark` is the
    session for the reads; it may differ from the one the bars come from. A replay is judged with
    the thresholds, recent bars and time stamp of the first try, so it writes what that wrote.
    """
    pinned, stamp = first_try(spark, store, epoch, batch)
    found = store_bars(
        store, bars, epoch, batch, created_at if created_at is not None else stamp,
        files_per_day, remember=False,
    )
    if found is None:
        return
    days = (found[0].date(), found[1].date())
    moment = detected_at if detected_at is not None else stamp
    table, mine = store.anomaly_threshold, version_of(epoch, batch)
    thresholds = table.merge(table.versions(spark).filter(F.col("version") <= pinned))
    held = store.recent.held(spark)
    kept = kept_bars(spark, store, mine, held).persist()
    new = store.ohlcv.version(spark, epoch, batch, *days).select(*BAR_COLUMNS)
    verdicts = judge(at_hand(new, kept), thresholds).persist()

    def finish(verdicts: DataFrame, flagged: int, unsure_days: tuple[date, date] | None) -> None:
        if flagged:
            rows = verdicts.filter("is_anomaly")
            record_anomalies(spark, store, rows, epoch, batch, moment, unsure_days)
        logged = (F.col("was_logged") | F.col("is_anomaly")).alias("logged")
        rows = with_new(kept, verdicts.select(*BAR_KEY, "close", logged))
        keep_recent(spark, store, mine, rows, held)

    counts = (F.count_if(F.col(c)).alias(c) for c in ("unsure", "is_anomaly"))
    try:
        unsure, flagged = verdicts.agg(*counts).first()
        if not unsure:
            finish(verdicts, flagged, None)
            return
        columns = [*BAR_COLUMNS, "prev_close", "was_logged"]
        with from_stored(spark, store, epoch, batch, verdicts.filter("unsure")) as asked:
            sure = verdicts.filter("NOT unsure").select(*columns)
            every = judge(sure.unionByName(asked.select(*columns)), thresholds).persist()
            try:
                finish(every, every.filter("is_anomaly").count(), days)
            finally:
                every.unpersist()
    finally:
        verdicts.unpersist()
        kept.unpersist()
