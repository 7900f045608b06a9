"""Which epoch of the store a checkpoint writes."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed_table import read_parquet
from ..plans.store import Store

CLAIM = T.StructType([T.StructField("epoch", T.LongType()), T.StructField("checkpoint", T.StringType())])


def claim_epoch(
    spark: SparkSession, store: Store, checkpoint: str, epoch: int | None = None
) -> int:
    """The epoch of a checkpoint: the one it has, or for a new checkpoint one above all others.

    A checkpoint counts its batches from 0, so a second one must not write under the epoch of the
    first. The claim is noted in the store and in the checkpoint; asking for an epoch that another
    checkpoint may have written under is an error.
    """
    place = f"{checkpoint}/store_epoch"
    own = read_parquet(spark, CLAIM, place).first()
    if own is not None:
        if epoch not in (None, own["epoch"]):
            raise ValueError(f"this checkpoint writes epoch {own['epoch']}, not {epoch}")
        return own["epoch"]
    claimed = read_parquet(spark, CLAIM, store.epochs).agg(F.max("epoch")).first()[0] or 0
    last = max(claimed, store.ohlcv.last_epoch(spark))
    if epoch is None:
        epoch = last + 1
    elif epoch <= last:
        raise ValueError(f"epoch {epoch} was written by another checkpoint; the next is {last + 1}")
    claim = spark.createDataFrame([(epoch, checkpoint)], CLAIM).coalesce(1)
    claim.write.mode("append").parquet(store.epochs)
    claim.write.mode("overwrite").parquet(place)
    return epoch
