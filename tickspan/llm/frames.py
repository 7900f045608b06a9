"""Helpers that the operators share: settings, text buffers, splits, bounded batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import words

#: Bytes of text that one vectorised step takes at once (a longer text is a step of its own).
STEP_BYTES = 1 << 19
#: Rows of one Arrow batch; Spark bounds its bytes as well.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """The session settings that the operators count on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; a null key counts as the empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the n + 1 bounds between them; null is empty."""
    array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) else "")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int32, len(array) + 1, 4 * array.offset).astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def steps(bounds: np.ndarray, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts that hold `size` bytes at most, or one longer text."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


def texts_of(array: pa.Array) -> Iterator[bytes]:
    """Each text of a string array as UTF-8 bytes, one at a time; null is empty."""
    data, bounds = flat(array)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield data[a:b].tobytes()


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list array from all values in a row and the length of each list."""
    bounds = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, kind))


def lean(*caches: Callable) -> Callable:
    """Decorator of a function of batches: its process keeps nothing of it when a task ends.

    Python processes outlive their tasks and stages. Whatever a stage left in each of them would
    add up over a job of many stages, so the `caches` (and the powers of word hashes) are emptied,
    and memory that is free is given back to the system rather than kept for later.
    """

    def decorator(run: Callable) -> Callable:
        @wraps(run)
        def task(batches: Iterator) -> Iterator:
            try:
                yield from run(batches)
            finally:
                for cache in (words.kept_powers, *caches):
                    cache.cache_clear()
                gc.collect()
                pa.default_memory_pool().release_unused()
                trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
                if trim is not None:
                    trim(0)

        return task

    return decorator
