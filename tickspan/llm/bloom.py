"""A Bloom filter of one fixed size, built in Spark and asked in the tasks.

Whatever the number of keys, tasks get 2 MB. With very many keys it lets more rows pass; as an exact
join follows in every use, results are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import lean

#: Bits of the filter, and bits set for each key: pieces of 24 bits of its 64-bit hash.
BITS = 1 << 24
PIECES = 3
SHIFT = 20


def bloom_words(keys: DataFrame, column: str) -> np.ndarray:
    """The filter of a column of 64-bit hashes; 2**18 words of 64 bits at most are read."""
    pieces = [
        F.shiftrightunsigned(column, SHIFT * k).bitwiseAND(F.lit(BITS - 1)) for k in range(PIECES)
    ]
    found = (
        keys.select(F.explode(F.array(*pieces)).alias("bit"))
        .groupBy(F.shiftrightunsigned("bit", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("bits"))
        .toPandas()
    )
    words = np.zeros(BITS // 64, np.uint64)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return words


class Bloom:
    def __init__(self, words: np.ndarray):
        self.flags = np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for k in range(PIECES):
            bits = (hashes >> np.uint64(SHIFT * k)) & np.uint64(BITS - 1)
            out &= self.flags[bits.astype(np.int64)]
        return out


def may_be_in(hashes: Column, words: np.ndarray) -> Column:
    """Whether the filter may hold a column of 64-bit hashes (not null)."""

    @F.arrow_udf("boolean")
    @lean()
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Bloom(words)
        for batch in batches:
            yield pa.array(known.may_hold(batch.to_numpy(zero_copy_only=False).view(np.uint64)))

    return run(hashes)
