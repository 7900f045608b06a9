"""How filters of a corpus interact: what each removes in every order they can be applied in.

A document's mask says which filters it fails. In a given order it is removed by the first filter
of its mask, so what happens to it hangs on the mask alone, and documents are counted by (part,
mask) before anything else: 2^k rows a part, whatever the corpus.

Orders are numbered by their Lehmer codes, that is lexicographically. For a mask, being removed at
step s by filter f means that the order begins with s - 1 filters outside the mask and f; all orders
with one beginning have ranks in one interval. So a mask adds its counts at the beginning of each
of its intervals and takes them off at the end, in one array of differences per step, and a prefix
sum over the ranks gives every order's totals.

Copies need no look-up of their first document: text decides the other filters, so rows are counted
by (digest, marks), with the smallest id of each, and the copies are the rest.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Up to this many filters the orders of one part are worked out in memory (7! = 5,040 orders).
FILTERS = 7
#: Groups that the rows of a null key are spread over.
SPREAD = 1024
BLANKS = r"[\x20\x09-\x0D]+"


def text_filters(text: Column, blanks: str = BLANKS) -> dict[str, Column]:
    """Failure conditions A to D of a text: short, repetitive, loud, marked up."""
    words = F.array_remove(F.split(text, blanks), "")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def marked(
    docs: DataFrame,
    filters: Mapping[str, Column],
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """(key, digest, part, mask): bit i of a mask is set if filter i fails; null parts are empty.

    `filters` are conditions on the column `text` with nulls made empty; a null outcome passes.
    """
    filled = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters.values())]
    return filled.select(
        "key", F.unhex(F.sha2("text", 256)).alias("digest"), "part", sum(bits, F.lit(0)).alias("mask")
    )


def mask_counts(
    rows: DataFrame, copies: int, labels: DataFrame, flags: Mapping[str, Column], key: str = "doc_id"
) -> DataFrame:
    """(part, mask, rows, one count per flag) of the rows of `marked`, bit `copies` for copies.

    A row is a copy if a row of a smaller key has its digest; a null key is neither smaller nor
    larger than any. `flags` are conditions on `labels`; a row has a flag if any row of its key in
    `labels` meets it. Repeated rows are counted before they are shuffled, and rows of null keys
    are spread, so no key or text that many rows share meets in one task.
    """
    # a digest that many rows share becomes one row per map task here
    counted = rows.groupBy("key", "digest", "part", "mask").agg(F.count("*").alias("n"))
    spread = F.when(F.col("key").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SPREAD)))
    flagged = (
        labels.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(*(F.max(F.coalesce(c, F.lit(False))).alias(f"is_{f}") for f, c in flags.items()))
        .withColumn("spread", F.lit(0).cast("long"))
    )
    known = counted.withColumn("spread", F.coalesce(spread, F.lit(0).cast("long"))).join(
        flagged, ["key", "spread"], "left"
    )
    flag_columns = [F.coalesce(f"is_{f}", F.lit(False)).alias(f"is_{f}") for f in flags]
    of_text = Window.partitionBy("digest")
    by_text = (
        known.select("key", "digest", "part", "mask", "n", *flag_columns)
        .groupBy("digest", "part", "mask", *(f"is_{f}" for f in flags))
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("keyless"),
            F.min("key").alias("first"),
            F.min_by("n", "key").alias("at_first"),
        )
        .withColumn("first_of_text", F.min("first").over(of_text))
    )
    originals = F.col("keyless") + F.when(
        F.col("first") == F.col("first_of_text"), F.col("at_first")
    ).otherwise(0)
    split = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), originals.alias("n")),
            F.struct(
                F.col("mask").bitwiseOR(F.lit(1 << copies)).alias("mask"),
                (F.col("n") - originals).alias("n"),
            ),
        )
    )
    return (
        by_text.select("part", *(f"is_{f}" for f in flags), split.alias("s"))
        .filter("s.n > 0")
        .groupBy("part", F.col("s.mask").alias("mask"))
        .agg(
            F.sum("s.n").alias("rows"),
            *(F.sum(F.when(F.col(f"is_{f}"), F.col("s.n")).otherwise(0)).alias(f) for f in flags),
        )
    )


def rank(order: Sequence[int]) -> int:
    """The lexicographic number of an order of 0 .. k - 1, from its Lehmer code."""
    k = len(order)
    return sum(
        sum(later < at for later in order[i + 1 :]) * math.factorial(k - 1 - i)
        for i, at in enumerate(order)
    )


@lru_cache(maxsize=None)
def intervals(mask: int, k: int) -> tuple[tuple[int, int, int], ...]:
    """(step from 0, first rank, rank after the last) of all orders that remove the mask there."""
    inside = [i for i in range(k) if mask >> i & 1]
    outside = [i for i in range(k) if not mask >> i & 1]
    found = []
    for step in range(len(outside) + 1):
        for before in itertools.permutations(outside, step):
            for f in inside:
                rest = sorted(set(range(k)) - {*before, f})
                start = rank((*before, f, *rest))
                found.append((step, start, start + math.factorial(k - 1 - step)))
    return tuple(found)


def _sums(masks: Sequence[int], counts: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """Totals of one part: arrays over (rank, step), from counts of shape (masks, 1 + flags)."""
    orders = np.array(list(itertools.permutations(range(k))), np.int64)
    ranks, width = len(orders), counts.shape[1]
    differences = np.zeros((k, ranks + 1, width), np.int64)
    failing = np.zeros(k, np.int64)
    alone = np.zeros(k, np.int64)
    for mask, count in zip(masks, counts):
        for step, start, end in intervals(mask, k):
            differences[step, start] += count
            differences[step, end] -= count
        inside = [i for i in range(k) if mask >> i & 1]
        failing[inside] += count[0]
        if len(inside) == 1:
            alone[inside] += count[0]
    removed = differences.cumsum(axis=1)[:, :ranks].transpose(1, 0, 2)
    shares = np.bincount(orders.ravel(), removed[:, :, 0].ravel(), k).astype(np.int64)
    return {
        "kept": counts[:, 0].sum() - removed[:, :, 0].cumsum(axis=1),
        "removed": removed[:, :, 0],
        "redundant": failing[orders] - removed[:, :, 0],
        "unique_fails": alone[orders],
        "lost": removed[:, :, 1:],
        "shapley": shares[orders],
    }


def interactions(counts: DataFrame, names: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """One row per part, order of the filters and step in it, from the rows of `mask_counts`.

    Columns: part; filter_order, the names in a row; step, from 1; kept, after this step; removed,
    by it; redundant, failing its filter and removed earlier; unique_fails, failing its filter
    only; <flag>_lost, rows with the flag removed by it; shapley, removed by its filter at any
    step, over all orders. Zeros are included; no rows give no parts.
    """
    k, flags = len(names), list(flags)
    if not 1 <= k <= FILTERS or len(set(names)) < k:
        raise ValueError(f"needs 1 to {FILTERS} filters of different names")
    orders = ["".join(o) for o in itertools.permutations(names)]
    totals = ["kept", "removed", "redundant", "unique_fails"]
    columns = [*totals, *(f"{f}_lost" for f in flags), "shapley"]
    schema = pa.schema(
        [
            ("part", pa.string()),
            ("filter_order", pa.string()),
            ("step", pa.int32()),
            *((c, pa.int64()) for c in columns),
        ]
    )

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_column = pa.array(np.repeat(np.array(orders, object), k), pa.string())
        step_column = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)))
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count = np.array([[r[c] for c in ("rows", *flags)] for r in found], np.int64)
                sums = _sums([r["mask"] for r in found], count, k)
                lost = [sums["lost"][:, :, i] for i in range(len(flags))]
                values = [*(sums[c] for c in totals), *lost, sums["shapley"]]
                arrays = [pa.array(np.ascontiguousarray(v).ravel()) for v in values]
                parts = pa.array([part] * len(step_column), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [parts, order_column, step_column, *arrays], schema=schema
                )

    grouped = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "rows", *flags)))
    types = "part string, filter_order string, step int, "
    return grouped.mapInArrow(expanded, types + ", ".join(f"{c} long" for c in columns))


def audit(
    docs: DataFrame,
    labels: DataFrame,
    flags: Mapping[str, Column],
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """`interactions` of the filters A to D of `text_filters` and E, copies of an earlier text.

    Null texts are empty, and equal to other empty ones; null parts are the part "". Rows of one
    key are rows of their own: of those that share the smallest key of a text none is a copy.
    Texts of any length are read whole, and a row's words are held while it is looked at. `labels`
    may lack keys, repeat them or hold nulls. Other columns are not read; an empty table gives no
    rows.
    """
    filters = text_filters(F.col("text"))
    counts = mask_counts(marked(docs, filters, key, text, part), len(filters), labels, flags, key)
    return interactions(counts, [*filters, "E"], list(flags))
