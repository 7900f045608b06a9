"""Exact top-k by inner product with MaxScore over shards of an impact-ordered index.

The dimensions of a query are its terms. With a shard's smallest and largest component of each
dimension, a vector's score is a constant of the query and shard plus a sum of contributions that
are never negative: |q| * (x - smallest) where q > 0, |q| * (largest - x) where q < 0. A term's
score bound in the shard is |q| * (largest - smallest).

MaxScore: terms are ordered by bound; those of the smallest bounds are non-essential as long as
their bounds together cannot lift a vector over the k-th best score so far. Postings of the
essential terms are traversed for all vectors of a block, and the non-essential terms are probed
from the largest bound down, only for vectors that are still competitive (partial score plus the
bounds left reach the k-th best score; equal scores count, as ties go to the smaller id).

Queries and candidates are packed into blobs of bounded size; each block of queries meets each
shard once, and the shards' lists of k are merged by (score, id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import as_table

#: Vectors of a shard, of a block inside it, and queries of a block.
SHARD = 8192
BLOCK = 1024
QUERIES = 512
#: Tasks that the query blocks of a shard are dealt to, each with a copy of the shard.
COPIES = 4
#: Terms that are traversed or probed at once.
PROBES = 8


def integer_vector(column: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component x as a double; null if any is null or not finite."""
    x = F.transform(column, lambda c: c.cast("double"))
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(ok, F.transform(x, lambda c: F.floor(c * scale).cast("long")))


def _gain(
    q: np.ndarray, size: np.ndarray, spread: np.ndarray, terms: np.ndarray, impacts: np.ndarray
) -> np.ndarray:
    """What the terms add to each vector's score, given the vectors' impacts."""
    # size * impact where q > 0 and size * (spread - impact) elsewhere.
    down = terms[q[terms] <= 0]
    return q[terms] @ impacts[terms] + (size[down] * spread[down]).sum()


def top_of_shard(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of the k best vectors of each query, but for the one of its own id."""
    if not vectors.shape[1]:
        vectors = np.zeros((len(ids), 1), np.int64)
        queries = np.zeros((len(query_ids), 1), np.int64)
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    # Impacts by term: a row per dimension, upwards from the smallest and down from the largest.
    impacts = np.ascontiguousarray((vectors - low).T)
    spread = high - low
    # Doubles are exact up to 2 ** 53, and their products much faster than those of integers.
    largest = 2 * max(map(_largest, (low, high))) * _largest(queries) * vectors.shape[1]
    if largest < 1 << 53:
        impacts, spread = impacts.astype(np.float64), spread.astype(np.float64)
        queries = queries.astype(np.float64)
    out = []
    for own, q in zip(query_ids.tolist(), queries):
        size = np.abs(q)
        base = int((np.where(q > 0, low, high) * q).sum())
        bounds = size * spread
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        left = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)  # bounds from a term on
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a in range(0, len(ids), BLOCK):
            need = int(best[-1] - base) if len(best) == k else None
            # Essential terms: the first ones, as many as it takes until the rest can't suffice.
            essential = len(order) if need is None else int(np.searchsorted(-left, -need, "right"))
            essential = min(max(essential, 1), len(order))
            partial = _gain(q, size, spread, order[:essential], impacts[:, a : a + BLOCK])
            keep = ids[a : a + BLOCK] != own
            if need is not None:
                keep &= partial + left[essential] >= need
            at, partial, done = np.flatnonzero(keep) + a, partial[keep], essential
            while len(at) and done < len(order):
                terms = order[done : done + PROBES]
                partial += _gain(q, size, spread, terms, impacts[:, at])
                done += len(terms)
                if need is not None:
                    competitive = partial + left[done] >= need
                    at, partial = at[competitive], partial[competitive]
            found_ids = np.concatenate([best_ids, ids[at]])
            found = np.concatenate([best, partial.astype(np.int64) + base])
            top = np.lexsort((found_ids, -found))[:k]
            best_ids, best = found_ids[top], found[top]
        out.append((best_ids, best))
    return out


def _largest(values: np.ndarray) -> int:
    return max((abs(int(v)) for v in (values.min(initial=0), values.max(initial=0))))


def _packed(df: DataFrame, group: Column, width: int) -> DataFrame:
    """Groups of (id, vector) rows as two blobs each: (g, ids, vectors)."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        vectors = np.zeros((len(frame), width), np.int64)
        for row, v in zip(vectors, frame["v"]):
            row[: len(v)] = v
        return pd.DataFrame(
            {
                "g": [frame["g"].iloc[0]],
                "ids": [frame["id"].to_numpy(np.int64).tobytes()],
                "vectors": [vectors.tobytes()],
            }
        )

    return (
        df.withColumn("g", group)
        .groupBy("g")
        .applyInPandas(pack, "g long, ids binary, vectors binary")
    )


def _searched(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                asked = np.frombuffer(row["query_ids"], np.int64)
                found = top_of_shard(
                    ids,
                    np.frombuffer(row["vectors"], np.int64).reshape(len(ids), width),
                    asked,
                    np.frombuffer(row["queries"], np.int64).reshape(len(asked), width),
                    k,
                )
                counts = [len(i) for i, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(asked, counts)),
                        pa.array(np.concatenate([i for i, _ in found])),
                        pa.array(np.concatenate([s for _, s in found])),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of each query's k highest inner products.

    Queries are the rows where `is_query` holds; candidates are all rows of another id. Vectors
    are floor(scale * x), and scores 64-bit integers; ties go to the smaller id. Rows with a null
    id, a null vector, or a component that is null or not finite take no part; a shorter vector
    counts as if filled up with zeros, so an empty one scores 0. Repeated rows of one id are
    candidates each, and a query that is repeated is asked once, by its smallest vector. Other
    columns are not read; an empty table gives no rows.
    """
    rows = as_table(
        vectors.select(
            F.col(id_column).cast("long").alias("id"),
            integer_vector(vector_column, scale).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("q"),
        ).filter("id IS NOT NULL AND v IS NOT NULL"),
        "vectors",
    )
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.sum(F.col("q").cast("int"))
    ).first()
    n, width, asked = facts[0], facts[1] or 0, facts[2] or 0
    shards, blocks = -(-n // SHARD) or 1, -(-asked // QUERIES) or 1
    # A row's shard hangs on the whole row, so that repeats of one id are dealt out as well.
    dealt = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shards))
    candidates = as_table(_packed(rows.select("id", "v"), dealt, width), "shards")
    questions = rows.filter("q").groupBy("id").agg(F.min("v").alias("v"))
    copies = min(COPIES, blocks)
    questions = _packed(questions, F.pmod(F.xxhash64("id"), F.lit(blocks)), width).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        (F.col("g") % copies).cast("int").alias("copy"),
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("queries"),
    )
    questions = questions.withColumnRenamed("shard", "g")
    # Shards and query blocks meet in one partition for each copy of a shard; a number that is
    # asked for is not merged again at run time.
    copied = candidates.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    found = (
        copied.repartition(shards * copies, "g", "copy")
        .join(questions.repartition(shards * copies, "g", "copy"), ["g", "copy"])
        .drop("g", "copy")
        .mapInArrow(_searched(k, width), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
