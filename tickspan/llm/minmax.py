"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two values of the signature, its minimum and its
maximum. Either equals that of another set with a probability of the sets' Jaccard similarity J,
so the share of equal values is an unbiased estimate of J; as the two ends of a permutation are
negatively correlated, its variance is no larger than with twice as many permutations, at half
the hash evaluations. Rows of the signature are banded; documents that agree in a band become
candidates, and only those confirmed on their full shingle sets are linked.

With 40 permutations (80 values) in 20 bands of 4, a pair at J = 0.8 shares a band with a
probability of 0.99997.

How it stays linear in groups of copies:
- Documents with equal sets are one node (partial aggregation by a 128-bit fingerprint).
- In a bucket every node is confirmed against one hub alone: the node that shares buckets with
  the most others, which in a group of copies is the one that most of them stem from.
- Only where a bucket then still holds several components, the nodes outside the hub's component
  are compared with that component and with each other, whatever their number: in blocks of nodes
  with their full sets, inside the tasks, so no pair is a row unless it is a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import as_table
from .bloom import bloom_words, may_be_in
from .frames import flat, lean, lists, steps
from .words import NOT_BLANK, mixed, run_hash, shingle_hashes, spans, word_hashes

PERMUTATIONS = 40
BAND_ROWS = 4
#: Shingles of one block of nodes that are compared pair by pair.
BLOCK = 1 << 17

SIGNATURE = "struct<n:long, low:long, high:long, bands:array<long>>"


def distinct_shingles(data, bounds, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text with fewer than `size` words has its whole sequence as its one shingle; a text without
    words has none.
    """
    starts, ends, first = spans(data, bounds, NOT_BLANK)
    words = word_hashes(data, starts, ends)
    shingles = shingle_hashes(words, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            found = np.sort(shingles[a : b - size + 1])
            keep = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            yield found[keep]
        elif b > a:
            yield np.array([run_hash(words[a:b], b - a)], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def min_max(values: np.ndarray, counts: np.ndarray, permutations: int) -> np.ndarray:
    """Signature rows (minimum and maximum of each permutation) of sets of one value or more."""
    rng = np.random.default_rng(20240229)
    factors = rng.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 1 << 63, permutations, np.uint64)
    at = np.zeros(len(counts), np.int64)
    np.cumsum(counts[:-1], out=at[1:])
    out = np.empty((len(counts), 2 * permutations), np.uint32)
    for p in range(permutations):
        hashed = ((values * factors[p] + offsets[p]) >> np.uint64(32)).astype(np.uint32)
        out[:, 2 * p] = np.minimum.reduceat(hashed, at)
        out[:, 2 * p + 1] = np.maximum.reduceat(hashed, at)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of `rows` signature values; the band's number is part of it."""
    n, width = signature.shape
    count = width // rows
    key = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), (n, count)).copy()
    for j in range(rows):
        key = mixed(key + signature[:, j : count * rows : rows].astype(np.uint64))
    return key


def signatures(size: int, permutations: int = PERMUTATIONS, rows: int = BAND_ROWS):
    """Column function: text to its set's size, fingerprint and band keys."""

    @F.arrow_udf(SIGNATURE)
    @lean()
    def signature(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data, bounds = flat(batch)
            out = []
            for a, b in steps(bounds):
                part = bounds[a : b + 1] - bounds[a]
                sets = list(distinct_shingles(data[bounds[a] : bounds[b]], part, size))
                out.append(_described(sets, permutations, rows))
            yield pa.concat_arrays(out) if out else _described([], permutations, rows)

    return signature


def _described(sets: list[np.ndarray], permutations: int, rows: int) -> pa.StructArray:
    counts = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(counts)
    low, high = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
    for i in full.tolist():
        low[i] = mixed(sets[i]).sum(dtype=np.uint64).astype(np.int64)
        high[i] = np.bitwise_xor.reduce(sets[i] * np.uint64(0xD6E8FEB86659FD93)).astype(np.int64)
    bands = np.zeros(len(sets), np.int64)
    keys = np.zeros((0, 1), np.uint64)
    if len(full):
        found = min_max(np.concatenate([sets[i] for i in full]), counts[full], permutations)
        keys = band_keys(found, rows)
        bands[full] = keys.shape[1]
    return pa.StructArray.from_arrays(
        [
            pa.array(counts),
            pa.array(low),
            pa.array(high),
            lists(keys.ravel().view(np.int64), bands, pa.int64()),
        ],
        ["n", "low", "high", "bands"],
    )


def shingle_sets(size: int):
    """Column function: text to its sorted distinct shingle hashes."""

    @F.arrow_udf("array<long>")
    @lean()
    def shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data, bounds = flat(batch)
            out = [lists(np.zeros(0, np.int64), np.zeros(0, np.int64), pa.int64())]
            for a, b in steps(bounds):
                part = bounds[a : b + 1] - bounds[a]
                sets = list(distinct_shingles(data[bounds[a] : bounds[b]], part, size))
                values = np.concatenate(sets).view(np.int64)
                out.append(lists(values, [len(s) for s in sets], pa.int64()))
            yield pa.concat_arrays(out)

    return shingles


def _alike(similarity_pct: int) -> str:
    """SQL: the sizes n and m of two sets allow the similarity."""
    return f"100 * least(n, m) >= {similarity_pct} * greatest(n, m)"


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity_pct: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right_set"))
    shared = F.size(F.array_intersect("left_set", "right_set"))
    union = F.size("left_set") + F.size("right_set") - shared
    return (
        pairs.select("a", "b")
        .join(right, "b")
        .join(left, "a")
        .filter(100 * shared >= similarity_pct * union)
        .select("a", "b")
    )


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Every round takes the smallest component among a node's neighbours and then that component's
    own one, so long chains halve. Each round is written to the shared folder.
    """
    edges = as_table(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select("b", "a"))
        .distinct(),
        name,
    )
    current = as_table(
        edges.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), name
    )
    while True:
        near = edges.join(
            current.select(F.col("node").alias("other"), "component"), "other"
        ).select("node", "component")
        nearest = current.union(near).groupBy("node").agg(F.min("component").alias("component"))
        jump = current.select(
            F.col("node").alias("component"), F.col("component").alias("further")
        )
        following = as_table(
            nearest.join(jump, "component", "left").select(
                "node", F.least("component", "further").alias("component")
            ),
            name,
        )
        changed = (
            following.join(current.withColumnRenamed("component", "before"), "node")
            .filter("component <> before")
            .limit(1)
            .count()
        )
        current = following
        if not changed:
            return current


def shared_counts(
    left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray, right_sizes: np.ndarray
) -> Iterator[np.ndarray]:
    """For each left set, how many values it shares with each right set; sets lie in a row."""
    owner = np.repeat(np.arange(len(right_sizes)), right_sizes)
    order = np.argsort(right, kind="stable")
    ranked, owner = right[order], owner[order]
    at = 0
    for size in left_sizes.tolist():
        values = left[at : at + size]
        at += size
        low = np.searchsorted(ranked, values, "left")
        counts = np.searchsorted(ranked, values, "right") - low
        place = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        yield np.bincount(owner[place], minlength=len(right_sizes))


def _block_links(similarity_pct: int):
    """Map function: pairs of blocks of nodes to the links between them."""

    @lean()
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):

                def column(name: str, i: int = i, batch: pa.RecordBatch = batch) -> np.ndarray:
                    return batch.column(name)[i].values.to_numpy(zero_copy_only=False)

                nodes, others = column("nodes"), column("other_nodes")
                outside = column("other_outside").astype(bool)
                sizes, other_sizes = column("sizes"), column("other_sizes")
                found = [], []
                shared = shared_counts(
                    column("sets"), sizes, column("other_sets"), other_sizes
                )
                for node, size, n in zip(nodes.tolist(), sizes.tolist(), shared):
                    near = 100 * n >= similarity_pct * (size + other_sizes - n)
                    # Two outside nodes meet twice: once is enough.
                    near &= (others != node) & ~(outside & (others < node))
                    ends = others[near]
                    found[0].extend(np.minimum(ends, node).tolist())
                    found[1].extend(np.maximum(ends, node).tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f, pa.int64()) for f in found], ["a", "b"]
                )

    return links


def _links_outside(clusters: DataFrame, sets: DataFrame, similarity_pct: int) -> DataFrame:
    """Links of each cluster's outside nodes with all of its nodes.

    `clusters` has (cluster, node, outside). Blocks of outside nodes meet blocks of all nodes; the
    blocks hold about BLOCK shingles each, however large the cluster is.
    """
    rows = clusters.join(sets, "node").withColumn("size", F.size("shingles"))
    own = F.when(F.col("outside"), F.col("size")).otherwise(0)
    totals = rows.groupBy("cluster").agg(
        F.greatest(F.lit(1), F.ceil(F.sum(own) / BLOCK)).cast("int").alias("lefts"),
        F.greatest(F.lit(1), F.ceil(F.sum("size") / BLOCK)).cast("int").alias("rights"),
    )
    rows = rows.join(totals, "cluster")

    def blocks(side: DataFrame, count: str, prefix: str) -> DataFrame:
        return (
            side.withColumn("block", F.expr(f"cast(pmod(xxhash64(node), {count}) AS int)"))
            .groupBy("cluster", "lefts", "rights", "block")
            .agg(
                F.collect_list("node").alias(f"{prefix}nodes"),
                F.collect_list("size").alias(f"{prefix}sizes"),
                F.collect_list(F.col("outside").cast("int")).alias(f"{prefix}outside"),
                F.flatten(F.collect_list("shingles")).alias(f"{prefix}sets"),
            )
        )

    left = blocks(rows.filter("outside"), "lefts", "").drop("outside")
    right = blocks(rows, "rights", "other_")
    left = left.withColumnRenamed("block", "l").withColumn(
        "r", F.explode(F.expr("sequence(0, rights - 1)"))
    )
    right = right.withColumnRenamed("block", "r").withColumn(
        "l", F.explode(F.expr("sequence(0, lefts - 1)"))
    )
    met = left.drop("lefts", "rights").join(right.drop("lefts", "rights"), ["cluster", "l", "r"])
    return (
        met.drop("cluster", "l", "r")
        .mapInArrow(_block_links(similarity_pct), "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    similarity_pct: int = 80,
    permutations: int = PERMUTATIONS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row, ids of 64 bits.

    Texts are linked if 100 * intersection >= similarity_pct * union of their shingle sets;
    component_id is the smallest id that can be reached. Null and empty texts, and texts without
    words, have an empty set and are linked with nothing. A row with a null id stays alone: its
    component is null and it is kept. Rows that repeat an id are all returned, each judged by its
    own text. Other columns of the input are not read. An empty table gives no rows.
    """
    made = signatures(shingle_words, permutations, band_rows)
    source = docs.select(F.col(id_column).cast("long").alias("node"), F.col(text_column).alias("t"))
    signed = as_table(
        source.select("node", made("t").alias("s")).select("node", "s.*"), "signatures"
    )
    whole = signed.filter("n > 0 AND node IS NOT NULL")
    groups = as_table(
        whole.groupBy("low", "high", "n").agg(
            F.min("node").alias("node"), F.max("node").alias("last")
        ),
        "groups",
    )
    # One row per set: rows that repeat an id with the same set are the same node.
    firsts = whole.join(
        groups.select("low", "high", "n", "node"), ["node", "n", "low", "high"], "left_semi"
    ).dropDuplicates(["node", "low", "high", "n"])
    members = as_table(
        firsts.select("node", "n", F.explode("bands").alias("band")), "members"
    )
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    held = as_table(members.join(sizes, "band"), "held")
    degrees = held.groupBy("node").agg(F.sum("size").alias("degree"))
    hubs = as_table(
        held.join(degrees, "node")
        .groupBy("band", "size")
        .agg(F.max(F.struct("degree", (-F.col("node")).alias("minus"), "n")).alias("hub"))
        .select("band", "size", (-F.col("hub.minus")).alias("hub"), F.col("hub.n").alias("m")),
        "hubs",
    )
    pairs = (
        held.select("band", "node", "n")
        .join(hubs.select("band", "hub", "m"), "band")
        .filter(F.col("node") != F.col("hub"))
        .filter(_alike(similarity_pct))
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )
    pairs = as_table(pairs, "pairs")
    make_set = shingle_sets(shingle_words)

    def sets_of(nodes: DataFrame) -> DataFrame:
        # The filter keeps most texts out of the shuffle, the join is exact.
        nodes = as_table(nodes, "nodes")
        key = F.xxhash64("node")
        known = bloom_words(nodes.select(key.alias("key")), "key")
        wanted = source.filter(may_be_in(key, known)).join(nodes, "node", "left_semi")
        return as_table(wanted.select("node", make_set("t").alias("shingles")), "sets")

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    links = as_table(_confirmed(pairs, sets_of(ends), similarity_pct).distinct(), "links")
    linked = components(links)

    # Nodes outside the component of their bucket's hub, in buckets of three or more.
    def component_of(rows: DataFrame, node: str, name: str) -> DataFrame:
        known = linked.select(F.col("node").alias(node), F.col("component").alias("known_"))
        return rows.join(known, node, "left").withColumn(name, F.coalesce("known_", node)).drop("known_")

    clusters = component_of(hubs.filter("size > 2").select("band", "hub"), "hub", "cluster")
    outside = as_table(
        component_of(held.join(clusters.select("band", "cluster"), "band"), "node", "component")
        .filter("component <> cluster")
        .select("cluster", "node")
        .distinct(),
        "outside",
    )
    if outside.limit(1).count():
        chosen = outside.select("cluster").distinct()
        inside = linked.select(F.col("component").alias("cluster"), "node").union(
            chosen.select("cluster", F.col("cluster").alias("node"))
        )
        inside = inside.distinct().join(chosen, "cluster", "left_semi")
        every = as_table(
            inside.withColumn("outside", F.lit(False)).unionByName(
                outside.withColumn("outside", F.lit(True))
            ),
            "clusters",
        )
        sets = sets_of(every.select("node").distinct())
        found = as_table(_links_outside(every, sets, similarity_pct), "links")
        if found.limit(1).count():
            links = links.union(found)
            linked = components(links)

    moved = groups.join(linked, "node", "left").select(
        "low", "high", "n", F.coalesce("component", "node").alias("component"), "node", "last"
    )
    moved = moved.filter("component <> last").select("low", "high", "n", "component")
    return (
        signed.select("node", "n", "low", "high")
        .join(moved, ["low", "high", "n"], "left")
        .select(
            F.col("node").alias(id_column),
            F.col("n").alias("n_shingles"),
            F.when(
                F.col("node").isNotNull(), F.coalesce("component", "node")
            ).alias("component_id"),
        )
        .withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
    )


def without_copies(docs: DataFrame, found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One document of each component: the rows whose id is the smallest of its own.

    Rows of a null id stay. Rows that repeat an id stay or go together: they go if one of them is
    a copy of a document with a smaller id.
    """
    copies = found.filter("NOT kept").select(id_column).distinct()
    return docs.join(copies, id_column, "left_anti").select(docs.columns)
