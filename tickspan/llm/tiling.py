"""Benchmark decontamination by greedy string tiling.

1. Every run of `min_tile` words of a benchmark item is a seed; a shorter item is one seed as a
   whole. A Bloom filter of all seeds, of
   one fixed size whatever the benchmark's, goes to every task.
2. One pass over the documents hashes their words (Karp-Rabin) and keeps the seeds that may be in
   the benchmark. Documents without one end here; of the others the word hashes are written.
3. The kept seeds are joined with the benchmark's on the seed itself. A document and an item that
   share enough distinct seeds to reach the coverage become a candidate pair.
4. Each pair is tiled: the longest runs of equal words that no tile marks yet are marked, longest
   first, until none of `min_tile` words is left. Runs of one length are found by comparing
   Karp-Rabin values of all unmarked windows, and verified word by word.
5. The share of an item's words that tiles cover is its coverage. Tiles may lie in any order, so a
   passage whose parts were moved is covered as well as one copied straight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import as_table
from .bloom import Bloom, bloom_words
from .frames import flat, lean, lists, steps
from .words import ALNUM, SHINGLE_BASE, lower_latin, mixed, powers, shingle_hashes, spans, word_hashes

MIN_TILE = 4
COVERAGE = 0.6


def _unspaced_blocks() -> np.ndarray:
    """Whether the 64 characters from 64 * i on are of a script that sets no blanks."""
    blocks = np.zeros(1024, bool)
    for first, last in (
        (0x0E00, 0x0FFF),  # Thai, Lao, Tibetan
        (0x1000, 0x107F),  # Myanmar
        (0x1780, 0x17FF),  # Khmer
        (0x2E80, 0xA4CF),  # Han, Kana, Bopomofo, Yi and their punctuation
        (0xF900, 0xFAFF),
        (0xFF00, 0xFFEF),
    ):
        blocks[first >> 6 : (last >> 6) + 1] = True
    return blocks


UNSPACED = _unspaced_blocks()


def word_spans(data, bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `spans` of ALNUM, but every character of an unspaced script is a word of its own."""
    starts, ends, first = spans(data, bounds, ALNUM)
    n = len(data)
    lead = np.flatnonzero(data >= 0xE0)
    lead = lead[lead < n - 2]
    if not len(lead):
        return starts, ends, first
    a, b = data[lead].astype(np.int64), data[lead + 1].astype(np.int64)
    three = (a < 0xF0) & UNSPACED[(a & 15) << 6 | b & 63]
    four = (a == 0xF0) & (b >= 0xA0) & (lead < n - 3)  # the supplementary Han planes
    own = lead[three | four]
    if not len(own):
        return starts, ends, first
    after = own + np.where(data[own] >= 0xF0, 4, 3)
    start, end = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    start[starts], end[ends] = True, True
    # Where a word goes on after such a character another begins, and one ends before it.
    new, last = after[~end[after]], own[~start[own]]
    start[own], start[new], end[after], end[last] = True, True, True, True
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end), np.searchsorted(starts, bounds)


def hashed_words(data, bounds) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in lower case, and the n + 1 word numbers between the texts.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII; in scripts that
    set no blanks (Han, Kana, Thai and others) each character is one.
    """
    data = lower_latin(data)
    starts, ends, first = word_spans(data, bounds)
    return word_hashes(data, starts, ends), first


def item_words():
    """Column function: text to its word hashes."""

    @F.arrow_udf("array<long>")
    @lean()
    def words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            hashes, first = hashed_words(*flat(batch))
            yield lists(hashes.view(np.int64), np.diff(first), pa.int64())

    return words


def item_seeds(min_tile: int):
    """Column function: word hashes to the seeds at each word, or one of all words if few."""

    @F.arrow_udf("array<long>")
    @lean()
    def seeds(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [
                shingle_hashes(np.array(w, np.int64).view(np.uint64), min(min_tile, len(w)))
                for w in batch.to_pylist()
            ]
            values = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
            yield lists(values, [len(f) for f in found], pa.int64())

    return seeds


def seeds_of_documents(words: np.ndarray, sizes: dict[int, int]):
    """Column function: text to its word hashes and its distinct seeds that pass the filter.

    `sizes` has the numbers of words of a seed, and how many distinct seeds of that size have to
    pass at least. Both are null if no size has so many.
    """

    @F.arrow_udf("struct<words:array<long>, seeds:array<long>>")
    @lean()
    def candidates(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Bloom(words)
        kind = pa.list_(pa.int64())
        for batch in batches:
            data, bounds = flat(batch)
            kept_words, kept_seeds = [], []
            for a, b in steps(bounds):
                part = bounds[a : b + 1] - bounds[a]
                hashes, first = hashed_words(data[bounds[a] : bounds[b]], part)
                passed: list[list] = [[] for _ in range(b - a)]
                for size, least in sizes.items():
                    seeds = shingle_hashes(hashes, size)
                    at = np.flatnonzero(known.may_hold(seeds))
                    low = np.searchsorted(at, first[:-1]).tolist()
                    high = np.searchsorted(at, first[1:] - size + 1).tolist()
                    for x, y, found in zip(low, high, passed):
                        if y - x >= least and len(one := np.unique(seeds[at[x:y]])) >= least:
                            found.append(one)
                for i, found in enumerate(passed):
                    own = hashes[first[i] : first[i + 1]]
                    together = np.unique(np.concatenate(found)) if found else None
                    kept_seeds.append(None if together is None else together.view(np.int64))
                    kept_words.append(None if together is None else own.view(np.int64))
            yield pa.StructArray.from_arrays(
                [pa.array(kept_words, kind), pa.array(kept_seeds, kind)], ["words", "seeds"]
            )

    return candidates


def _windows(words: np.ndarray, marked: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the unmarked windows of `size` words and their Karp-Rabin values."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    covered = np.zeros(len(words) + 1, np.int64)
    np.cumsum(marked, out=covered[1:])
    at = np.flatnonzero(covered[size:] == covered[:n])
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(SHINGLE_BASE, len(words)), out=sums[1:])
    back = powers(pow(SHINGLE_BASE, -1, 1 << 64), len(words))
    return at, mixed((sums[at + size] - sums[at]) * back[at])


def tiles(item: np.ndarray, text: np.ndarray, min_tile: int) -> list[tuple[int, int, int]]:
    """(start in item, start in text, words) of the greedy tiles, longest first.

    Among runs of one length the earlier start in the item, then in the text, is marked first.
    """
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    # Only words of the item can be in a tile: mark all others from the start.
    in_text |= ~np.isin(text, item)
    in_item |= ~np.isin(item, text)
    out = []
    size = min(len(item), len(text))
    while size >= min_tile:
        at, values = _windows(item, in_item, size)
        places, found = _windows(text, in_text, size)
        if not len(at) or not len(places):
            size -= 1
            continue
        order = np.argsort(found, kind="stable")
        ranked = found[order]
        low = np.searchsorted(ranked, values, "left")
        high = np.searchsorted(ranked, values, "right")
        for k in np.flatnonzero(high > low).tolist():
            i = int(at[k])
            if in_item[i : i + size].any():
                continue
            for j in places[order[low[k] : high[k]]].tolist():
                if in_text[j : j + size].any():
                    continue
                if (item[i : i + size] == text[j : j + size]).all():
                    in_item[i : i + size] = in_text[j : j + size] = True
                    out.append((i, j, size))
                    break
        size -= 1
    return out


def _tiled(min_tile: int, coverage: float):
    @lean()
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, item, words, own in zip(
                batch["doc"], batch["item"], batch["words"], batch["item_words"]
            ):
                words = np.asarray(words, np.int64).view(np.uint64)
                own = np.asarray(own, np.int64).view(np.uint64)
                found = tiles(own, words, min(min_tile, len(own)))
                matched = sum(t[2] for t in found)
                if matched >= coverage * len(own):
                    rows.append((doc, item, len(own), matched, matched / len(own), found))
            yield pd.DataFrame(
                rows, columns=["doc", "item", "item_words", "matched", "coverage", "tiles"]
            )

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    min_tile: int = MIN_TILE,
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document and benchmark item whose tiles cover `coverage` of the item's words.

    Columns: id, item id (both 64 bits), item_words, matched, coverage and the tiles as an array
    of (item_start, doc_start, words), counted in words. An item of fewer than `min_tile` words
    has to be in the text as a whole. Texts and items that are null or have no word, and rows with a
    null id take no part. Rows that repeat an id
    yield one row per item, that of the best coverage. Other columns are not read; an empty table
    on either side gives no rows.
    """
    items = as_table(
        benchmark.select(
            F.col(item_column).cast("long").alias("item"),
            item_words()(F.col(item_text_column)).alias("item_words"),
        ).filter(F.col("item").isNotNull() & (F.size("item_words") > 0)),
        "items",
    )
    seeded = items.select(
        "item",
        F.size("item_words").alias("length"),
        item_seeds(min_tile)("item_words").alias("seeds"),
    )
    seeds = as_table(
        seeded.select("item", "length", F.posexplode("seeds").alias("place", "seed")), "seeds"
    )
    # Distinct seeds that any document of enough coverage holds. A tile of min_tile words is one
    # seed, so n seeds cover n * min_tile words at most; seeds that an item repeats count once.
    repeated = F.size("seeds") - F.size(F.array_distinct("seeds"))
    needed = F.ceil(coverage * F.col("length") / min_tile) - repeated
    size = F.least("length", F.lit(min_tile)).alias("size")
    least = seeded.groupBy(size).agg(F.min(needed).alias("least")).collect()
    sizes = {
        row["size"]: max(1, row["least"]) if row["size"] == min_tile else 1 for row in least
    }
    find = seeds_of_documents(bloom_words(seeds, "seed"), sizes)
    hits = as_table(
        docs.filter(F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("long").alias("doc"), find(F.col(text_column)).alias("h"))
        .filter("h.seeds IS NOT NULL")
        .select("doc", "h.words", "h.seeds"),
        "hits",
    )
    pairs = (
        hits.select("doc", F.explode("seeds").alias("seed"))
        .join(seeds, "seed")
        .groupBy("doc", "item", "length")
        .agg(F.countDistinct("place").alias("places"))
        .filter(F.col("places") * F.least("length", F.lit(min_tile)) >= coverage * F.col("length"))
        .select("doc", "item")
    )
    schema = (
        "doc long, item long, item_words long, matched long, coverage double, "
        "tiles array<struct<item_start:long, doc_start:long, words:long>>"
    )
    found = (
        pairs.join(hits.select("doc", "words"), "doc")
        .join(items, "item")
        .mapInPandas(_tiled(min_tile, coverage), schema)
    )
    best = F.max(F.struct("coverage", "matched", "item_words", "tiles")).alias("best")
    return (
        found.groupBy("doc", "item")
        .agg(best)
        .select(
            F.col("doc").alias(id_column),
            F.col("item").alias(item_column),
            "best.item_words",
            "best.matched",
            "best.coverage",
            "best.tiles",
        )
    )


def clean_documents(docs: DataFrame, found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of docs whose id is in no row of `found`; rows with a null id stay."""
    return docs.join(found.select(id_column).distinct(), id_column, "left_anti").select(docs.columns)
