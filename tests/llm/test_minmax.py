import re
from collections import defaultdict
from itertools import combinations

import awkward
import numpy as np
import pytest

from tickspan.llm import minmax

BLANK = re.compile(rb"[\x20\x09-\x0D]+")


def shingles(text, size):
    words = [w for w in BLANK.split((text or "").encode().lower()) if w]
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, pct=80):
    """Component of each id by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, size) for i, t in rows}
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].append(i)
    shared = defaultdict(int)
    for ids in by_shingle.values():
        for a, b in combinations(sorted(ids), 2):
            shared[a, b] += 1
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= pct * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def found(df):
    return {r["doc_id"]: (r["component_id"], r["n_shingles"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(spark, data, size):
    docs = awkward.table(spark, data)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    component, count = brute(rows, size)
    got = found(minmax.near_duplicates(docs, shingle_words=size))
    assert got == {i: (component[i], count[i], component[i] == i) for i, _ in rows}
    assert sum(not kept for _, _, kept in got.values()) > 50


@pytest.mark.parametrize("block", [1 << 17, 400])
def test_hub_that_is_not_linked_to_all(spark, monkeypatch, block):
    """A bucket whose hub links few: the rest are compared with each other, in blocks."""
    monkeypatch.setattr(minmax, "BLOCK", block)
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):  # a common text with 7 to 14 changed words: some pairs are far, some near
        own = list(words)
        for j in rng.choice(100, 14 if i < 20 else 5, replace=False):
            own[j] = f"x{i}_{j}"
        rows.append((i, " ".join(own), "en"))
    docs = awkward.documents(spark, rows)
    component, _ = brute([r[:2] for r in rows], 1)
    got = found(minmax.near_duplicates(docs, shingle_words=1))
    assert {i: c for i, (c, _, _) in got.items()} == component


def test_chain_reaches_its_smallest(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    got = {r["node"]: r["component"] for r in minmax.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 3000, np.uint64)
    estimates = []
    for shared in (600, 1500, 2700):
        b = np.concatenate([a[:shared], rng.integers(0, 1 << 63, 3000 - shared, np.uint64)])
        both = minmax.min_max(np.concatenate([a, b]), np.array([3000, 3000]), 400)
        estimates.append((both[0] == both[1]).mean() - shared / (6000 - shared))
    assert np.abs(estimates).max() < 0.06


def test_shared_counts_against_sets():
    rng = np.random.default_rng(3)
    left, right = (
        [np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(n)] for n in (7, 9)
    )
    got = minmax.shared_counts(
        np.concatenate(left), np.array([len(x) for x in left]),
        np.concatenate(right), np.array([len(x) for x in right]),
    )
    want = [[len(set(a) & set(b)) for b in right] for a in left]
    assert [g.tolist() for g in got] == want


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    out = minmax.near_duplicates(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == 12
    assert sorted(r for r in rows if r[0] in (5, 6)) == [
        (5, 1, 5, True), (6, 1, 5, False), (6, 1, 5, False),
    ]
    assert all(r[2] is None and r[3] for r in rows if r[0] is None)
    assert all(r[1:] == (0, r[0], True) for r in rows if r[0] in (2, 3, 4))
    left = minmax.without_copies(docs, out)
    assert left.columns == docs.columns
    assert left.count() == 10
    assert minmax.near_duplicates(docs.limit(0)).count() == 0
