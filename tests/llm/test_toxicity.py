import zlib

import awkward
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspan.llm import toxicity
from tickspan.llm.queries import op4_toxicity


def test_held_out_labels(spark, data):
    labels = {r["doc_id"]: r["toxic"] for r in awkward.table(spark, data, "labels").collect()}
    rows = op4_toxicity(spark, data).collect()
    assert len(rows) == awkward.table(spark, data).count()
    held = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    wrong = sum(r["predicted"] != labels[r["doc_id"]] for r in held)
    assert wrong <= 0.08 * len(held)


def made(n=300, seed=0):
    rng = np.random.default_rng(seed)
    good = [f"good{i}" for i in range(20)]
    bad = [f"vile{i}" for i in range(6)]
    texts, toxic = [], []
    for i in range(n):
        label = int(i % 4 == 0)
        words = list(rng.choice(good, 12)) + list(rng.choice(bad, 3) if label else [])
        texts.append(" ".join(rng.permutation(words)).encode())
        toxic.append(label)
    return texts, np.array(toxic)


def test_nearest_are_exact():
    texts, toxic = made()
    index = toxicity.build(np.arange(300) * 3, texts, toxic, np.ones(300))
    assert index.terms
    vectors = [index.vector(toxicity.words_of(t)) for t in texts]
    dense = np.zeros((300, len(index.idf)))
    for row, (at, weight) in zip(dense, vectors):
        row[at] = weight
    queries = [index.vector(toxicity.words_of(t)) for t in made(60, seed=9)[0]]
    for k in (1, 7, 400):
        for (at, weight), (docs, cosines) in zip(queries, index.nearest(queries, k)):
            cosine = (dense[:, at] @ weight).round(12)
            order = np.lexsort((np.arange(300), -cosine))
            order = order[cosine[order] > 0][:k]
            assert docs.tolist() == order.tolist()
            assert np.allclose(cosines, cosine[order])


@pytest.mark.filterwarnings("error::RuntimeWarning")  # a covariance of one row, which may also fail
@pytest.mark.parametrize("words", [1, 2, 5, 40])
def test_one_example_is_enough(words):
    text = b" ".join(b"vile%d" % i for i in range(words))
    index = toxicity.build(np.array([7]), [text], np.array([1]), np.ones(1))
    assert index.number[0] == 0 and index.overall == 1.0
    ((near, _),) = index.nearest([index.vector([b"vile0"])], 5)
    assert near.tolist() == [0]


def test_isotonic_steps_rise():
    rng = np.random.default_rng(1)
    x = rng.random(200)
    y = (rng.random(200) < x).astype(float)
    steps, values = toxicity.isotonic(x, y, np.ones(200))
    assert (np.diff(steps) > 0).all() and (np.diff(values) > 0).all()


def test_evidence_and_beginnings(spark):
    texts, toxic = made()
    index = toxicity.build(np.arange(300), texts, toxic, np.ones(300))
    docs = awkward.documents(
        spark, [(1, "good1 vile2 good3", "en"), (2, "VILE!", "en"), (3, "vilest of all", "en")]
    )
    rows = {
        r["doc_id"]: r["t"]
        for r in docs.select("doc_id", toxicity.score(F.col("text"), index).alias("t")).collect()
    }
    assert "vile*" in rows[1]["terms"] and rows[1]["score"] > 0.5
    assert [n["toxic"] for n in rows[1]["neighbours"]] == [1] * len(rows[1]["neighbours"])
    assert rows[2]["terms"] == [] and rows[2]["score"] < 0.3
    assert rows[3]["terms"] == ["vile*"] and rows[3]["score"] > 0.5


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    labels = spark.createDataFrame(
        [(1, 0, 1), (2, 0, 0), (5, 1, 1), (5, 1, 0), (None, 1, 1), (7, 0, None), (8, 0, 2), (77, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    index = toxicity.train(docs, labels)
    assert index.ids.tolist() == [1, 2, 5] and index.toxic.tolist() == [1, 0, 1]
    rows = docs.select(toxicity.score(F.col("text"), index).alias("t")).select("t.*").collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    none = toxicity.train(docs, labels.limit(0))
    found = docs.select(toxicity.score(F.col("text"), none)["score"].alias("s")).distinct()
    assert [r["s"] for r in found.collect()] == [0.0]
    left = toxicity.tolerable(docs, none)
    assert left.columns == docs.columns and left.count() == 12
    assert toxicity.tolerable(docs.limit(0), index).count() == 0


def test_copies_of_examples_find_them(spark):
    texts, toxic = made()
    # A toxic example whose words are in no other example and tell nothing by themselves.
    texts, toxic = [*texts, b"quite unlike anything elsewhere"], np.append(toxic, 1)
    index = toxicity.build(np.arange(301), texts, toxic, np.ones(301))
    docs = awkward.documents(spark, [(1, "Quite unlike, anything elsewhere!", "en")])
    found = docs.select(toxicity.score(F.col("text"), index).alias("t")).select("t.*").collect()[0]
    assert found["neighbours"][0]["id"] == 300 and found["neighbours"][0]["toxic"] == 1
    assert abs(found["neighbours"][0]["cosine"] - 1) < 1e-9


def test_all_words_are_terms():
    texts = [f"word{i} other{i}".encode() for i in range(400)]
    index = toxicity.build(np.arange(400), texts, np.arange(400) % 2, np.ones(400))
    assert all(len(index.vector([w])[0]) >= 1 for t in texts for w in t.split())


def test_blocks_are_skipped(monkeypatch):
    rng = np.random.default_rng(3)
    # Four kinds of texts whose common words are their own.
    texts = [
        " ".join([*(f"k{i % 4}w{j}" for j in rng.integers(0, 30, 20)), f"rare{i % 50}"]).encode()
        for i in range(1600)
    ]
    index = toxicity.build(np.arange(1600), texts, np.arange(1600) % 2, np.ones(1600))
    assert sorted(index.number[index.number >= 0].tolist()) == list(range(1600))
    assert (index.number[index.position] == np.arange(1600)).all()
    visited = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            visited.append(len(key[1]))
            return np.asarray(self)[key]

    index.dense = index.dense.view(Counted)
    queries = [index.vector(toxicity.words_of(t)) for t in texts[:40]]
    found = index.nearest(queries, 15)
    assert sum(visited) < 0.5 * len(queries) * len(index.block_max.T)
    monkeypatch.setattr(toxicity, "VISITED", 10_000)  # all blocks at once
    for (a, x), (b, y) in zip(found, index.nearest(queries, 15)):
        assert a.tolist() == b.tolist() and np.array_equal(x, y)


def test_query_against_dense_cosines(spark, data):
    """Every text's neighbours, found by brute force over dense vectors of all terms."""
    docs = awkward.table(spark, data)
    training = awkward.table(spark, data, "labels").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    index = toxicity.train(docs, training)
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    dense = np.zeros((len(index.ids), len(index.idf)))
    for row, i in zip(dense, index.ids.tolist()):
        at, weight = index.vector(toxicity.words_of(texts[i]))
        row[at] = weight
    for r in op4_toxicity(spark, data).collect():
        at, weight = index.vector(toxicity.words_of(texts[r["doc_id"]]))
        cosine = (dense[:, at] @ weight).round(12)
        order = np.lexsort((np.arange(len(cosine)), -cosine))
        order = order[cosine[order] > 0][: toxicity.NEIGHBOURS]
        got = r["neighbours"]
        assert np.allclose([n["cosine"] for n in got], cosine[order], atol=1e-11)
        assert {n["id"] for n in got if n["cosine"] > cosine[order].min(initial=2) + 1e-9} == {
            int(index.ids[o]) for o in order if cosine[o] > cosine[order].min() + 1e-9
        }
