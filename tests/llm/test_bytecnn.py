from collections import Counter

import zlib

import awkward
import numpy as np
from pyspark.sql import functions as F

from tickspan.llm import bytecnn
from tickspan.llm.queries import op3_language_id


def test_held_out_accuracy(spark, data):
    langs = {r["doc_id"]: r["lang"] for r in awkward.table(spark, data).collect()}
    rows = op3_language_id(spark, data).collect()
    assert len(rows) == len(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == langs[r["doc_id"]] for r in held)
    assert right >= 0.96 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def network():
    rng = np.random.default_rng(0)
    net = bytecnn.start(["a", "b", "c"])
    net.vectors += rng.normal(0, 1, net.vectors.shape).astype(np.float32)
    return net


def test_tables_are_the_filters():
    net, rng = network(), np.random.default_rng(1)
    windows = rng.integers(0, 256, (40, bytecnn.WINDOW)).astype(np.uint8)
    looked = net.vectors[windows]
    pooled = [
        (bytecnn._unfolded(looked, w) @ f).max(axis=1) + b
        for w, f, b in zip(bytecnn.WIDTHS, net.filters, net.biases)
    ]
    hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
    wanted = np.log(bytecnn.softmax(hidden @ net.weights + net.offsets))
    assert np.allclose(bytecnn.Tables(net).log_probabilities(windows), wanted, atol=1e-4)


def test_slopes_against_differences():
    net, rng = network(), np.random.default_rng(2)
    windows = rng.integers(0, 256, (3, 12)).astype(np.uint8)
    labels = np.array([0, 2, 1])

    def loss():
        looked = net.vectors[windows]
        pooled = [
            (bytecnn._unfolded(looked, w) @ f).max(axis=1) + b
            for w, f, b in zip(bytecnn.WIDTHS, net.filters, net.biases)
        ]
        hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
        p = bytecnn.softmax((hidden @ net.weights + net.offsets).astype(np.float64))
        return -np.log(p[np.arange(3), labels]).mean()

    for array, slope in zip(net.arrays(), bytecnn.slopes(net, windows, labels)):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        keep, step = array[at], 1e-2
        array[at] = keep + step
        up = loss()
        array[at] = keep - step
        down = loss()
        array[at] = keep
        assert abs((up - down) / (2 * step) - slope[at]) < 0.02 + 0.1 * abs(slope[at])


def test_windows_cover_each_byte_once():
    lengths = np.array([0, 1, 255, 256, 257, 5000])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    begins, text, fresh = bytecnn.windows_of(np.zeros(bounds[-1], np.uint8), bounds)
    assert np.bincount(text, fresh).tolist() == lengths.tolist()
    for b, t in zip(begins, text):
        assert bounds[t] <= b and b + min(256, lengths[t]) <= bounds[t + 1]


def test_end_of_a_long_text_counts(spark, data):
    net = bytecnn.train(awkward.table(spark, data))
    english = "the and of to in that is it was for on with as be by this are from " * 300
    german = "der die und den von zu das mit sich des auf für ist im dem nicht ein eine " * 300
    docs = awkward.documents(spark, [(1, english + german, None), (2, english, None)])
    score = {
        r["doc_id"]: r["p"]["score"]
        for r in docs.select("doc_id", bytecnn.predict(F.col("text"), net).alias("p")).collect()
    }
    assert score[1] < score[2]


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    net = bytecnn.train(docs)
    rows = docs.select("doc_id", "text", bytecnn.predict(F.col("text"), net).alias("p")).collect()
    assert len(rows) == 12
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["p"]["lang_pred"] == "und") == (not letters)
    left = bytecnn.determined(docs, net)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()}.isdisjoint({2, 3, 4, 8})
    none = bytecnn.train(docs.limit(0))
    assert none.languages == []
    found = docs.select(bytecnn.predict(F.col("text"), none).alias("p")).select("p.*").distinct()
    assert [tuple(r) for r in found.collect()] == [("und", 0.0)]
    assert docs.limit(0).select(bytecnn.predict(F.col("text"), net)).count() == 0


def test_all_languages_are_learned(spark, monkeypatch):
    rng = np.random.default_rng(3)
    # 80 languages of ten characters each, all in another part of Unicode.
    rows = []
    for lang in range(80):
        letters = [chr(0x4E00 + 64 * lang + i) for i in range(10)] + [" "]
        for k in range(8 if lang < 70 else 6):
            rows.append((100 * lang + k, "".join(rng.choice(letters, 300)), f"l{lang:02}"))
    docs = awkward.documents(spark, rows)
    languages, texts, labels = bytecnn.sample(docs, "doc_id", "text", "lang")
    assert languages == sorted({r[2] for r in rows}) == sorted(set(labels))
    net = bytecnn.train(docs)
    found = docs.select("lang", bytecnn.predict(F.col("text"), net)["lang_pred"].alias("p")).collect()
    assert {r["p"] for r in found} >= {f"l{lang:02}" for lang in range(70, 80)}
    assert sum(r["lang"] == r["p"] for r in found) > 0.9 * len(found)
    monkeypatch.setattr(bytecnn, "TEXTS", 160)
    monkeypatch.setattr(bytecnn, "WINDOWS_PER_TEXT", 1)
    assert set(Counter(bytecnn.sample(docs, "doc_id", "text", "lang")[2]).values()) == {2}
    monkeypatch.setattr(bytecnn, "TEXTS", 1)
    assert set(Counter(bytecnn.sample(docs, "doc_id", "text", "lang")[2]).values()) == {1}
