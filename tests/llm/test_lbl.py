import math
import zlib
from collections import Counter

import awkward
import numpy as np

from tickspan.llm import lbl
from tickspan.llm.frames import fold
from tickspan.llm.queries import op2_lm_score


def tokens(text):
    return [*(text or "").encode().lower().split(), lbl.END]


def test_query_against_plain_counts(spark, data):
    texts = {r["doc_id"]: r["text"] for r in awkward.table(spark, data).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = Counter(t for i, x in texts.items() if not held[i] for t in tokens(x))
    total, distinct = sum(counts.values()), len(counts)
    rows = op2_lm_score(spark, data).collect()
    assert len(rows) == len(texts)
    gain = 0.0
    for r in rows:
        own = tokens(texts[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"]) == (held[r["doc_id"]], len(own))
        assert r["n_known"] == sum(counts[t] > 0 for t in own)
        assert r["train_tokens"] == total
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        gain += (r["score"] - base) if r["held_out"] else 0.0
    # Texts that were not learned from are likelier under the model than under the counts.
    assert gain > 0.1 * sum(r["n_tokens"] for r in rows if r["held_out"])


def test_probabilities_add_up_to_one(spark, data):
    docs = awkward.table(spark, data).limit(50)
    model, counts, _ = lbl.train(docs)
    targets = np.arange(lbl.OUTPUTS, dtype=np.int32)
    before = np.tile(np.array([[lbl.OUTPUTS, 3, 200, 0]], np.int32), (lbl.OUTPUTS, 1))
    outputs = 10 ** lbl.log_probabilities(model, before, targets)
    assert math.isclose(outputs.sum(), 1, rel_tol=1e-5)
    # Within each class: its known tokens and one unknown.
    inside = np.zeros(lbl.CLASSES) + 0.5
    for r in counts.collect():
        if bytes(r["token"]) not in model.single:
            inside[lbl.class_of(bytes(r["token"])) - lbl.SINGLE_TOKENS] += r["n"] + 0.5
    assert np.allclose(inside, model.class_counts)


def test_tokens_beyond_the_head(spark, data, monkeypatch):
    """The join gives what the head would."""
    docs = awkward.table(spark, data).limit(100)
    model, counts, _ = lbl.train(docs)
    whole = {r["doc_id"]: r for r in lbl.score(docs, model, counts).collect()}
    head = dict(list(model.head.items())[: lbl.SINGLE_TOKENS])
    small = lbl.replace(model, head=head)
    for r in lbl.score(docs, small, counts).collect():
        for name in ("n_known", "base_score", "score"):
            assert math.isclose(r[name], whole[r["doc_id"]][name], rel_tol=1e-6)


def test_extreme_parameters_stay_finite(spark, data):
    model, _, _ = lbl.train(awkward.table(spark, data).limit(5))
    model.weights[-lbl.OUTPUTS :] = -500
    model.weights[-1] = 500
    before = np.full((2, lbl.CONTEXT), lbl.OUTPUTS, np.int32)
    assert np.isfinite(lbl.log_probabilities(model, before, np.array([0, lbl.OUTPUTS - 1]))).all()


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    model, counts, _ = lbl.train(docs.filter(fold("doc_id", 5) != 1))
    rows = lbl.score(docs, model, counts, carried=("lang",)).collect()
    assert len(rows) == 12
    assert all(np.isfinite([r["score"], r["base_score"]]).all() for r in rows)
    empty = {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)}
    assert empty == {1}
    assert lbl.score(docs.limit(0), model, counts).count() == 0


def test_nothing_to_learn_from(spark):
    docs = awkward.documents(spark)
    model, counts, _ = lbl.train(docs.limit(0))
    rows = lbl.score(docs, model, counts).collect()
    assert all(math.isclose(r["base_score"], 0, abs_tol=1e-9) for r in rows)
    assert all(np.isfinite(r["score"]) and r["n_known"] == 0 for r in rows)


def test_scores_do_not_hang_on_partitions(spark, data, monkeypatch):
    monkeypatch.setattr(lbl, "SHARD_TOKENS", 20_000)
    docs = awkward.table(spark, data).limit(120)
    found = []
    for parts in (1, 7):
        model, counts, _ = lbl.train(docs.repartition(parts))
        rows = lbl.score(docs.repartition(parts), model, counts).collect()
        found.append({r["doc_id"]: r["score"] for r in rows})
    assert found[0].keys() == found[1].keys()
    assert all(math.isclose(found[0][i], found[1][i], rel_tol=1e-5) for i in found[0])
