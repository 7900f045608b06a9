import base64
import hashlib
import random

import awkward
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tickspan.llm import bpe
from tickspan.llm.queries import VOCABULARY, op5_byte_bpe

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe._read(PATH))


def ids(vocab, texts):
    return [x.tolist() for x in bpe._encoded(vocab, pa.array(texts, pa.string()))]


def test_classes_are_those_of_the_library():
    single = {bytes([i]): i for i in range(256)}
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    kinds = bpe.classes()
    for pattern, own in (
        (r"\p{L}", kinds <= bpe.EE),
        (r"\p{N}", kinds == bpe.NUMBER),
        (r"\s", (kinds == bpe.BLANK) | (kinds == bpe.SPACE)),
    ):
        e = tiktoken.Encoding("c", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = set(map(ord, e.decode(e.encode_ordinary(text))))
        assert found == set(np.flatnonzero(own).tolist()) & set(points)


def test_composition_is_associative_and_closed():
    functions, table, members = bpe.automaton()
    size = len(members)
    grid = table.reshape(size, size)
    for a in range(size):
        for b in range(size):
            assert (members[grid[a, b]] == members[b][members[a]]).all()
    rng = np.random.default_rng(0)
    some = functions[rng.integers(0, 11, 10_000)]
    found, state = bpe.scanned(some, table), 0
    for f, g in zip(some, found):
        state = members[f][state]
        assert members[g][0] == state


def test_random_texts_as_the_library(vocab, library):
    rng = random.Random(3)
    parts = (
        "' s t re ve ll l r v e m d S ! ? | 1 ² é ß 漢 字 😀 ́ 's 'll 're x \x1c \x85 A".split(" ")
        + [" ", "  ", "\n", "\t", " ", "　"]
    )
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(20_000)]
    assert ids(vocab, texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 3000, " " * 2000 + "b", "ab" * 900 + "'s", "é" * 700, ""])
def test_long_pieces(vocab, library, text):
    assert ids(vocab, [text, "x", text]) == [
        library.encode_ordinary(t) for t in (text, "x", text)
    ]


def test_more_pieces_than_the_cache_holds(vocab, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 64)
    small = bpe.Vocabulary(bpe._read(PATH))
    text = " ".join(f"w{i * 7919 % 10007}x" for i in range(2000))
    assert ids(small, [text, "b", text]) == [library.encode_ordinary(t) for t in (text, "b", text)]


def test_clash_of_hashes_is_mended(library):
    small = bpe.Vocabulary(bpe._read(PATH))
    ids(small, ["hello there"])
    small.store[: small.used] = 7  # as if other pieces had the same hashes
    assert ids(small, ["hello there"]) == [library.encode_ordinary("hello there")]


def test_query_as_the_library(spark, data, library):
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.table(spark, data).collect()}
    rows = op5_byte_bpe(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        own = library.encode_ordinary(text)
        assert r["n_tokens"] == len(own)
        assert r["ids_sha256"] == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_awkward_rows_and_spans(spark, library):
    docs = awkward.documents(spark)
    rows = docs.select("text", bpe.encode(F.col("text"), PATH).alias("e")).select(
        "text", "e.*", bpe.decode(F.col("e.ids"), PATH).alias("back")
    )
    found = rows.collect()
    assert len(found) == 12
    for r in found:
        text = r["text"] or ""
        assert r["ids"] == library.encode_ordinary(text)
        assert bytes(r["back"]) == text.encode()
        assert r["offsets"][0] == 0 and r["offsets"][-1] == len(text.encode())
        if len(r["ids"]) > 3:
            a, b = r["offsets"][1], r["offsets"][3]
            assert library.decode_bytes(r["ids"][1:3]) == text.encode()[a:b]
    assert bpe.encoded_documents(docs, PATH).count() == 12
    assert bpe.encoded_documents(docs.limit(0), PATH).count() == 0
