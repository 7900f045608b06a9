import awkward
import numpy as np

from tickspan.llm import tiling

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"


def rows(df):
    return {(r["doc_id"], r["item_id"]): r for r in df.collect()}


def brute_tiles(item, text, least):
    """Greedy string tiling by comparing all places."""
    in_item, in_text, out = [False] * len(item), [False] * len(text), []
    for size in range(min(len(item), len(text)), least - 1, -1):
        for i in range(len(item) - size + 1):
            for j in range(len(text) - size + 1):
                if (
                    item[i : i + size] == text[j : j + size]
                    and not any(in_item[i : i + size])
                    and not any(in_text[j : j + size])
                ):
                    in_item[i : i + size] = in_text[j : j + size] = [True] * size
                    out.append((i, j, size))
    return out


def test_tiles_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(300):
        item = rng.integers(0, 6, rng.integers(0, 25)).astype(np.uint64)
        text = rng.integers(0, 6, rng.integers(0, 40)).astype(np.uint64)
        least = int(rng.integers(2, 5))
        found = tiling.tiles(item, text, least)
        assert found == brute_tiles(item.tolist(), text.tolist(), least)


def test_reordered_and_changed_passages(spark):
    words = ITEM.split()
    moved = " ".join(words[8:] + ["and", "then"] + words[:8])
    docs = awkward.documents(
        spark,
        [
            (1, f"before {ITEM.upper()}. After", "en"),
            (2, f"some {moved} more", "en"),
            (3, "alpha beta gamma delta and nothing else of it", "en"),
            (4, " ".join(w if i % 3 else "x" for i, w in enumerate(words)), "en"),
            (None, ITEM, "en"),
        ],
    )
    items = spark.createDataFrame(
        [(7, ITEM), (8, None), (9, ""), (10, "too short"), (None, ITEM), (11, "la " * 12)],
        "item_id long, text string",
    )
    got = rows(tiling.contamination(docs, items))
    assert set(got) == {(1, 7), (2, 7)}
    assert got[1, 7]["coverage"] == 1.0 and len(got[1, 7]["tiles"]) == 1
    assert sorted(t["words"] for t in got[2, 7]["tiles"]) == [8, 8]
    left = tiling.clean_documents(docs, tiling.contamination(docs, items))
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 3, 4]


def test_item_that_repeats_its_seeds(spark):
    docs = awkward.documents(spark, [(1, "so la la la la la la la la la la la la it is", "en")])
    items = spark.createDataFrame([(11, "la " * 12)], "item_id long, text string")
    assert set(rows(tiling.contamination(docs, items))) == {(1, 11)}


def test_against_brute_force_on_tables(spark, data):
    docs, items = awkward.table(spark, data), awkward.table(spark, data, "benchmark")
    got = rows(tiling.contamination(docs, items))

    def hashed(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return tiling.hashed_words(raw, np.array([0, len(raw)]))[0]

    own = {r["item_id"]: hashed(r["text"]) for r in items.collect()}
    wanted = {}
    for r in docs.filter("n_chars < 6000").collect():
        text = hashed(r["text"])
        for item, words in own.items():
            if np.isin(words, text).mean() < tiling.COVERAGE:
                continue
            matched = sum(t[2] for t in tiling.tiles(words, text, tiling.MIN_TILE))
            if matched >= tiling.COVERAGE * len(words):
                wanted[r["doc_id"], item] = matched / len(words)
    small = {r["doc_id"] for r in docs.filter("n_chars < 6000").select("doc_id").collect()}
    assert {k: r["coverage"] for k, r in got.items() if k[0] in small} == wanted
    assert wanted


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    items = spark.createDataFrame([(1, "the of and the of and the of and")], "item_id long, text string")
    assert set(rows(tiling.contamination(docs, items))) == {(7, 1)}
    assert tiling.contamination(docs.limit(0), items).count() == 0
    assert tiling.contamination(docs, items.limit(0)).count() == 0


def test_short_items_and_unspaced_scripts(spark):
    chinese, japanese = "太阳系中体积最大的行星是哪一颗？", "富士山の高さはどれくらいですか。日本で一番高い山です。"
    docs = awkward.documents(
        spark,
        [
            (1, "asked: who Wrote Hamlet? nobody", "en"),
            (2, "who has wrote of Hamlet", "en"),
            (3, "Photosynthesis", "en"),
            (4, f"前言{chinese}后记", "zh"),
            (5, f"say {japanese}と言う", "ja"),
            (6, "太阳能是一种清洁的能源", "zh"),
            (7, ITEM, "en"),
        ],
    )
    items = spark.createDataFrame(
        [(1, "Who wrote Hamlet"), (2, "photosynthesis?"), (3, chinese), (4, japanese), (5, "東京"), (6, "!?")],
        "item_id long, text string",
    )
    got = rows(tiling.contamination(docs, items))
    assert set(got) == {(1, 1), (3, 2), (4, 3), (5, 4)}
    assert all(r["coverage"] == 1.0 for r in got.values())
    assert (got[1, 1]["item_words"], got[3, 2]["item_words"]) == (3, 1)
    assert set(rows(tiling.contamination(docs, items.filter("item_id = 2")))) == {(3, 2)}


def test_words_of_mixed_scripts():
    texts = ["ab漢字cd", "é漢", "漢é", "𠀋x", "", "한국어 말", "ก"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, first = tiling.word_spans(data, np.cumsum([0, *map(len, raw)]))
    words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert words == ["ab", "漢", "字", "cd", "é", "漢", "漢", "é", "𠀋", "x", "한국어", "말", "ก"]
    assert first.tolist() == [0, 4, 6, 8, 10, 10, 12, 13]
