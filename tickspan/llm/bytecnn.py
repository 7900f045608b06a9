"""Language ID by a byte convolutional network.

Bytes have vectors; filters of three widths run over them, each filter's maximum over a window is
kept, and a softmax over the languages follows. It is trained in numpy (Adam) on windows of a
bounded sample of labelled texts. As its inputs are bytes, a filter is a sum of rows of tables by
byte pair; prediction uses such tables, the same function with far fewer multiplications.

A text is cut into windows of WINDOW bytes that cover all of it; its languages' log
probabilities are the windows' means, each weighed by its bytes.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import flat, lean

#: Bytes of a window, and windows that are worked on at once.
WINDOW = 256
STEP_WINDOWS = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
VECTOR = 8
#: Bounds of the sample: texts of a language and of all languages, windows of a text.
TEXTS_PER_LANGUAGE = 1500
TEXTS = 96_000
WINDOWS_PER_TEXT = 3
EPOCHS = 6
MINI_BATCH = 64
#: What a text gets that is null or has no letter.
UNDETERMINED = "und"


@dataclass
class Network:
    """Byte vectors, filters by width, and the last layer; `languages` names the outputs."""

    languages: list[str]
    vectors: np.ndarray  # 256 x VECTOR
    filters: list[np.ndarray]  # for each width: width * VECTOR x FILTERS
    biases: list[np.ndarray]
    weights: np.ndarray  # len(WIDTHS) * FILTERS x languages
    offsets: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.vectors, *self.filters, *self.biases, self.weights, self.offsets]


def start(languages: list[str], seed: int = 11) -> Network:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return Network(
        languages,
        normal(256, VECTOR, scale=0.5),
        [normal(w * VECTOR, FILTERS, scale=(w * VECTOR) ** -0.5) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        normal(len(WIDTHS) * FILTERS, len(languages), scale=0.3),
        np.zeros(len(languages), np.float32),
    )


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _unfolded(vectors: np.ndarray, width: int) -> np.ndarray:
    """All runs of `width` byte vectors of each window: n x places x width * VECTOR."""
    n, length, size = vectors.shape
    places = length - width + 1
    return np.concatenate([vectors[:, j : j + places] for j in range(width)], axis=2)


def slopes(net: Network, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy, in the order of net.arrays()."""
    n = len(windows)
    looked = net.vectors[windows]
    pooled, tops, runs = [], [], []
    for filters, bias, width in zip(net.filters, net.biases, WIDTHS):
        run = _unfolded(looked, width)
        out = run @ filters
        top = out.argmax(axis=1)
        pooled.append(np.take_along_axis(out, top[:, None, :], 1)[:, 0] + bias)
        tops.append(top)
        runs.append(run)
    hidden = np.concatenate(pooled, axis=1)
    active = np.maximum(hidden, 0)
    error = softmax(active @ net.weights + net.offsets)
    error[np.arange(n), labels] -= 1
    error /= n
    back = (error @ net.weights.T) * (hidden > 0)
    d_vectors = np.zeros_like(net.vectors)
    d_filters, d_biases = [], []
    for k, (filters, top, run, width) in enumerate(zip(net.filters, tops, runs, WIDTHS)):
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        best = run[np.arange(n)[:, None], top]  # n x FILTERS x width * VECTOR
        d_filters.append(np.einsum("nf,nfv->vf", own, best))
        d_biases.append(own.sum(0))
        d_run = (own[:, :, None] * filters.T).reshape(n, FILTERS, width, VECTOR)
        for j in range(width):
            np.add.at(d_vectors, windows[np.arange(n)[:, None], top + j], d_run[:, :, j])
    return [d_vectors, *d_filters, *d_biases, active.T @ error, error.sum(0)]


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 5) -> Network:
    """Adam on mini-batches; every language weighs the same by drawing its windows as often."""
    net, rng = start(languages), np.random.default_rng(seed)
    arrays = net.arrays()
    means = [np.zeros_like(a) for a in arrays]
    squares = [np.zeros_like(a) for a in arrays]
    by_label = [np.flatnonzero(labels == k) for k in range(len(languages))]
    by_label = [b for b in by_label if len(b)]
    most, t = max(map(len, by_label)), 0
    total = -(-most * len(by_label) // MINI_BATCH) * EPOCHS
    for _ in range(EPOCHS):
        order = np.concatenate([rng.permutation(np.resize(rng.permutation(b), most)) for b in by_label])
        order = rng.permutation(order)
        for at in range(0, len(order), MINI_BATCH):
            part = order[at : at + MINI_BATCH]
            t += 1
            rate = 0.01 * (1 - 0.95 * t / total)
            for a, m, s, g in zip(arrays, means, squares, slopes(net, windows[part], labels[part])):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                a -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-7)
    return net


class Tables:
    """The filters as sums of rows by byte pair, so a window costs look-ups and maxima."""

    def __init__(self, net: Network):
        self.net = net
        v = net.vectors

        def rows(k: int, j: int) -> np.ndarray:
            return v @ net.filters[k][j * VECTOR : (j + 1) * VECTOR]

        def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (a[:, None] + b[None, :]).reshape(65536, FILTERS)

        # By the pair that begins at a place: width 2; the first two bytes of widths 3 and 4.
        # By the pair two places on: the third byte of width 3 and the last two of width 4.
        none = np.zeros((256, FILTERS), np.float32)
        self.here = np.concatenate(
            [pairs(rows(k, 0), rows(k, 1)) for k in range(3)], axis=1, dtype=np.float32
        )
        self.later = np.concatenate(
            [pairs(rows(1, 2), none), pairs(rows(2, 2), rows(2, 3))], axis=1, dtype=np.float32
        )

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Log softmax of each window of equally many bytes, four at least."""
        pair = windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]
        places = windows.shape[1] - 3
        here = self.here.take(pair, 0)
        pooled = here[:, :, :FILTERS].max(axis=1)
        longer = here[:, :places, FILTERS:]
        longer += self.later.take(pair[:, 2:], 0)
        # Width 3 has one place more than width 4; its last byte pair lies across the end.
        last = here[:, places, FILTERS : 2 * FILTERS]
        last = last + self.later[windows[:, -1].astype(np.int32) << 8, :FILTERS]
        longer = longer.max(axis=1)
        three = np.maximum(longer[:, :FILTERS], last)
        hidden = np.concatenate([pooled, three, longer[:, FILTERS:]], axis=1)
        active = np.maximum(hidden + np.concatenate(self.net.biases), 0)
        out = active @ self.net.weights + self.net.offsets
        top = out.max(axis=1, keepdims=True)
        return out - top - np.log(np.exp(out - top).sum(axis=1, keepdims=True))


def windows_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that cover all texts: where each begins, its text, and its bytes that are new.

    A text's last window ends with the text and so overlaps the one before; a text shorter than a
    window has one, padded with blanks.
    """
    lengths = np.diff(bounds)
    counts = np.maximum(1, -(-lengths // WINDOW))
    text = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = number * WINDOW
    fresh = np.minimum(WINDOW, lengths[text] - begin)
    begin = np.minimum(begin, np.maximum(0, lengths[text] - WINDOW))
    return bounds[:-1][text] + begin, text, fresh


def cut(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of windows; what lies beyond a text's end is blank."""
    place = begins[:, None] + np.arange(WINDOW)
    out = np.append(data, np.uint8(32))[np.minimum(place, len(data))]
    out[place >= ends[:, None]] = 32
    return out


def _has_letter(text: bytes) -> bool:
    return any(unicodedata.category(c)[0] == "L" for c in text.decode())


ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True


def predict(text: Column, net: Network) -> Column:
    """struct<lang_pred: string, score: double> of a text column; the whole text counts.

    score is the probability of the language that is predicted. Null, empty and other texts
    without a letter give `und` and 0.
    """

    @F.arrow_udf("struct<lang_pred:string, score:double>")
    @lean()
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = Tables(net)
        for batch in batches:
            data, bounds = flat(batch)
            n = len(bounds) - 1
            begins, text, fresh = windows_of(data, bounds)
            total = np.zeros((n, len(net.languages)))
            for a in range(0, len(begins) if net.languages else 0, STEP_WINDOWS):
                own = text[a : a + STEP_WINDOWS]
                part = cut(data, begins[a : a + STEP_WINDOWS], bounds[1:][own])
                logs = tables.log_probabilities(part) * fresh[a : a + STEP_WINDOWS, None]
                np.add.at(total, own, logs)
            lengths = np.maximum(1, np.diff(bounds))
            share = softmax(total / lengths[:, None]) if len(net.languages) else total
            letters = np.add.reduceat(
                np.append(ASCII_LETTER[data], False), np.minimum(bounds[:-1], len(data))
            ) > 0 if n else np.zeros(0, bool)
            letters &= np.diff(bounds) > 0
            for i in np.flatnonzero(~letters & (np.diff(bounds) > 0)).tolist():
                letters[i] = _has_letter(data[bounds[i] : bounds[i + 1]].tobytes())
            if not net.languages:
                letters[:] = False
            best = share.argmax(axis=1) if len(net.languages) else np.zeros(n, np.int64)
            names = [
                net.languages[b] if ok else UNDETERMINED
                for b, ok in zip(best.tolist(), letters.tolist())
            ]
            scores = [
                float(share[i, b]) if ok else 0.0
                for i, (b, ok) in enumerate(zip(best.tolist(), letters.tolist()))
            ]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["lang_pred", "score"],
            )

    return run(text)


def sample(
    docs: DataFrame, key: str, text_column: str, label_column: str
) -> tuple[list[str], list[bytes], list[str]]:
    """The languages, and windows with their languages, of a bounded sample of labelled texts.

    All languages are learned; of each, the texts with the smallest hashes of their keys, and of
    each text a few windows at places that its hash draws. With many languages each has fewer
    texts, one at least.
    """
    labelled = docs.select(
        F.col(key).alias("k"), F.col(text_column).alias("t"), F.col(label_column).alias("l")
    ).filter("l IS NOT NULL AND length(t) > 0")
    counts = labelled.groupBy("l").count().collect()
    total = {row["l"]: row["count"] for row in counts}
    if not total:
        return [], [], []
    most = max(1, min(TEXTS_PER_LANGUAGE, TEXTS // len(total)))
    # More than 1.5 times the texts wanted pass by their hash; the smallest hashes of them are
    # taken. A few more, so that no language is left without any.
    share = F.create_map(
        *[F.lit(x) for lang, c in total.items() for x in (lang, (1.5 * most + 30) / c)]
    )
    draw = F.pmod(F.xxhash64("k", "t"), F.lit(1 << 40)) / float(1 << 40)
    drawn = labelled.withColumn("draw", draw).filter(F.col("draw") < F.element_at(share, F.col("l")))
    places = [
        F.pmod(F.xxhash64("k", F.lit(i)), F.greatest(F.lit(1), F.length("t") - WINDOW)).cast("int") + 1
        for i in range(WINDOWS_PER_TEXT)
    ]
    cuts = F.array(*[F.col("t").substr(p, F.lit(WINDOW)) for p in places])
    rows = (
        drawn.select("l", "draw", "k", cuts.alias("windows"))
        .groupBy("l")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("draw", "k", "windows"))), 1, most).alias("r"))
        .collect()
    )
    found = [(row["l"], w) for row in rows for text in row["r"] for w in dict.fromkeys(text["windows"])]
    found.sort()
    return sorted(total), [w.encode() for _, w in found], [lang for lang, _ in found]


def train(
    docs: DataFrame, key: str = "doc_id", text_column: str = "text", label_column: str = "lang"
) -> Network:
    """A network that tells the languages of `label_column` apart.

    Rows of null language, null or empty text are not learned from. Without any other row the
    network has no language, and all texts are undetermined.
    """
    languages, texts, labels = sample(docs, key, text_column, label_column)
    if not texts:
        return start([])
    windows = np.full((len(texts), WINDOW), 32, np.uint8)
    for row, text in zip(windows, texts):
        part = np.frombuffer(text[:WINDOW], np.uint8)
        row[: len(part)] = part
    number = {lang: i for i, lang in enumerate(languages)}
    return fit(windows, np.array([number[x] for x in labels]), languages)


def determined(
    docs: DataFrame, net: Network, text_column: str = "text", least: float = 0.3
) -> DataFrame:
    """The rows whose text has a language that the network knows with a score of `least`.

    Texts without a letter go, null and empty ones too; all columns stay as they are.
    """
    found = predict(F.col(text_column), net)
    return docs.filter((found["lang_pred"] != UNDETERMINED) & (found["score"] >= least))
