"""Language model scores by a log-bilinear model, trained by noise-contrastive estimation.

Tokens are counted over all training texts. The most frequent ones (SINGLE_TOKENS) are units of
their own; all others are united by class, a hash of their last two bytes, and have their smoothed
share of the count of their class's rest. Units are predicted in two steps: the first softmax is
over the most frequent units (FIRST) and the classes, the second one over the units of a class and
its rest. So every token, known or not, has a probability, and those of all known tokens and of
one unknown per class add up to one:

    P(token | context) = softmax(q . r + b)[class] * softmax over the class(q . s + c)[unit] * share
    q = sum over the last words of (their unit's vector * the weights of their place)

Both steps are trained by noise-contrastive estimation with noise that a mini-batch (of a class)
shares, so neither needs normalisation there. Scoring normalises exactly, with matrix products
over many texts.

Training texts are dealt to shards of about SHARD_TOKENS tokens by a hash of key and text and are
sorted there, so what a shard learns, and the score, hang on the table alone and not on how it is
partitioned. Each shard starts from the same parameters (the exact log shares as biases); the
shards' parameters are averaged by their numbers of tokens as a grouped sum in Spark.

The counts of frequent tokens travel to the tasks (HEAD_TOKENS at most); those of all others are
joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import as_table
from .frames import lean, texts_of

#: Tokens whose counts every task holds, and the longest such token in bytes: 3 MB at most.
HEAD_TOKENS = 65_536
HEAD_BYTES = 48
STEPS_PER_DOUBLING = 64
#: Units of single tokens, and classes, each with a unit for the rest of its tokens.
SINGLE_TOKENS = 1024
CLASSES = 96
OUTPUTS = SINGLE_TOKENS + CLASSES
#: Units that the first step predicts by themselves, before the classes.
FIRST = 32
#: Words of context, numbers of a word's vector, tokens of a mini-batch; noise words of a
#: mini-batch in the first step, and of a class in the second one.
CONTEXT = 3
WIDTH = 12
MINI_BATCH = 2048
NOISE = 16
CLASS_NOISE = 32
RATE = 0.1
#: Where AdaGrad's sums of squares start in the second step, whose units are rarer.
CLASS_SQUARE = 1e-4
#: Tokens that are gathered, mixed, and given to the mini-batches; tokens of a shard, about.
GATHERED = 1 << 16
SHARD_TOKENS = 1 << 22
#: Tasks of one training at most; a task of several shards trains one after the other.
SHARD_TASKS = 100_000
#: Tokens that a task counts before it hands the counts on.
COUNTED = 200_000
#: Tokens that are scored at once.
SCORED = 512
#: The end of a text; no word is empty.
END = b""


def words_of(text: bytes) -> list[bytes]:
    """A-Z in lower case, cut at ASCII white space."""
    return text.lower().split()


def class_of(token: bytes) -> int:
    """The unit of a token that has none of its own: by its last two bytes."""
    return SINGLE_TOKENS + zlib.crc32(token[-2:]) % CLASSES


class Classes(dict):
    """Units by last two bytes, so that each pair of bytes is hashed once."""

    def __missing__(self, ending: bytes) -> int:
        self[ending] = class_of(ending)
        return self[ending]


@dataclass
class Model:
    """Parameters and the counts that scores need.

    `head` maps frequent tokens to their counts, `single` the most frequent of them to units;
    `class_counts` are the smoothed counts of the classes' rests. `weights` has the parameters in a
    row: unit vectors (one more for before the text), weights of the context's places, vectors and
    biases of the first step, then of the second one by unit.
    """

    tokens: int
    distinct: int
    head: dict[bytes, int]
    single: dict[bytes, int]
    class_counts: np.ndarray
    weights: np.ndarray

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        first = FIRST + CLASSES
        sizes = [
            (first + 1, WIDTH), (CONTEXT, WIDTH), (first, WIDTH), (first,), (OUTPUTS, WIDTH), (OUTPUTS,)
        ]
        cuts = np.cumsum([int(np.prod(s)) for s in sizes])[:-1]
        return tuple(p.reshape(s) for p, s in zip(np.split(self.weights, cuts), sizes))

    def first_outputs(self) -> np.ndarray:
        """The output of the first step of each unit; -1 for units that no token has."""
        out = np.full(OUTPUTS, -1, np.int64)
        for token, unit in self.single.items():
            out[unit] = unit if unit < FIRST else FIRST + class_of(token) - SINGLE_TOKENS
        out[SINGLE_TOKENS:] = FIRST + np.arange(CLASSES)
        return out

    def context_rows(self) -> np.ndarray:
        """The vector of each unit, and of before the text, as a word of context."""
        return np.append(self.first_outputs(), FIRST + CLASSES)


def members_of(first: np.ndarray) -> list[np.ndarray]:
    """The units of each class, its rest last."""
    return [
        np.flatnonzero((first == FIRST + c) & (np.arange(OUTPUTS) >= FIRST)) for c in range(CLASSES)
    ]


class Numbers:
    """Units of tokens, with those of the head's tokens made once."""

    def __init__(self, model: Model):
        self.places = {t: i for i, t in enumerate(model.head)}
        self.classes = Classes()
        own = model.single
        self.outputs = np.array(
            [own[t] if t in own else class_of(t) for t in self.places] or [0], np.int32
        )

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Places in the head (or -1) and units of the words and END; the tokens not there."""
        end = self.places.get(END, -1)
        found = chain(map(self.places.get, words, repeat(-1)), (end,))
        at = np.fromiter(found, np.int64, len(words) + 1)
        outputs = self.outputs[at]
        missing = np.flatnonzero(at < 0)
        lost = [words[i] if i < len(words) else END for i in missing.tolist()]
        classes = self.classes
        outputs[missing] = [classes[w[-2:]] for w in lost]
        return at, outputs, lost


def start_weights(shares: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Small random vectors; biases are the log shares, in the second step those in the class."""
    rng = np.random.default_rng(7)
    outer = first_shares(shares, first)
    inner = shares / np.maximum(outer[first], 1e-300)
    vectors = rng.normal(0, 0.1, (FIRST + CLASSES + 1) * WIDTH)
    places = np.full(CONTEXT * WIDTH, 1.0 / CONTEXT)
    outputs = rng.normal(0, 0.1, (FIRST + CLASSES) * WIDTH)
    inside = np.zeros(OUTPUTS * WIDTH)
    parts = [vectors, places, outputs, _log(outer), inside, _log(inner)]
    return np.concatenate(parts).astype(np.float32)


def _log(shares: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(shares, 1e-30))


def first_shares(shares: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The shares of the outputs of the first step, from those of the units."""
    return np.bincount(first[first >= 0], shares[first >= 0], FIRST + CLASSES)


def contexts(texts: list[np.ndarray]) -> np.ndarray:
    """The CONTEXT units before each token of the texts in a row; OUTPUTS stands before a text."""
    before = np.full(CONTEXT, OUTPUTS, np.int32)
    padded = np.concatenate([x for ids in texts for x in (before, ids)])
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.arange(lengths.sum()) + np.repeat(CONTEXT * np.arange(len(texts)), lengths)
    return np.lib.stride_tricks.sliding_window_view(padded, CONTEXT)[at]


class Trainer:
    """Noise-contrastive estimation with AdaGrad, one mini-batch after the other."""

    def __init__(self, model: Model, shares: np.ndarray, seed: int):
        self.model = replace(model, weights=model.weights.copy())
        self.parts = self.model.parts()
        self.squares = [np.full(p.shape, 1e-6, np.float32) for p in self.parts[:4]]
        self.squares += [np.full(p.shape, CLASS_SQUARE, np.float32) for p in self.parts[4:]]
        self.first = self.model.first_outputs()
        self.context = self.model.context_rows()
        outer = first_shares(shares, self.first)
        self.log_noise = _log(NOISE * outer).astype(np.float32)
        self.cumulative = np.cumsum(outer)
        self.members = members_of(self.first)
        self.log_inner = _log(CLASS_NOISE * shares / np.maximum(outer[self.first], 1e-300))
        self.log_inner = self.log_inner.astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.tokens = 0

    def learn(self, texts: list[np.ndarray]) -> None:
        """All tokens of the texts in a random order, mini-batch by mini-batch."""
        targets, rows = np.concatenate(texts), self.context[contexts(texts)]
        order = self.rng.permutation(len(targets))
        targets, rows = targets[order], rows[order]
        outer = self.first[targets]
        for a in range(0, len(order), MINI_BATCH):
            self.step(rows[a : a + MINI_BATCH], outer[a : a + MINI_BATCH])
        at = np.flatnonzero(outer >= FIRST)
        at = at[np.argsort(outer[at].astype(np.uint8), kind="stable")]
        q = np.ones((len(at), WIDTH + 1), np.float32)
        q[:, :WIDTH] = self.predicted(rows[at])[0]
        cuts = np.searchsorted(outer[at], np.arange(FIRST, FIRST + CLASSES + 1))
        for c, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if b > a:
                self.class_step(c, q[a:b], targets[at[a:b]])
        self.tokens += len(targets)

    def predicted(self, before: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        vectors, places, *_ = self.parts
        rows = [vectors.take(before[:, c], 0) for c in range(CONTEXT)]
        return sum(row * place for row, place in zip(rows, places)), rows

    def step(self, before: np.ndarray, target: np.ndarray) -> None:
        """The first step's slopes, which train the units' vectors as well."""
        _, places, outputs, biases, *_ = self.parts
        n, size = len(target), len(biases)
        q, rows = self.predicted(before)
        noise = np.searchsorted(self.cumulative, self.rng.random(NOISE) * self.cumulative[-1])
        noise = np.minimum(noise, size - 1)
        own = outputs.take(target, 0)
        up, down = _slopes(q, own, biases - self.log_noise, outputs, target, noise)
        d_q = up[:, None] * own + down @ outputs[noise]
        d_out = _summed(target, up[:, None] * q, size)
        np.add.at(d_out, noise, down.T @ q)
        d_bias = np.bincount(target, up, size) + np.bincount(noise, down.sum(0), size)
        d_places = np.stack([np.einsum("nw,nw->w", d_q, row) for row in rows])
        d_rows = (d_q[:, None, :] * places).reshape(-1, WIDTH)
        d_vectors = _summed(before.ravel(), d_rows, size + 1)
        for part, square, slope in zip(self.parts, self.squares, (d_vectors, d_places, d_out, d_bias)):
            _moved(part, square, slope / n)

    def class_step(self, c: int, q: np.ndarray, target: np.ndarray) -> None:
        """The second step's slopes for tokens of one class, with the expected noise of each unit.

        The last number of each row of `q` is 1, for the biases.
        """
        *_, outputs, biases = self.parts
        own = self.members[c]
        at = np.searchsorted(own, target)
        rows = np.arange(len(at))
        # Odds that a unit is noise and not data.
        noise = q @ -_with_biases(outputs[own], biases[own] - self.log_inner[own])
        with np.errstate(over="ignore"):
            np.exp(noise, out=noise)
            up = 1 / (1 + 1 / noise[rows, at])
            noise += 1
        slopes = np.divide(-np.exp(self.log_inner[own]), noise, out=noise)
        slopes[rows, at] += up
        slopes = slopes.T @ q
        for part, square, slope in zip(
            self.parts[4:], self.squares[4:], (slopes[:, :WIDTH], slopes[:, WIDTH])
        ):
            moved, squared = part[own], square[own]
            _moved(moved, squared, slope / len(at))
            part[own], square[own] = moved, squared


def _slopes(q, own, biases, outputs, target, noise) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the log-likelihood of "is data" of the targets and of the noise.

    Its logits are the unnormalised log-probability less that of the noise.
    """
    good = np.einsum("nw,nw->n", q, own) + biases[target]
    bad = -(q @ outputs[noise].T + biases[noise])
    with np.errstate(over="ignore"):  # 1 / infinity is the right slope
        return 1 / (1 + np.exp(good)), -1 / (1 + np.exp(bad, out=bad))


def _moved(part: np.ndarray, square: np.ndarray, slope: np.ndarray) -> None:
    """One step of AdaGrad, in place."""
    slope = slope.astype(np.float32)
    square += slope * slope
    part += RATE * slope / np.sqrt(square)


def _summed(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The sum of the rows of each index."""
    flat = (index[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(flat, rows.ravel(), size * WIDTH).reshape(size, WIDTH)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the tokens of a task's texts, handed on whenever many have gathered."""

    def handed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            ["token", "n"],
        )

    counts: Counter = Counter()
    for batch in batches:
        for text in texts_of(batch.column(0)):
            counts.update(words_of(text))
            counts[END] += 1
            if len(counts) > COUNTED:
                yield handed(counts)
                counts = Counter()
    if counts:
        yield handed(counts)


def _trained(model: Model, shares: np.ndarray):
    """Map function: (shard, units) by shard to the sums of the shards' parameters, by tokens."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, tokens = np.zeros(len(model.weights)), 0
        trainer, shard, texts, held = None, None, [], 0

        def finish() -> None:
            nonlocal sums, tokens
            if texts:
                trainer.learn(texts)
            if trainer is not None:
                sums += trainer.model.weights.astype(np.float64) * trainer.tokens
                tokens += trainer.tokens

        for batch in batches:
            for own, units in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                if own != shard:
                    finish()
                    trainer, shard, texts, held = Trainer(model, shares, own), own, [], 0
                texts.append(np.frombuffer(units, "<i2"))
                held += len(texts[-1])
                if held >= GATHERED:
                    trainer.learn(texts)
                    texts, held = [], 0
        finish()
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(sums), dtype=np.int32)),
                    pa.array(sums),
                    pa.array(np.full(len(sums), float(tokens))),
                ],
                ["place", "weight", "tokens"],
            )

    return run


def counted(docs: DataFrame, text_column: str = "text") -> tuple[Model, DataFrame, np.ndarray]:
    """The model before training, the written table of all counts, and the units' shares."""
    counts = as_table(
        docs.select(text_column)
        .mapInArrow(_counted, "token binary, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n")),
        "counts",
    )
    total = counts.agg(F.sum("n"), F.count("n")).first()
    tokens, distinct = int(total[0] or 0), int(total[1])
    # The head: all tokens from a count on, the smallest that leaves HEAD_TOKENS at most. Counts
    # are looked at in steps of about 1 percent, so a few thousand rows say where to cut.
    step = F.floor(F.log2("n") * STEPS_PER_DOUBLING)
    short = counts.filter(F.octet_length("token") <= HEAD_BYTES).withColumn("step", step)
    cut, room = 0, HEAD_TOKENS
    for row in sorted(short.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        room -= row["count"]
        if room < 0:
            cut = row["step"] + 1
            break
    head_rows = short.filter(F.col("step") >= cut).toPandas()
    head_rows = head_rows.sort_values(["n", "token"], ascending=[False, True])
    head = {bytes(t): int(n) for t, n in zip(head_rows["token"], head_rows["n"])}
    single = {t: i for i, t in enumerate(list(head)[:SINGLE_TOKENS])}
    own = F.crc32(F.expr("substring(token, -2)")) % CLASSES
    sums = counts.groupBy(own.alias("class")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")
    )
    class_counts = np.full(CLASSES, 0.5)  # of the unknown token
    shares = np.full(OUTPUTS, 0.5)
    for row in sums.collect():
        class_counts[row["class"]] += row["n"] + 0.5 * row["distinct"]
        shares[SINGLE_TOKENS + row["class"]] += row["n"]
    for token, i in single.items():
        shares[i] += head[token]
        shares[class_of(token)] -= head[token]
        class_counts[class_of(token) - SINGLE_TOKENS] -= head[token] + 0.5
    shares[len(single) : SINGLE_TOKENS] = 0  # no token has them
    shares /= shares.sum()
    model = Model(tokens, distinct, head, single, class_counts, np.zeros(0, np.float32))
    model.weights = start_weights(shares, model.first_outputs())
    return model, counts, shares


def fit(model: Model, shares: np.ndarray, found: DataFrame, key: str = "doc_id") -> Model:
    """The model trained on the rows of `numbered`, which came from the model before training.

    Rows of one text are dealt out by their keys; rows that repeat key and text meet in a shard.
    """
    shards = -(-model.tokens // SHARD_TOKENS) or 1
    tasks = min(shards, SHARD_TASKS)
    mark = F.xxhash64(key, "units")
    dealt = (
        found.select(F.pmod(mark, F.lit(shards)).cast("int").alias("shard"), mark.alias("mark"), "units")
        .repartitionById(tasks, F.col("shard") % tasks)
        .sortWithinPartitions("shard", "mark")
        .select("shard", "units")
    )
    summed = (
        dealt.mapInArrow(_trained(model, shares), "place int, weight double, tokens double")
        .groupBy("place")
        .agg((F.sum("weight") / F.sum("tokens")).alias("weight"))
        .toPandas()
    )
    weights = model.weights.copy()
    if len(summed):
        weights[summed["place"].to_numpy()] = summed["weight"].to_numpy(np.float32)
    return replace(model, weights=weights)


def train(
    docs: DataFrame, text_column: str = "text", key: str = "doc_id"
) -> tuple[Model, DataFrame, np.ndarray]:
    """The model of all texts of `docs`, the written table of all counts, and the units' shares.

    Null and empty texts are a lone end. Without texts all units are equally likely.
    """
    model, counts, shares = counted(docs, text_column)
    found = numbered(docs, model, key, text_column)
    return fit(model, shares, found, key), counts, shares


class Scorer:
    """Normalised log10 probabilities of units after their contexts, by matrix products."""

    def __init__(self, model: Model):
        vectors, places, outputs, biases, inside, inner = model.parts()
        # Vectors that are weighed already, and biases as one more number of each output.
        self.placed = [vectors * place for place in places]
        self.outer = _with_biases(outputs, biases)
        self.first, self.context = model.first_outputs(), model.context_rows()
        self.members = members_of(self.first)
        self.inner = [_with_biases(inside[m], inner[m]) for m in self.members]
        self.sizes = [np.abs(table).sum(axis=0).max() for table in (self.outer, *self.inner)]

    def __call__(self, before: np.ndarray, targets: np.ndarray) -> np.ndarray:
        q = np.ones((len(targets), WIDTH + 1), np.float32)
        outer, out = self.first[targets], np.empty(len(targets))
        for a in range(0, len(targets), SCORED):
            rows = self.context[before[a : a + SCORED]]
            own = q[a : a + SCORED]
            own[:, :WIDTH] = sum(v.take(rows[:, c], 0) for c, v in enumerate(self.placed))
        most = max(1, np.abs(q).max(initial=0))
        for a in range(0, len(targets), SCORED):
            logits, own = q[a : a + SCORED] @ self.outer, outer[a : a + SCORED]
            out[a : a + SCORED] = _log_softmax(logits, own, most * self.sizes[0])
        at = np.flatnonzero(outer >= FIRST)
        at = at[np.argsort(outer[at].astype(np.uint8), kind="stable")]
        cuts = np.searchsorted(outer[at], np.arange(FIRST, FIRST + CLASSES + 1))
        for c, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            for i in range(a, b, SCORED):
                own = at[i : min(b, i + SCORED)]
                place = np.searchsorted(self.members[c], targets[own])
                logits = q[own] @ self.inner[c]
                out[own] += _log_softmax(logits, place, most * self.sizes[1 + c])
        out[outer < 0] = -np.inf
        return out / np.log(10)


def _with_biases(vectors: np.ndarray, biases: np.ndarray) -> np.ndarray:
    return np.concatenate([vectors, biases[:, None]], axis=1).T.copy()


def _log_softmax(logits: np.ndarray, target: np.ndarray, bound: float) -> np.ndarray:
    """The log of each row's softmax at its target; `logits`, of `bound` at most, is written over."""
    if not bound < 80:  # powers of numbers so large may be infinite, or all zero
        logits -= logits.max(axis=1)[:, None]
    chosen = logits[np.arange(len(logits)), target]
    return chosen - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], np.float32))


def log_probabilities(model: Model, before: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Normalised log10 probability of each target unit after its context."""
    return Scorer(model)(before, targets)


NUMBERED = (
    "n_tokens:long, n_known:long, base_score:double, share:double, units:binary, "
    "rare:array<binary>, rare_n:array<int>"
)


def _numbers(model: Model):
    """Column function: text to its units (16 bits each) and its scores by counts of the head.

    share is what the tokens of classes add to the model's score, given their units. Tokens that
    the head doesn't have are returned with their numbers: their counts are joined.
    """

    @F.arrow_udf(f"struct<{NUMBERED}>")
    @lean()
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers = Numbers(model)
        log_head = np.log10(np.array([*model.head.values(), 0], np.float64) + 0.5)
        log_all = np.log10(model.tokens + 0.5 * (model.distinct + 1))
        log_class = np.log10(model.class_counts)
        names = [field.split(":")[0] for field in NUMBERED.split(", ")]
        kinds = [
            pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(),
            pa.list_(pa.binary()), pa.list_(pa.int32()),
        ]
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for text in texts_of(batch):
                at, units, lost = numbers.of(words_of(text))
                known = at >= 0
                in_class = units >= SINGLE_TOKENS
                share = float(log_head[at[known & in_class]].sum())
                share -= float(log_class[units[in_class] - SINGLE_TOKENS].sum())
                rare = Counter(lost)
                row = (
                    len(at),
                    int(known.sum()),
                    float(log_head[at[known]].sum()) - log_all * len(at),
                    share,
                    units.astype("<i2").tobytes(),
                    list(rare),
                    list(rare.values()),
                )
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.StructArray.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], names
            )

    return run


def numbered(
    docs: DataFrame,
    model: Model,
    key: str = "doc_id",
    text_column: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """The written table of every row's key, carried columns, units and scores by counts."""
    return as_table(
        docs.select(key, *carried, _numbers(model)(F.col(text_column)).alias("s")).select(
            key, *carried, "s.*", F.monotonically_increasing_id().alias("row_number_")
        ),
        "numbered",
    )


def _scores(model: Model):
    """Column function: units to the log10 probability of all of them."""

    @F.arrow_udf("double")
    @lean()
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for batch in batches:
            found: list[np.ndarray] = []
            texts: list[np.ndarray] = []
            held = 0
            for units in (np.frombuffer(x, "<i2") for x in texts_of(batch)):
                texts.append(units)
                held += len(units)
                if held >= GATHERED:
                    found.append(_scored(scorer, texts))
                    texts, held = [], 0
            found.append(_scored(scorer, texts))
            yield pa.array(np.concatenate(found))

    return run


def _scored(scorer: Scorer, texts: list[np.ndarray]) -> np.ndarray:
    """The texts' log10 probabilities, by the same matrix products; no text is without units."""
    if not texts:
        return np.zeros(0)
    starts = np.cumsum([0, *map(len, texts[:-1])])
    return np.add.reduceat(scorer(contexts(texts), np.concatenate(texts)), starts)


def scored(
    found: DataFrame,
    model: Model,
    counts: DataFrame,
    key: str = "doc_id",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """What `score` returns, from the rows of `numbered`."""
    rare = found.select(
        "row_number_", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")
    ).select("row_number_", F.col("r.rare").alias("token"), F.col("r.rare_n").alias("times"))
    joined = rare.join(counts, "token", "left")
    n = F.coalesce("n", F.lit(0))
    sums = joined.groupBy("row_number_").agg(
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("rare_score"),
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    extra = F.coalesce("rare_score", F.lit(0.0))
    return (
        found.drop("rare", "rare_n")
        .join(sums, "row_number_", "left")
        .select(
            key,
            *carried,
            "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            (F.col("base_score") + extra).alias("base_score"),
            (_scores(model)(F.col("units")) + F.col("share") + extra).alias("score"),
        )
    )


def score(
    docs: DataFrame,
    model: Model,
    counts: DataFrame,
    key: str = "doc_id",
    text_column: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """(key, carried columns, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Both scores are log10 probabilities of the whole text: base_score by smoothed token counts,
    score by the model. Null and empty texts consist of their end. A very long text is one step
    of its own. Repeated rows and repeated or null keys are returned as they are: rows are told
    apart by a number of their own. Other columns are not read; an empty table gives no rows.
    """
    return scored(numbered(docs, model, key, text_column, carried), model, counts, key, carried)
