"""Toxicity by the nearest labelled examples, under exact TF-IDF cosine.

Terms are all words of the examples, and the beginnings of longer words that tell the labels apart
(chi-squared over the examples). Examples and texts are vectors of log term frequency times inverse
document frequency, times an emphasis that grows with what a term tells. Words that no example
holds count in a text's length.

The examples lie in a block-max inverted index: like ones lie together in blocks of BLOCK, and each
block has the largest weight of every common term. Lists of rare terms are short and are added up
first; what the common terms may add is bounded by block. Blocks are visited from the highest bound
down, with exact cosines, until no bound left reaches the k-th best, so the k nearest are exact,
ties going to the smaller example id.

The neighbours vote with their cosines as weights; the vote is calibrated by the examples' own
leave-one-out votes (isotonic regression). Texts that share no term with any example get the share
of toxic ones among the examples without a word.

The examples are a bounded sample of the labelled rows: EXAMPLES_PER_LABEL of each label, those
with the smallest hashes of their ids. Labels weigh as often as they occur in all labelled rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import lean, texts_of
from .words import word_hashes

EXAMPLES_PER_LABEL = 2000
#: Bytes of the beginnings of words that are terms as well; names of such terms end in a star.
BEGINNINGS = (4, 5, 6, 7)
#: Chi-squared, with one degree of freedom, from which a term tells the labels apart.
TELLING = 15.0
#: The emphasis of a telling term: its chi-squared over TELLING to this power.
EMPHASIS = 0.5
NEIGHBOURS = 15
#: Terms in more than this share of the examples are rows of the dense matrix.
COMMON = 1 / 16
#: Examples of a block, and blocks that are visited at first; then twice as many each time.
BLOCK = 32
VISITED = 8
#: How far sums in another order may be apart, and more.
SLACK = 1e-9
#: Directions of most variance along which examples are dealt to blocks.
DIRECTIONS = 8
#: Weight of the overall share among the neighbours' votes.
PRIOR_WEIGHT = 0.5
#: Texts that are compared at once.
QUERIES = 256

# Bytes that cut words: ASCII other than letters, digits; A-Z become a-z.
CUTS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(CUTS).split()


def term_counts(words: list[bytes]) -> Counter:
    """How often each possible term occurs: the words and the beginnings of longer ones."""
    out = Counter(words)
    for word, n in list(out.items()):
        for size in BEGINNINGS:
            if len(word) > size:
                out[word[:size] + b"*"] += n
    return out


@dataclass
class Index:
    """Inverted index of the examples.

    lookups: by 0 for whole words and by sizes of beginnings, sorted 64-bit hashes and the places
    of the terms, as a dict of all words would weigh on every task; terms: the names, by place, of
    those that tell the labels apart. idf: the weights of the terms, the emphasis included; unseen:
    the weight of words that no example holds. start, doc,
    weight: where each term's postings begin, and the postings of all terms in a row, by position;
    row: the numbers of common terms (-1: others), dense: their weights by number, block and
    example, block_max: the largest by number and block. ids and toxic describe the examples by
    number; position and number lead from one to the other (-1: a position of no example).
    """

    lookups: dict[int, tuple[np.ndarray, np.ndarray]]
    terms: dict[int, bytes]
    idf: np.ndarray
    unseen: float
    ids: np.ndarray
    toxic: np.ndarray
    share: np.ndarray  # how many labelled rows each example stands for
    start: np.ndarray
    doc: np.ndarray
    weight: np.ndarray
    row: np.ndarray
    dense: np.ndarray
    block_max: np.ndarray
    position: np.ndarray
    number: np.ndarray
    steps: tuple[np.ndarray, np.ndarray] | None = None  # calibration: votes and probabilities
    without: float = 0.0  # probability for texts without any term
    overall: float = 0.0

    def vector(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places and weights of the terms in a text; empty without any.

        The weights are those of a unit vector that has the words no example holds as well.
        """
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        at, times, unseen = [], [], np.zeros(0)
        for size, (keys, places) in self.lookups.items():
            from_, to = starts, starts + lengths
            if size:
                from_ = starts[lengths > size]
                to = from_ + size
            own, n = np.unique(word_hashes(data, from_, to), return_counts=True)
            place = np.searchsorted(keys, own)
            known = np.append(keys, np.uint64(0))[place] == own  # no hash is 0
            at.append(places[place[known]])
            times.append(n[known])
            if not size:
                unseen = n[~known]
        at, times = np.concatenate(at), np.concatenate(times)
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0)
        weight = (1 + np.log(times)) * self.idf[at]
        other = (1 + np.log(unseen)) * self.unseen
        order = np.argsort(at)
        return at[order], weight[order] / np.sqrt((weight * weight).sum() + (other * other).sum())

    def nearest(
        self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[int] | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """(example numbers, cosines) of each query's k nearest examples, nearest first.

        Only examples with a cosine above 0 count; `but` leaves out one example per query.
        """
        common = np.zeros((len(queries), len(self.block_max)))
        for q, (at, weight) in zip(common, queries):
            row = self.row[at]
            q[row[row >= 0]] = weight[row >= 0]
        # What the common terms may add in each block, at most.
        limits, out = common @ self.block_max, []
        for q, (at, weight) in enumerate(queries):
            rare = self.row[at] < 0
            at, weight = at[rare], weight[rare]
            counts = self.start[at + 1] - self.start[at]
            ends = np.cumsum(counts)
            place = np.arange(counts.sum()) + np.repeat(self.start[at] - ends + counts, counts)
            own = np.repeat(weight, counts) * self.weight[place]
            partial = np.bincount(self.doc[place], own, len(self.number)).reshape(-1, BLOCK)
            left_out = -1 if but is None else self.position[but[q]]
            top, cosines = self._best(common[q], partial, limits[q], k, left_out)
            order = np.lexsort((self.number[top], -cosines))[:k]
            out.append((self.number[top[order]], cosines[order]))
        return out

    def _best(
        self, q: np.ndarray, partial: np.ndarray, limits: np.ndarray, k: int, left_out: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """(positions, cosines) that hold the k nearest, ties with the last one included.

        `partial` has the exact sums of the rare terms by block and example. Blocks are visited
        from the highest bound down, ever more at once, until the bounds left are below the k-th
        best cosine.
        """
        terms = np.flatnonzero(q)
        q, terms = q[terms], terms[:, None]
        bounds = limits + partial.max(axis=1, initial=0)
        order = np.argsort(-bounds, kind="stable")
        ranked = -bounds[order]
        top, cosines = np.zeros(0, np.int64), np.zeros(0)
        at, step, least = 0, VISITED, 0.0
        while True:
            end = int(np.searchsorted(ranked, -max(least - SLACK, SLACK), "right"))
            if at >= end:
                return top, cosines
            blocks = order[at : min(end, at + step)]
            at, step = at + step, 2 * step
            weights = self.dense[terms, blocks].reshape(len(q), len(blocks) * BLOCK)
            found = (partial[blocks].ravel() + q @ weights).round(12)
            places = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            keep = (found > 0) & (found >= least) & (places != left_out)
            top, cosines = np.append(top, places[keep]), np.append(cosines, found[keep])
            if len(top) > k:
                least = np.partition(cosines, len(cosines) - k)[-k]
                keep = cosines >= least
                top, cosines = top[keep], cosines[keep]

    def vote(self, docs: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic examples, weighed by cosine and by the rows an example stands for."""
        weight = cosines * self.share[docs]
        extra = PRIOR_WEIGHT * self.share.mean()
        return float((weight @ self.toxic[docs] + extra * self.overall) / (weight.sum() + extra))

    def probability(self, vote: float) -> float:
        return float(np.interp(vote, *self.steps))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best non-decreasing steps of y over x, by pooling neighbours that fall."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of weights, of weights * y, of weights * x
    for i in order.tolist():
        pools.append([w[i], w[i] * y[i], w[i] * x[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    p = np.array(pools)
    return p[:, 2] / p[:, 0], p[:, 1] / p[:, 0]


def terms_of(
    texts: list[bytes], toxic: np.ndarray, share: np.ndarray
) -> list[tuple[bytes, float, float]]:
    """All words and the telling beginnings: (term, weighted text share, chi-squared)."""
    total = [share[toxic == 0].sum(), share[toxic == 1].sum()]
    n = [int((toxic == 0).sum()), int((toxic == 1).sum())]
    # A term in m texts reaches 2 * m * (larger / smaller label) at most. Beginnings are counted
    # by hashes first, so that only those in enough texts are held.
    least = TELLING * max(1, min(n)) / (2 * max(1, *n))
    buckets = np.zeros(1 << 20, np.int32)
    for text in texts:
        own = {hash(t) & (len(buckets) - 1) for t in term_counts(words_of(text))}
        buckets[list(own)] += 1
    often = (buckets >= least).tolist()
    df = [Counter(), Counter()]
    for text, label in zip(texts, toxic.tolist()):
        terms = term_counts(words_of(text))
        df[label].update(
            t for t in terms if t[-1:] != b"*" or often[hash(t) & (len(often) - 1)]
        )
    found = []
    for term in sorted(df[0].keys() | df[1].keys()):
        a, b = df[1][term], df[0][term]
        c, d = n[1] - a, n[0] - b
        below = (a + b) * (c + d) * n[0] * n[1]
        chi = (a * d - b * c) ** 2 * (n[0] + n[1]) / below if below else 0.0
        if chi >= TELLING or term[-1:] != b"*":
            rate = (a / max(1, n[1]) * total[1] + b / max(1, n[0]) * total[0]) / sum(total)
            found.append((term, rate, chi))
    return found


def lookups_of(terms: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By 0 for words and by sizes of beginnings: sorted hashes of the terms, and their places."""
    out = {}
    for size in (0, *BEGINNINGS):
        own = [
            i for i, t in enumerate(terms) if (len(t) - 1 if t.endswith(b"*") else 0) == size
        ]
        names = [terms[i].rstrip(b"*") for i in own]
        ends = np.cumsum([0, *map(len, names)])
        keys = word_hashes(np.frombuffer(b"".join(names), np.uint8), ends[:-1], ends[1:])
        order = np.argsort(keys)
        out[size] = keys[order], np.array(own, np.int64)[order]
    return out


def build(ids: np.ndarray, texts: list[bytes], toxic: np.ndarray, share: np.ndarray) -> Index:
    """The index of examples, calibrated; `share` says how many labelled rows each stands for."""
    order = np.argsort(ids, kind="stable")
    ids, toxic, share = ids[order], toxic[order].astype(np.int64), share[order].astype(float)
    texts = [texts[i] for i in order.tolist()]
    terms = terms_of(texts, toxic, share)
    chi = np.array([c for _, _, c in terms])
    idf = np.log(1 + 1 / np.maximum(np.array([rate for _, rate, _ in terms]), 1e-9))
    idf *= np.maximum(1, chi / TELLING) ** EMPHASIS
    index = Index(
        lookups_of([term for term, _, _ in terms]),
        {i: term for i, (term, _, c) in enumerate(terms) if c >= TELLING},
        idf, float(np.log(1 + len(ids))), ids, toxic, share, np.zeros(len(terms) + 1, np.int64),
        np.zeros(0, np.int32), np.zeros(0), np.full(len(terms), -1), np.zeros((0, 0, BLOCK)),
        np.zeros((0, 0)), np.zeros(0, np.int64), np.zeros(0, np.int64),
    )
    vectors = [index.vector(words_of(t)) for t in texts]
    rows = np.repeat(np.arange(len(ids), dtype=np.int32), [len(at) for at, _ in vectors])
    term = np.concatenate([np.zeros(0, np.int64), *[at for at, _ in vectors]])
    weight = np.concatenate([np.zeros(0), *[w for _, w in vectors]])
    counts = np.bincount(term, minlength=len(terms))
    index.start[1:] = np.cumsum(counts)
    common = np.flatnonzero(counts > COMMON * len(ids))
    index.row[common] = np.arange(len(common))
    dense = np.zeros((len(ids), len(common)))
    of_common = index.row[term] >= 0
    dense[rows[of_common], index.row[term[of_common]]] = weight[of_common]
    blocks = -(-len(ids) // BLOCK)
    index.number = np.full(blocks * BLOCK, -1)
    index.number[: len(ids)] = alike_together(dense)
    index.position = np.argsort(index.number, kind="stable")[blocks * BLOCK - len(ids) :]
    by_term = np.lexsort((rows, term))
    index.doc, index.weight = index.position[rows[by_term]], weight[by_term]
    index.dense = np.zeros((len(common), blocks * BLOCK))
    index.dense[:, index.position] = dense.T
    index.dense = index.dense.reshape(len(common), blocks, BLOCK)
    index.block_max = index.dense.max(axis=2, initial=0)
    index.overall = float(share @ toxic / share.sum()) if len(ids) else 0.0
    full = np.array([len(at) > 0 for at, _ in vectors], bool)
    index.without = _rate(toxic[~full], share[~full], index.overall)
    own = np.flatnonzero(full).tolist()
    votes = np.array(
        [
            index.vote(*found)
            for a in range(0, len(own), QUERIES)
            for found in index.nearest(
                [vectors[i] for i in own[a : a + QUERIES]], NEIGHBOURS, own[a : a + QUERIES]
            )
        ]
    )
    if len(own):
        index.steps = isotonic(votes, toxic[own].astype(float), share[own])
    else:
        index.steps = np.array([0.0]), np.array([index.overall])
    return index


def alike_together(rows: np.ndarray) -> np.ndarray:
    """An order of the rows in which like ones are near: halves along the directions of variance."""
    if len(rows) <= BLOCK or not rows.size:  # a single block, or nothing to tell rows by
        return np.arange(len(rows))
    _, directions = np.linalg.eigh(np.cov(rows.T).reshape(rows.shape[1], -1))
    points = rows @ directions[:, ::-1][:, :DIRECTIONS]
    done, parts = [], [np.arange(len(rows))]
    while parts:
        part = parts.pop()
        if len(part) <= BLOCK:
            done.append(part)
            continue
        widest = points[part].var(axis=0).argmax()
        part = part[np.argsort(points[part, widest], kind="stable")]
        half = BLOCK * (-(-len(part) // BLOCK) // 2)  # whole blocks, but for the last one
        parts += [part[half:], part[:half]]
    return np.concatenate(done)


def _rate(toxic: np.ndarray, share: np.ndarray, overall: float) -> float:
    """The weighted share of toxic ones, drawn a little to the overall share."""
    return float((share @ toxic + 2 * overall) / (share.sum() + 2))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Index:
    """The index of a bounded sample of the labelled texts.

    Rows of a null id or a label other than 0 and 1 are not learned from; of several labels of an
    id the largest counts, and of several texts the greatest. Without examples the probability of
    any text is 0.
    """
    marked = (
        labels.filter(F.col(key).isNotNull() & F.col(label_column).isin(0, 1))
        .groupBy(F.col(key).alias("k"))
        .agg(F.max(label_column).cast("int").alias("label"))
    )
    counts = {row["label"]: row["count"] for row in marked.groupBy("label").count().collect()}
    chosen = None
    for label in counts:
        rows = (
            marked.filter(F.col("label") == label)
            .orderBy(F.xxhash64("k", F.lit("toxicity")), "k")
            .limit(EXAMPLES_PER_LABEL)
        )
        chosen = rows if chosen is None else chosen.union(rows)
    if chosen is None:
        return build(np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0))
    # At most 2 * EXAMPLES_PER_LABEL rows of two numbers: safe to broadcast.
    rows = (
        docs.select(F.col(key).alias("k"), F.col(text_column).alias("t"))
        .join(F.broadcast(chosen), "k")
        .groupBy("k", "label")
        .agg(F.coalesce(F.max("t"), F.lit("")).alias("t"))
        .orderBy("k")
        .select("k", "label", _condensed("t").alias("t"))
        .toPandas()
    )
    toxic = rows["label"].to_numpy(np.int64)
    found = np.bincount(toxic, minlength=2)
    share = np.array([counts[x] / found[x] for x in toxic.tolist()])
    return build(rows["k"].to_numpy(np.int64), [bytes(t) for t in rows["t"]], toxic, share)


def _condensed(text: str) -> Column:
    """The words of a text column, joined by blanks."""

    @F.arrow_udf("binary")
    @lean()
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([b" ".join(words_of(t)) for t in texts_of(batch)], pa.binary())

    return run(F.col(text))


def score(text: Column, index: Index) -> Column:
    """struct<score, neighbours: array<struct<id, cosine, toxic>>, terms: array<string>>.

    score is the calibrated probability that the whole text is toxic; neighbours (nearest first)
    and the terms found that tell the labels apart are the evidence. Null and empty texts are like
    others without any term.
    """

    @F.arrow_udf(
        "struct<score:double, neighbours:array<struct<id:long, cosine:double, toxic:int>>, "
        "terms:array<string>>"
    )
    @lean()
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = {i: t.decode(errors="replace") for i, t in index.terms.items()}
        kind = pa.list_(
            pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])
        )
        for batch in batches:
            vectors = [index.vector(words_of(t)) for t in texts_of(batch)]
            scores = np.full(len(vectors), index.without)
            evidence: list[list] = [[] for _ in vectors]
            full = [i for i, (at, _) in enumerate(vectors) if len(at)]
            for a in range(0, len(full), QUERIES):
                part = full[a : a + QUERIES]
                nearest = index.nearest([vectors[i] for i in part], NEIGHBOURS)
                for i, (docs, cosines) in zip(part, nearest):
                    scores[i] = index.probability(index.vote(docs, cosines))
                    evidence[i] = [
                        {"id": int(index.ids[d]), "cosine": float(c), "toxic": int(index.toxic[d])}
                        for d, c in zip(docs.tolist(), cosines.tolist())
                    ]
            yield pa.StructArray.from_arrays(
                [
                    pa.array(scores),
                    pa.array(evidence, kind),
                    pa.array(
                        [[names[t] for t in at.tolist() if t in names] for at, _ in vectors],
                        pa.list_(pa.string()),
                    ),
                ],
                ["score", "neighbours", "terms"],
            )

    return run(text)


def tolerable(
    docs: DataFrame, index: Index, text_column: str = "text", most: float = 0.5
) -> DataFrame:
    """The rows whose score is below `most`; all columns stay as they are."""
    return docs.filter(score(F.col(text_column), index)["score"] < most)
