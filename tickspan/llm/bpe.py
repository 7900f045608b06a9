"""Byte-level BPE: encoding by the ranks of a vocabulary file, and decoding.

Pre-tokenisation runs over arrays, without a regular expression. Every code point has a class;
every class is a transition function of a small automaton whose state says what kind of piece the
text is in. Composition of such functions is associative and the functions that occur form a
small set, so they are numbered, and a table gives the number of any composition: the state after
each code point comes from a blocked scan of table look-ups over the whole batch. Where pieces
begin follows from the state before, the class of the code point, and the neighbour after it.

The pieces are those of the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
Merging is done once per distinct piece and kept in a cache of a bounded number of pieces.
Byte offsets of all ids are kept, so any span of ids can be decoded.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import flat, lean, steps
from .words import EXACT_VALUES, HashTable, word_hashes

#: Pieces that a worker keeps merged.
CACHE_PIECES = 1 << 20
#: Longest piece, in bytes, that is merged together with others.
BATCHED_BYTES = 48

# The code points with the Unicode property White_Space.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]

# Letters and numbers of Unicode 16 that the tables of Python 3.13 do not have yet.
LATER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
LATER_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]

# Classes of code points.
LETTER, ENDS_ONE, R_OR_V, ELL, EE, NUMBER, OTHER, QUOTE, BLANK, SPACE, TEXT_START = range(11)
# States: what the last code point was. AFTER_ANY: nothing that the next one could continue.
# OPEN_*: a contraction may be under way (after the quote; after 'r or 'v; after 'l).
AFTER_ANY, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANK, IN_SPACE, OPEN, OPEN_RV, OPEN_L = range(9)


def _next(state: int, kind: int) -> int:
    if kind == TEXT_START:
        return AFTER_ANY
    if state == OPEN and kind in (ENDS_ONE, R_OR_V, ELL):
        return {ENDS_ONE: AFTER_ANY, R_OR_V: OPEN_RV, ELL: OPEN_L}[kind]
    if (state, kind) in ((OPEN_RV, EE), (OPEN_L, ELL)):
        return AFTER_ANY
    if kind <= EE:
        return IN_LETTERS
    if kind == QUOTE:
        return IN_OTHERS if state in (IN_OTHERS, IN_BLANK, OPEN) else OPEN
    return {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, BLANK: IN_BLANK, SPACE: IN_SPACE}[kind]


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the classes' transition functions, the table of compositions, and the functions."""
    states = range(9)
    functions = [tuple(_next(s, k) for s in states) for k in range(11)]
    found = list(dict.fromkeys(functions))
    for f in found:  # grows while it is read: the closure under composition
        for g in functions:
            h = tuple(g[s] for s in f)
            if h not in found:
                found.append(h)
    number = {f: i for i, f in enumerate(found)}
    table = np.array(
        [[number[tuple(g[s] for s in f)] for g in found] for f in found], np.uint8
    )
    assert len(found) < 256
    return (
        np.array([number[f] for f in functions], np.uint8),
        table.ravel(),
        np.array(found, np.uint8),
    )


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            out[c] = LETTER if kind == "L" else NUMBER
    for later, kind in ((LATER_LETTERS, LETTER), (LATER_NUMBERS, NUMBER)):
        for first, last in later:
            out[first : last + 1] = kind
    out[WHITE_SPACE] = SPACE
    out[0x20] = BLANK
    out[0x27] = QUOTE
    out[[ord(c) for c in "stmd"]] = ENDS_ONE
    out[[ord("r"), ord("v")]] = R_OR_V
    out[ord("l")], out[ord("e")] = ELL, EE
    return out


def scanned(numbers: np.ndarray, table: np.ndarray, block: int = 64) -> np.ndarray:
    """The composition of the first 1, 2, ... functions, by a blocked associative scan."""
    size, n = int(len(table) ** 0.5), len(numbers)
    if n <= block:
        out = numbers.copy()
        for i in range(1, n):
            out[i] = table[int(out[i - 1]) * size + int(numbers[i])]
        return out
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint8)
    grid[:n] = numbers
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    for j in range(1, block):
        grid[j] = table[grid[j - 1].astype(np.intp) * size + grid[j]]
    before = scanned(grid[-1], table, block)[:-1].astype(np.intp) * size
    grid[:, 1:] = table[before + grid[:, 1:]]
    return grid.T.ravel()[:n]


def piece_starts(kinds: np.ndarray) -> np.ndarray:
    """Where pieces begin, given the class of each code point of texts that TEXT_START precedes.

    The places of TEXT_START are marked as well.
    """
    functions, table, members = automaton()
    state = members[scanned(functions[kinds], table), AFTER_ANY]
    before = np.empty_like(state)
    before[:1], before[1:] = AFTER_ANY, state[:-1]
    after_end = np.append(state[1:] == AFTER_ANY, False)
    following = np.append(kinds[1:], TEXT_START)
    blank = (kinds == BLANK) | (kinds == SPACE)
    was_blank = (before == IN_BLANK) | (before == IN_SPACE)
    # White space: its first code point begins a piece, and so does its last before other text.
    last_blank = (following != BLANK) & (following != SPACE) & (following != TEXT_START)
    start = blank & (~was_blank | last_blank)
    # Other text goes on with its own kind and with one blank before it.
    letters = kinds <= EE
    in_letters = (before == IN_LETTERS) | (before == OPEN_RV) | (before == OPEN_L)
    in_others = (before == IN_OTHERS) | (before == OPEN)
    start |= letters & ~(in_letters | (before == IN_BLANK))
    start |= (kinds == NUMBER) & ~((before == IN_NUMBERS) | (before == IN_BLANK))
    start |= ((kinds == OTHER) | (kinds == QUOTE)) & ~(in_others | (before == IN_BLANK))
    # Contractions: their letters go on, and what follows one begins anew.
    ends_one = (before == OPEN) & (kinds == ENDS_ONE)
    ends_two = ((before == OPEN_RV) & (kinds == EE)) | ((before == OPEN_L) & (kinds == ELL))
    opens_two = (before == OPEN) & (
        ((kinds == R_OR_V) & (following == EE)) | ((kinds == ELL) & (following == ELL))
    )
    start[ends_one | ends_two | (opens_two & after_end)] = False
    start[kinds == TEXT_START] = True
    return np.flatnonzero(start)


#: No pair of these ids joins to a token.
NO_RANK = np.int32(2**31 - 1)


class Vocabulary:
    """Ranks by token bytes, all joins of two tokens, and the bytes of all ids in a row."""

    def __init__(self, file: bytes):
        pairs = (line.split() for line in file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        by_id = sorted(self.ranks.items(), key=lambda x: x[1])
        self.lengths = np.zeros(by_id[-1][1] + 1, np.int64)
        for token, rank in by_id:
            self.lengths[rank] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(token for token, _ in by_id), np.uint8)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.joins = self._joins()
        self._forget()

    def _joins(self) -> HashTable:
        """All pairs of ids whose bytes together are a token."""
        get, keys, values = self.ranks.get, [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a = get(token[:i])
                b = get(token[i:]) if a is not None else None
                if b is not None:
                    keys.append((a << 32 | b) + 1)
                    values.append(rank)
        table = HashTable(2 * len(keys))
        table.add(np.array(keys, np.uint64), np.array(values, np.int32))
        return table

    def _forget(self) -> None:
        """An empty cache of pieces: piece hash to its number; its ids are store[at : at + size]."""
        self.cache = HashTable(CACHE_PIECES)
        self.at = np.zeros(CACHE_PIECES, np.int64)
        self.size = np.zeros(CACHE_PIECES, np.int64)
        self.store = np.zeros(1 << 20, np.uint32)
        self.used = 0

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id of each pair's joined bytes, which is its rank; NO_RANK if it is no token."""
        keys = (a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) + np.uint64(1)
        return self.joins.get(keys, NO_RANK)

    def merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each piece: join the neighbours of the lowest rank, leftmost first.

        All pieces of the batch take one join per round, as rows of a matrix.
        """
        out: list[tuple[int, ...]] = [()] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(lengths, kind="stable")
        for group in np.array_split(order, max(1, len(order) // 4096)):
            if not len(group):
                continue
            longest = int(lengths[group[-1]])
            rows = np.frombuffer(
                b"".join([pieces[i].ljust(longest, b"\0") for i in group.tolist()]), np.uint8
            ).reshape(len(group), longest)
            width = lengths[group].copy()
            ids = self.byte_ids[rows]
            ranks = np.full((len(group), longest), NO_RANK, np.int32)
            if longest > 1:
                ranks[:, :-1] = self.joined(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(
                    len(group), -1
                )
            ranks[np.arange(longest) >= width[:, None] - 1] = NO_RANK
            columns = np.arange(longest)
            live = np.arange(len(group))
            while len(live):
                own = ranks[live]
                at = own.argmin(axis=1)
                best = own[np.arange(len(live)), at]
                more = best != NO_RANK
                live, own, at, best = live[more], own[more], at[more], best[more]
                if not len(live):
                    break
                take = np.minimum(columns + (columns > at[:, None]), longest - 1)
                now = np.take_along_axis(ids[live], take, axis=1)
                own = np.take_along_axis(own, np.minimum(columns + (columns >= at[:, None]), longest - 1), axis=1)
                row = np.arange(len(live))
                now[row, at] = best
                width[live] -= 1
                own[:, -1] = NO_RANK
                right = at + 1 < width[live]
                own[row, at] = NO_RANK
                r = row[right]
                own[r, at[right]] = self.joined(now[r, at[right]], now[r, at[right] + 1])
                r = row[at > 0]
                own[r, at[r] - 1] = self.joined(now[r, at[r] - 1], now[r, at[r]])
                ids[live], ranks[live] = now, own
            for i, row_ids, n in zip(group.tolist(), ids.tolist(), width.tolist()):
                out[i] = tuple(row_ids[:n])
        return out

    def merged_alone(self, piece: bytes) -> tuple[int, ...]:
        """The same for one piece of any length, with a heap of its pairs: n log n steps."""
        ranks, n = self.ranks, len(piece)
        ends = list(range(1, n + 1))  # end of the part that begins here; 0 if none does
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = ends[i]
            if j < n:
                rank = ranks.get(piece[i : ends[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, j, ends[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, end = heapq.heappop(heap)
            if ends[i] != j or ends[j] != end:
                continue
            ends[i], ends[j] = end, 0
            if end < n:
                before[end] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : ends[i]]])
            i = ends[i]
        return tuple(out)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Merge new pieces and put them into the cache."""
        short = [i for i, p in enumerate(pieces) if len(p) <= BATCHED_BYTES]
        found: list[tuple[int, ...]] = [()] * len(pieces)
        for i, ids in zip(short, self.merged([pieces[i] for i in short])):
            found[i] = ids
        for i, piece in enumerate(pieces):
            if len(piece) > BATCHED_BYTES:
                found[i] = self.merged_alone(piece)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        n, used = self.cache.count, self.used
        if used + len(ids) > len(self.store):
            self.store = np.resize(self.store, 2 * (used + len(ids)))
        self.store[used : used + len(ids)] = ids
        self.at[n : n + len(found)] = used + np.cumsum(sizes) - sizes
        self.size[n : n + len(found)] = sizes
        self.cache.add(hashes, np.arange(n, n + len(found), dtype=np.int32))
        self.used += len(ids)

    def piece_ids(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces between the n + 1 byte cuts, and the number of each piece's."""
        starts, ends = cuts[:-1], cuts[1:]
        if len(starts) > CACHE_PIECES:  # one very long text: more pieces than the cache may hold
            middle = len(starts) // 2
            parts = [self.piece_ids(data, c) for c in (cuts[: middle + 1], cuts[middle:])]
            return tuple(np.concatenate(p) for p in zip(*parts))
        hashes = word_hashes(data, starts, ends, EXACT_VALUES)
        number = self.cache.get(hashes, -1)
        if (number < 0).any():
            new, first = np.unique(hashes[number < 0], return_index=True)
            if self.cache.count + len(new) > CACHE_PIECES:
                self._forget()
                new, first = np.unique(hashes, return_index=True)
            else:
                first = np.flatnonzero(number < 0)[first]
            text = data.tobytes()
            places = zip(starts[first].tolist(), ends[first].tolist())
            self._learn(new, [text[a:b] for a, b in places])
            number = self.cache.get(hashes, -1)
        sizes = self.size[number]
        before = np.cumsum(sizes) - sizes
        move = np.repeat(self.at[number] - before, sizes)
        return self.store[move + np.arange(len(move))], sizes

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each text; UTF-8 of all texts in a row and the n + 1 bounds between them."""
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        begins = np.flatnonzero((data & 0xC0) != 0x80)  # the byte where each code point begins
        n = len(bounds) - 1
        # One TEXT_START before each text: code point i of text t stands at i + t + 1.
        kinds = np.full(len(points) + n, TEXT_START, np.uint8)
        own = np.ones(len(kinds), bool)
        own[np.searchsorted(begins, bounds[:-1]) + np.arange(n)] = False
        kinds[own] = classes()[points]
        starts = piece_starts(kinds)
        marks = kinds[starts] == TEXT_START
        cuts = np.append(begins[(starts - np.cumsum(marks))[~marks]], len(data))
        ids, sizes = self.piece_ids(data, cuts)
        ends = np.append(0, np.cumsum(sizes))[np.searchsorted(cuts, bounds)]
        for i in range(n):
            own_ids, text = ids[ends[i] : ends[i + 1]], data[bounds[i] : bounds[i + 1]]
            # Pieces are found by hashes: the decoded bytes show a (practically impossible) clash.
            if not np.array_equal(self.decoded(own_ids), text):
                own_cuts = cuts[(cuts >= bounds[i]) & (cuts < bounds[i + 1])].tolist()
                own_cuts.append(int(bounds[i + 1]))
                pieces = [data[a:b].tobytes() for a, b in zip(own_cuts, own_cuts[1:])]
                own_ids = np.fromiter(
                    chain.from_iterable(map(self.merged_alone, pieces)), np.uint32
                )
            yield own_ids

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The n + 1 byte offsets between the ids in the decoded text."""
        out = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.lengths[ids], out=out[1:])
        return out

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids."""
        offsets = self.offsets(ids)
        move = np.repeat(self.starts[ids] - offsets[:-1], np.diff(offsets))
        return self.bytes[move + np.arange(offsets[-1])]


@lru_cache(maxsize=2)
def vocabulary(file: bytes) -> Vocabulary:
    """The vocabulary of a file of ranks, made once per Python process."""
    return Vocabulary(file)


def _read(path: str) -> bytes:
    """The rank file, read by the driver; tasks get its bytes (under 1 MB for 50,000 tokens)."""
    with open(path, "rb") as f:
        return f.read()


def _encoded(vocab: Vocabulary, batch: pa.Array) -> Iterator[np.ndarray]:
    data, bounds = flat(batch)
    for a, b in steps(bounds):
        yield from vocab.encode(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])


def encode(text: Column, path: str) -> Column:
    """struct<ids: array<int>, offsets: array<long>> of a text column; null is empty.

    `ids` are those of the rank file at `path`; `offsets` are the n + 1 byte offsets between them
    in the UTF-8 text, so `ids[i:j]` decode to the bytes from `offsets[i]` to `offsets[j]`.
    """

    file = _read(path)

    @F.arrow_udf("struct<ids:array<int>, offsets:array<long>>")
    @lean(vocabulary)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(file)
        for batch in batches:
            ids = list(_encoded(vocab, batch))
            yield pa.StructArray.from_arrays(
                [
                    pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                    pa.array([vocab.offsets(i) for i in ids], pa.list_(pa.int64())),
                ],
                ["ids", "offsets"],
            )

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes of an array of ids; a null array gives null."""

    file = _read(path)

    @F.arrow_udf("binary")
    @lean(vocabulary)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(file)
        for batch in batches:
            rows = (x.as_py() if x.is_valid else None for x in batch)
            yield pa.array(
                [None if x is None else vocab.decoded(np.array(x, np.int64)).tobytes() for x in rows],
                pa.binary(),
            )

    return run(ids)


def round_trip(text: Column, path: str) -> Column:
    """Digests of a text's ids and of the bytes that they decode to, in one pass.

    struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>; ids are hashed as
    little-endian unsigned 32-bit integers. Null counts as the empty text.
    """

    file = _read(path)

    @F.arrow_udf("struct<n_tokens:long, ids_sha256:string, decoded_sha256:string>")
    @lean(vocabulary)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary(file)
        for batch in batches:
            counts, codes, texts = [], [], []
            for ids in _encoded(vocab, batch):
                counts.append(len(ids))
                codes.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                texts.append(hashlib.sha256(vocab.decoded(ids)).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(codes, pa.string()), pa.array(texts, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run(text)


def encoded_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row.

    Null and empty texts have no ids. Rows are judged one by one, so repeated rows and null ids
    are returned as they are; other columns are not read.
    """
    return docs.select(
        F.col(id_column), round_trip(F.col(text_column), path).alias("r")
    ).select(id_column, "r.*")
