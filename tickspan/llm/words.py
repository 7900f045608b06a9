"""Words, their hashes and shingles of many texts at once, in numpy.

A word's hash is a Karp-Rabin value: random 64-bit numbers of its bytes times powers of an odd
number, modulo 2**64. Running sums over the whole buffer give every word's value by one
subtraction; the inverse power moves it to a common origin and a mixer spreads the bits.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORD_BASE = 0x9E3779B97F4A7C15
SHINGLE_BASE = 0xC2B2AE3D27D4EB4F
MASK = (1 << 64) - 1


@lru_cache(maxsize=8)
def kept_powers(base: int, length: int) -> np.ndarray:
    out = np.full(length, base, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    out.setflags(write=False)
    return out


def powers(base: int, length: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; kept in sizes of powers of two."""
    return kept_powers(base & MASK, 1 << max(10, (length - 1).bit_length()))[:length]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(fold_case: bool) -> np.ndarray:
    values = np.random.default_rng(20240101).integers(1, MASK, 256, np.uint64, True)
    if fold_case:
        values[65:91] = values[97:123]
    return values


#: Numbers of the bytes, A-Z as a-z, and with capitals apart.
VALUES = _byte_values(True)
EXACT_VALUES = _byte_values(False)
#: Bytes that stand in words: all but ASCII white space.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
#: Bytes that stand in words: ASCII letters and digits, and all of other scripts.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def lower_latin(data: np.ndarray) -> np.ndarray:
    """UTF-8 with the capitals of Latin-1 (two bytes, first 0xC3) in lower case."""
    second = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    if second.any():
        data = data.copy()
        data[1:][second] += 0x20
    return data


def spans(
    data: np.ndarray, bounds: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and the n + 1 word numbers between texts."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    word = inside[data]
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | cut[1:n]
    end[:-1] &= ~word[1:] | cut[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = VALUES
) -> np.ndarray:
    """One 64-bit hash per word, not 0; A-Z count as a-z unless EXACT_VALUES are given."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(WORD_BASE, len(data)), out=sums[1:])
    back = powers(pow(WORD_BASE, -1, 1 << 64), len(data))
    return np.maximum(mixed((sums[ends] - sums[starts]) * back[starts]), np.uint64(1))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of `size` words that starts at a word; the last ones cross texts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, size):
        out += hashes[j : j + n] * np.uint64(pow(SHINGLE_BASE, j, 1 << 64))
    return mixed(out)


def run_hash(hashes: np.ndarray, length_seed: int = 0) -> int:
    """One hash of a whole sequence of word hashes."""
    total = (hashes * powers(SHINGLE_BASE, len(hashes))).sum(dtype=np.uint64)
    return int(mixed(np.array([total + np.uint64(length_seed)], np.uint64))[0])


class HashTable:
    """64-bit keys other than 0 to 32-bit numbers, asked and filled by whole arrays."""

    def __init__(self, capacity: int):
        self.bits = max(10, (2 * capacity - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.zeros(1 << self.bits, np.int32)
        self.count = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        spread = keys * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray, default: int) -> np.ndarray:
        slots, last = self._slots(keys), len(self.keys) - 1
        held = self.keys[slots]
        out = np.where(held == keys, self.values[slots], np.int32(default))
        at = np.flatnonzero((held != keys) & (held != 0))
        slots = slots[at]
        while len(at):
            slots = slots + 1 & last
            held = self.keys[slots]
            hit = held == keys[at]
            out[at[hit]] = self.values[slots[hit]]
            on = ~hit & (held != 0)
            at, slots = at[on], slots[on]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Put in distinct keys that the table does not hold."""
        slots, last = self._slots(keys), len(self.keys) - 1
        self.count += len(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] == 0)
            chosen, first = np.unique(slots[free], return_index=True)
            taken = free[first]
            self.keys[chosen], self.values[chosen] = keys[taken], values[taken]
            left = np.ones(len(keys), bool)
            left[taken] = False
            keys, values, slots = keys[left], values[left], slots[left] + 1 & last
