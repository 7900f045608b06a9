"""Static range asymmetric numeral system over token ids, in numpy.

One table of frequencies, counted over all ids and scaled to a power of two, serves every block. A
block is coded on its own: its ids lie in rows of `lanes`, and each lane has a 64-bit state, so one
numpy step codes a whole row; the 32-bit words that states give off lie interleaved in one stream.
The encoder goes from the last row to the first, the decoder forward. All states before every
`interval`-th row, and how many words were read by then, are kept as checkpoints: a decoder starts
at any of them, and takes the stretches between them side by side.

A block is a header, the checkpoints and the words, all little-endian. The header's checksum is
over the ids, as unsigned 32-bit integers.
"""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

import numpy as np

MAGIC = b"rans"
#: magic, bits of the table, lanes, interval, ids, words, crc32 of the ids; then crc32 of all else
FIELDS = struct.Struct("<4sHHIQQI")
HEADER = struct.Struct("<4sHHIQQII")
#: The scale of the table leaves room for this many times the ids of the vocabulary.
ROOM = 4
LANES = 4096
#: Ids between checkpoints.
STRETCH = 1 << 19
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)


class Corrupt(ValueError):
    """A block whose bytes or ids don't fit its checksums."""


class Table(NamedTuple):
    bits: int
    frequency: np.ndarray  # uint64, by id
    start: np.ndarray  # uint64, by id
    ids: np.ndarray  # uint32, by slot


def scaled(counts: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Frequencies that add up to 2^bits, at least 1 wherever counts aren't 0.

    What rounding leaves over goes to (or comes from) the most frequent ids. Without any count the
    frequencies are all 0. By default 2^bits is at least ROOM times the length of `counts`.
    """
    counts = np.asarray(counts, np.int64)
    bits = bits or max(12, (ROOM * len(counts) - 1).bit_length())
    total, size = int(counts.sum()), 1 << bits
    if not total:
        return np.zeros(len(counts), np.int64)
    if np.count_nonzero(counts) > size or bits > 28:
        raise ValueError(f"{np.count_nonzero(counts)} ids don't fit a table of 2^{bits} slots")
    found = np.floor(counts * (size / total)).astype(np.int64)
    found = np.where(counts > 0, np.maximum(found, 1), 0)
    order = np.lexsort((np.arange(len(counts)), -counts))
    left = size - int(found.sum())
    if left > 0:
        found[order[0]] += left
    for i in order:
        if left >= 0:
            break
        taken = min(-left, int(found[i]) - 1)
        found[i] -= taken
        left += taken
    return found


def table_of(frequencies: np.ndarray) -> Table:
    """The coding table of frequencies that add up to a power of two (or are all 0)."""
    frequencies = np.asarray(frequencies, np.int64)
    size = int(frequencies.sum())
    if size & (size - 1):
        raise ValueError("frequencies must add up to a power of two")
    start = np.cumsum(frequencies) - frequencies
    ids = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)
    bits = max(size.bit_length() - 1, 0)
    return Table(bits, frequencies.astype(np.uint64), start.astype(np.uint64), ids)


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def packed(ids: np.ndarray, table: Table, lanes: int = LANES, interval: int | None = None) -> bytes:
    """One block. Every id must have a frequency. A short block has fewer lanes.

    `interval` is the number of rows between checkpoints, by default as many as hold STRETCH ids.
    """
    count = len(ids)
    lanes = min(lanes, count >> 8 or 1)
    interval = interval or -(-STRETCH // lanes)
    rows = -(-count // lanes)
    frequency, start = table.frequency[ids], table.start[ids]
    if count and not frequency.all():
        raise ValueError("an id of the block is not in the table")
    scale = np.uint64(table.bits)
    # a state must give off a word first if coding the id would lift it to 2^63
    limit = frequency << np.uint64(63 - table.bits)
    states = np.full(lanes, LOW, np.uint64)
    words, given = [], np.zeros(rows, np.int64)
    kept = np.empty((-(-rows // interval), lanes), np.uint64)
    for row in range(rows - 1, -1, -1):
        at = slice(row * lanes, min((row + 1) * lanes, count))
        state, often = states[: at.stop - at.start], frequency[at]
        over = state >= limit[at]
        out = state[over]
        words.append(out.astype("<u4"))
        given[row] = len(out)
        state[over] = out >> WORD
        whole = state // often
        state += (whole << scale) - whole * often + start[at]
        if row % interval == 0:
            kept[row // interval] = states
    read = (np.cumsum(given) - given)[::interval]
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    body = b"".join(
        (read.astype("<u8").tobytes(), kept.astype("<u8").tobytes(), stream.tobytes())
    )
    fields = (MAGIC, table.bits, lanes, interval, count, len(stream), checksum(ids))
    whole = zlib.crc32(body, zlib.crc32(FIELDS.pack(*fields)))
    return HEADER.pack(*fields, whole) + body


def _decoded(
    states: np.ndarray, read: np.ndarray, rows: int, last: int, words: np.ndarray, table: Table
) -> np.ndarray:
    """`rows` rows of ids of each stretch, side by side; the last row has `last` lanes."""
    stretches, lanes = states.shape
    scale, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    found = np.empty((stretches, rows, lanes), np.uint32)
    read = read.astype(np.int64)
    for row in range(rows):
        width = lanes if row < rows - 1 else last
        state = states[:, :width]
        slot = state & mask
        ids = table.ids[slot]
        found[:, row, :width] = ids
        state = table.frequency[ids] * (state >> scale) + slot - table.start[ids]
        low = state < LOW
        counts = low.sum(axis=1)
        ends = counts.cumsum()
        # each stretch reads its next words, and they lie in the order of its lanes
        at = np.arange(ends[-1]) + (read - ends + counts).repeat(counts)
        state[low] = (state[low] << WORD) | words[at]
        read += counts
        states[:, :width] = state
    return found.reshape(stretches, rows * lanes)[:, : (rows - 1) * lanes + last]


def size_of(block: bytes) -> int:
    """Number of ids of a block."""
    return HEADER.unpack_from(block)[4]


def unpacked(block: bytes, table: Table, first: int = 0, end: int | None = None) -> np.ndarray:
    """Ids `first` to `end` (all, by default) of a block; only the stretches that hold them are decoded.

    Raises Corrupt if the bytes don't fit their checksum or, where the whole block is decoded, the
    ids don't fit theirs.
    """
    if len(block) < HEADER.size:
        raise Corrupt("block is shorter than its header")
    magic, bits, lanes, interval, count, size, sum_ids, sum_all = HEADER.unpack_from(block)
    body = memoryview(block)[HEADER.size :]
    if magic != MAGIC or zlib.crc32(body, zlib.crc32(block[: FIELDS.size])) != sum_all:
        raise Corrupt("bytes of the block don't fit their checksum")
    if bits != table.bits and count:
        raise Corrupt("block was coded with another table")
    end = count if end is None else min(end, count)
    first = min(max(first, 0), end)
    if first >= end:
        return np.zeros(0, np.uint32)
    rows = -(-count // lanes)
    stretches = -(-rows // interval)
    read = np.frombuffer(body, "<u8", stretches)
    states = np.frombuffer(body, "<u8", stretches * lanes, 8 * stretches).reshape(stretches, lanes)
    words = np.frombuffer(body, "<u4", size, 8 * stretches * (1 + lanes))
    one, to = first // (interval * lanes), -(-end // (interval * lanes))
    found = []
    full = min(to, stretches - 1)
    if one < full:
        part = _decoded(
            states[one:full].astype(np.uint64), read[one:full], interval, lanes, words, table
        )
        found.append(part.ravel())
    if to == stretches:
        left = count - (stretches - 1) * interval * lanes
        height = -(-left // lanes)
        part = _decoded(
            states[-1:].astype(np.uint64), read[-1:], height, left - (height - 1) * lanes, words, table
        )
        found.append(part.ravel())
    ids = np.concatenate(found)
    if first == 0 and end == count and checksum(ids) != sum_ids:
        raise Corrupt("decoded ids don't fit their checksum")
    skipped = one * interval * lanes
    return ids[first - skipped : end - skipped]
