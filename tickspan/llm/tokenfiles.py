"""Token files: the ids of all documents in the order of their keys, coded in independent blocks.

Below a folder lie Parquet tables:

- `vocabulary` (id, frequency): the one coding table, counted over all ids;
- `blocks` (shard, block, first, n_ids, doc_ids, doc_sizes, payload): whole documents, closed at
  BLOCK ids. A payload is a block of `ans` with its own checkpoints and checksums; `first` counts
  the ids before it in its shard;
- `shards` (shard, start): start counts the ids of all shards before.

Texts are cut where a match of the tokenizer's own pattern must end, and a task asks the library for
each different piece once: for a piece that is one match its model, for others the whole of it. (A
tokenizer that isn't byte-level gets whole texts.) Ids go to a scratch table where the texts are
read, so only ids are shuffled. Ranges of (key, checksum, row) become shards: the row splits even a
key that many rows share. Starts are sums over shards, never over documents.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import new_folder
from . import ans
from .frames import flat

#: Ids at which a block is closed; a document is never split.
BLOCK = 1 << 20
#: Characters of texts that are handed on at once, and pieces of a longer text.
CUT_CHARS, CUT_PIECES = 1 << 19, 1 << 16
#: Pieces in use, and as many before them, whose ids are kept; characters of the longest kept.
PIECES, PIECE_CHARS = 1 << 19, 64
#: Bytes of a file's row group: what a reader of blocks holds at once.
GROUP_BYTES = 1 << 25

# Fixed values of the tokenizer's byte-level pattern: what it takes for white space, and characters
# that are surely letters, digits or marks to it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
DIGITS = "0-9"
MARKS = r"!-/:-@\[-`{-~"
#: Every piece ends where a match of that pattern ends: runs of one kind, up to another kind; else
#: all up to white space; else white space, of which a last blank goes with what follows.
PIECE = re.compile(
    f" ?[{LETTERS}]++(?![^{WHITE}{DIGITS}{MARKS}])"
    f"| ?[{DIGITS}]++(?![^{WHITE}{LETTERS}{MARKS}])"
    f"|(?!')\\x20?[{MARKS}]++(?![^{WHITE}{LETTERS}{DIGITS}])"
    f"| ?[^{WHITE}]+"
    f"|[{WHITE}]+(?![^{WHITE}])"
    f"|[{WHITE}]"
)
#: Pieces that are one match.
SINGLE = re.compile(f" ?[{LETTERS}]+| ?[{DIGITS}]+|(?!')\\x20?[{MARKS}]+|[{WHITE}]+")

TOKENS = "key long, row long, crc32 long, n_tokens long, ids binary, counts binary"
BLOCKS = (
    "shard int, block int, first long, n_ids long, doc_ids array<long>, doc_sizes array<long>, "
    "payload binary"
)
STORED = ("start", "doc_ids", "doc_sizes", "payload")
DOCUMENTS = "key long, start long, n_tokens long, ids binary"
STRETCHES = "at long, ids binary"


class Library(NamedTuple):
    tokenizer: Tokenizer
    byte_level: bool  # whether texts may be cut into pieces


@lru_cache(maxsize=1)
def _library(path: str) -> Library:
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    found.no_padding()
    found.no_truncation()
    made_of = json.loads(found.to_str())
    splits = made_of["pre_tokenizer"] or {}
    byte_level = made_of["normalizer"] is None and (
        splits.get("type") == "ByteLevel"
        and splits.get("use_regex", True)
        and not splits.get("add_prefix_space", True)
    )
    return Library(found, byte_level)


@lru_cache(maxsize=1)
def _alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, the other bytes are numbered from 256.
    """
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def vocabulary_size(path: str) -> int:
    return _library(path).tokenizer.get_vocab_size(with_added_tokens=True)


def width_of(vocabulary: int) -> str:
    """The narrowest type for the ids in scratch tables."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class Pieces(dict):
    """The ids of pieces as bytes, asked of the tokenizer once; long pieces aren't kept.

    Beside the pieces in use the last PIECES are kept that were in use before; a piece that was
    among neither is forgotten.
    """

    def __init__(self, path: str, kind: str):
        super().__init__()
        self.kind = kind
        self.tokenizer, self.byte_level = _library(path)
        self.model = self.tokenizer.model
        self.alphabet = dict(enumerate(_alphabet()))
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.before.get(piece)
        if found is None:
            found = self._asked(piece)
        if len(piece) <= PIECE_CHARS:
            if len(self) >= PIECES:
                self.before = dict(self)
                self.clear()
            self[piece] = found
        return found

    def _asked(self, piece: str) -> bytes:
        if SINGLE.fullmatch(piece):
            if piece.isascii() and piece.isprintable():
                spelt = piece.replace(" ", self.alphabet[32])
            else:
                spelt = piece.encode().decode("latin-1").translate(self.alphabet)
            ids = [t.id for t in self.model.tokenize(spelt)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{'H' if self.kind == '<u2' else 'I'}", *ids)

    def of(self, text: str) -> bytes:
        """The ids of a text, as the tokenizer gives them for the whole of it."""
        if not self.byte_level:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, self.kind).tobytes()
        if len(text) <= CUT_CHARS:
            return b"".join(map(self.__getitem__, PIECE.findall(text)))
        found, cut = [], (m.group() for m in PIECE.finditer(text))
        while some := b"".join(map(self.__getitem__, islice(cut, CUT_PIECES))):
            found.append(some)
        return b"".join(found)


@lru_cache(maxsize=1)
def _pieces(path: str, kind: str) -> Pieces:
    """What this process knows of a tokenizer, for all its tasks: 2 * PIECES short pieces at most."""
    return Pieces(path, kind)


def _grouped(texts: list[str | None]) -> Iterator[list[str]]:
    """Lists of texts with CUT_CHARS characters at most, or one longer text; null is empty."""
    group: list[str] = []
    held = 0
    for text in texts:
        text = text or ""
        if group and held + len(text) > CUT_CHARS:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def tokens(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = 0
) -> DataFrame:
    """(key, row, crc32, n_tokens, ids): each text's ids and the end id.

    ids are little-endian, as wide as `width_of` says; crc32 is over them as unsigned 32-bit
    integers. row numbers the rows of this very read of `docs`. Null texts are empty and give the
    end id alone; texts are read whole, whatever their length; all rows stay. Beside these rows,
    each task gives one with null ids, whose counts are those of all its ids, as 64-bit integers.
    """
    size = vocabulary_size(path)
    kind = width_of(size)
    schema = pa.schema(
        [
            ("key", pa.int64()),
            ("row", pa.int64()),
            ("crc32", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids", pa.binary()),
            ("counts", pa.binary()),
        ]
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, last = _pieces(path, kind), np.array([end], kind).tobytes()
        counts = np.zeros(size, "<i8")
        for batch in batches:
            at = 0
            for group in _grouped(batch.column(2).to_pylist()):
                blobs = pa.array([pieces.of(text) + last for text in group], pa.binary())
                data, bounds = flat(blobs)
                ids = data.view(kind)
                counts += np.bincount(ids, minlength=size)
                cuts = (bounds // ids.itemsize).tolist()
                sums = [ans.checksum(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
                part = batch.slice(at, len(group))
                at += len(group)
                columns = [
                    part.column(0),
                    part.column(1),
                    pa.array(sums, pa.int64()),
                    pa.array(np.diff(cuts), pa.int64()),
                    blobs,
                    pa.nulls(len(group), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        row = (None, None, None, None, None, counts.tobytes())
        arrays = [pa.array([v], f.type) for v, f in zip(row, schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select(
        F.col(key).cast("long").alias("key"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text).cast("string").alias("text"),
    ).mapInArrow(found, TOKENS)


def frequencies(found: DataFrame, vocabulary: int) -> np.ndarray:
    """Scaled frequencies of all ids of `tokens`; as many numbers as the vocabulary has ids."""
    names = ["id", "n"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, "<i8")
        for batch in batches:
            for blob in batch.column(0):
                counts += np.frombuffer(blob.as_buffer(), "<i8")
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], names)

    counts = np.zeros(vocabulary, np.int64)
    rows = found.filter("counts IS NOT NULL").select("counts").mapInArrow(counted, "id long, n long")
    for r in rows.groupBy("id").agg(F.sum("n").alias("n")).collect():  # ids of the vocabulary
        counts[r["id"]] = r["n"]
    return ans.scaled(counts)


def _blocks(found: DataFrame, frequency: np.ndarray) -> DataFrame:
    """The rows of `blocks`, from `tokens` in order inside its partitions."""
    kind = width_of(len(frequency))
    schema = pa.schema(
        [
            ("shard", pa.int32()),
            ("block", pa.int32()),
            ("first", pa.int64()),
            ("n_ids", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_sizes", pa.list_(pa.int64())),
            ("payload", pa.binary()),
        ]
    )

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shard = ans.table_of(frequency), TaskContext.get().partitionId()
        keys: list[int | None] = []
        parts: list[np.ndarray] = []
        held = first = number = 0

        def closed() -> pa.RecordBatch:
            payload = ans.packed(np.concatenate(parts), table)
            row = (shard, number, first, held, keys, [len(p) for p in parts], payload)
            arrays = [pa.array([v], f.type) for v, f in zip(row, schema)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for key, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(key)
                parts.append(np.frombuffer(blob, kind))
                held += len(parts[-1])
                if held >= BLOCK:
                    yield closed()
                    first, number = first + held, number + 1
                    keys, parts, held = [], [], 0
        if parts:
            yield closed()

    return found.select("key", "ids").mapInArrow(coded, BLOCKS)


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = 0,
) -> None:
    """Write the token files of all texts below `folder`, which must not exist yet.

    Documents are in ascending order of their keys, null keys first; equal keys in the order of
    their ids' checksums, so rows that are repeated as a whole lie side by side. Other columns are
    not read. An empty table gives empty files.
    """
    spark = docs.sparkSession
    scratch = new_folder(spark, "tokens")
    tokens(docs, tokenizer, key, text, end).write.option("compression", "zstd").parquet(scratch)
    found = spark.read.schema(TOKENS).parquet(scratch)
    frequency = frequencies(found, vocabulary_size(tokenizer))
    table = pa.table({"id": np.arange(len(frequency), dtype=np.int32), "frequency": frequency})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{folder}/vocabulary")
    order = ("key", "crc32", "row")
    texts = found.filter("ids IS NOT NULL").select(*order, "ids")
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    coded = _blocks(ordered, frequency).write.option("parquet.block.size", GROUP_BYTES)
    coded.option("compression", "none").parquet(f"{folder}/blocks")  # nothing is left to save
    sizes = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").groupBy("shard")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes.agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    ).write.parquet(f"{folder}/shards")


def _stored(spark: SparkSession, folder: str) -> tuple[DataFrame, np.ndarray]:
    """All blocks with the global `start` of each, and the frequencies."""
    vocabulary = spark.read.schema("id int, frequency long").parquet(f"{folder}/vocabulary")
    rows = vocabulary.collect()
    frequency = np.zeros(len(rows), np.int64)
    for r in rows:
        frequency[r["id"]] = r["frequency"]
    shards = spark.read.schema("shard int, start long").parquet(f"{folder}/shards")
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").join(shards, "shard")
    return blocks.withColumn("start", F.col("start") + F.col("first")), frequency


def _documents(frequency: np.ndarray) -> Callable:
    """Decoder of rows (start, doc_ids, doc_sizes, payload): keys, starts, sizes and ids of each."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        table = ans.table_of(frequency)
        for batch in batches:
            for at in range(batch.num_rows):
                start, keys, sizes, payload = (batch.column(i)[at] for i in range(4))
                sizes = np.array(sizes.as_py(), np.int64)
                ids = ans.unpacked(payload.as_py(), table).astype("<u4")
                if len(ids) != sizes.sum():
                    raise ans.Corrupt("sizes of the documents don't add up to the block's")
                starts = np.cumsum(sizes) - sizes
                parts = [ids[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist())]
                yield keys.values, starts + start.as_py(), sizes, parts

    return decoded


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids) of every document, decoded from the files.

    ids are little-endian unsigned 32-bit integers, the end id included; start counts the ids of
    all documents before. A block that doesn't fit its checksums fails the query.
    """
    blocks, frequency = _stored(spark, folder)
    names = ["key", "start", "n_tokens", "ids"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, starts, sizes, parts in _documents(frequency)(batches):
            ids = pa.array([p.tobytes() for p in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, pa.array(starts), pa.array(sizes), ids], names)

    return blocks.select(*STORED).mapInArrow(found, DOCUMENTS)


def stretch(spark: SparkSession, folder: str, first: int, end: int) -> DataFrame:
    """(at, ids) of the ids from `first` to before `end`, one row per block that holds some.

    Only those blocks are read, and in them only what lies between the checkpoints around the
    stretch is decoded.
    """
    blocks, frequency = _stored(spark, folder)
    schema = pa.schema([("at", pa.int64()), ("ids", pa.binary())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ans.table_of(frequency)
        for batch in batches:
            for start, payload in zip(*(batch.column(i).to_pylist() for i in range(2))):
                one = max(first - start, 0)
                ids = ans.unpacked(payload, table, one, end - start).astype("<u4")
                row = [pa.array([start + one]), pa.array([ids.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, schema=schema)

    held = (F.col("start") < end) & (F.col("start") + F.col("n_ids") > first)
    return blocks.filter(held).select("start", "payload").mapInArrow(decoded, STRETCHES)


def digests(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, as `read` finds them in the files."""
    blocks, frequency = _stored(spark, folder)
    names = [key, "start", "n_tokens", "ids_crc32"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, starts, sizes, parts in _documents(frequency)(batches):
            sums = pa.array([zlib.crc32(p) for p in parts], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array(starts), pa.array(sizes), sums], names)

    types = f"`{key}` long, start long, n_tokens long, ids_crc32 long"
    return blocks.select(*STORED).mapInArrow(found, types)
