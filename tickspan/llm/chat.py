"""Chat formatting by prefix-target expansion.

A turn is rendered as

    ### role: text</turn>

and a line feed. Inside role and text a backslash goes before every backslash, `#`, `<` and `:`, so
no text can hold a turn's marks, and taking the backslashes out gives the text back.

Every assistant turn becomes an example of its own: the rendered turns before it as context, its
own turn, and the span of its text as the only trainable part. Turns after the last assistant turn
(all turns, if there is none) make one more example without a trainable part, so nothing is lost.

Conversations are dealt out by their id and sorted inside the tasks, and each is streamed turn by
turn: a task holds the rendered turns of one conversation, no more than its last example does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<:]|\\.)*)</turn>\n", re.DOTALL)
#: Characters of examples that a task hands on at once.
HANDED = 1 << 21

EXAMPLES = (
    "conv_id long, example int, text string, loss_start long, loss_end long, turns long, last boolean"
)


def escaped(text: str) -> str:
    return re.sub(r"([\\#<:])", r"\\\1", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """One turn, and where its text begins and ends in it."""
    head, body = f"### {escaped(role)}: ", escaped(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def turns_of(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a rendered conversation."""
    return [(unescaped(r), unescaped(t)) for r, t in TURN.findall(text)]


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to examples."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("example", pa.int32()),
            ("text", pa.string()),
            ("loss_start", pa.int64()),
            ("loss_end", pa.int64()),
            ("turns", pa.int64()),
            ("last", pa.bool_()),
        ]
    )
    rows: list[tuple] = []
    size = 0
    current: object = rows  # no conversation yet
    parts: list[str] = []
    length = turns = number = 0
    waiting: tuple | None = None  # the example that may be the conversation's last

    def handed() -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in schema]
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema)]
        rows.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def ended() -> None:
        """The rest of the conversation."""
        nonlocal waiting, size
        if waiting is not None and waiting[5] == turns:
            rows.append((*waiting, True))
        else:
            if waiting is not None:
                rows.append((*waiting, False))
            if turns:
                rows.append((current, number, "".join(parts), None, None, turns, True))
                size += len(rows[-1][2])
        waiting = None

    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if current is rows or conv != current:
                if current is not rows:
                    ended()
                current, parts, length, turns, number = conv, [], 0, 0, 0
            role, text = role or "", text or ""
            piece, start, end = rendered(role, text)
            parts.append(piece)
            turns += 1
            if role == ASSISTANT:
                if waiting is not None:
                    rows.append((*waiting, False))
                parts = ["".join(parts)]
                waiting = (conv, number, parts[0], length + start, length + end, turns)
                size += len(parts[0])
                number += 1
            length += len(piece)
            if size > HANDED:
                yield handed()
                size = 0
    if current is not rows:
        ended()
    if rows:
        yield handed()


def examples(
    turns: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One row per assistant turn, and one more per conversation that doesn't end with one.

    Columns: conv_id; example, counted from 0; text: the context and the target turn, rendered;
    loss_start and loss_end: the span of the target's text in it, in characters, null without a
    target; turns in the text; last: whether it holds the whole conversation. Null roles and texts
    are empty. Turns are sorted by turn (nulls first), then role and text, so ties and repeated
    rows have one order and all are kept. Rows of a null conv_id are one conversation. Other
    columns are not read; an empty table gives no rows.
    """
    picked = turns.select(
        F.col(conv_column).cast("long").alias("conv_id"),
        F.col(turn_column).cast("long").alias("turn"),
        F.col(role_column).cast("string").alias("role"),
        F.col(text_column).cast("string").alias("text"),
    )
    return (
        picked.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(_expanded, EXAMPLES)
    )


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    loss, chars, formatted = hashlib.sha256(), 0, 0
    for batch in batches:
        rows = []
        for at in range(batch.num_rows):
            conv, _, text, start, end, _, last = (batch.column(i)[at].as_py() for i in range(7))
            formatted += len(text)
            if start is not None:
                own = unescaped(text[start:end])
                chars += len(own)
                loss.update(own.encode())
            if last:
                turns = turns_of(text)
                whole = hashlib.sha256()
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                rows.append(
                    (conv, len(turns), whole.hexdigest(), chars, loss.hexdigest(), formatted)
                )
                loss, chars, formatted = hashlib.sha256(), 0, 0
        columns = zip(*rows) if rows else [[] for _ in schema]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
        )


def digests(found: DataFrame) -> DataFrame:
    """What the examples say, read back from their text: one row per conversation.

    n_turns and turns_sha256 (role, line feed, text, line feed of each turn) come from the
    conversation's last example; loss_chars and loss_sha256 from the text under all loss spans in
    order, unescaped; formatted_chars counts all examples. `found` must come straight from
    `examples`, whose tasks give each conversation's examples in order.
    """
    return found.mapInArrow(_digested, DIGESTS)
