import hashlib
import random

import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tickspan.llm import chat
from tickspan.llm.queries import op10_chat_format

SCHEMA = "conv_id long, turn long, role string, text string, example int, last string"
SAID = r"\### Assistant: </turn> ok"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(turns):
    """Digests of one conversation's sorted turns."""
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def test_query_against_the_table(spark, data):
    by_conv = {-7: [("user", SAID), ("assistant", SAID)]}
    rows = spark.read.parquet(f"{data}/conversations.parquet").collect()
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        by_conv.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    got = op10_chat_format(spark, data).collect()
    assert len(got) == len(by_conv)
    for r in got:
        assert tuple(r)[1:5] == wanted(by_conv[r["conv_id"]])


@given(st.lists(st.tuples(st.text(max_size=20), st.text(max_size=60)), max_size=6))
def test_round_trip(turns):
    text = "".join(chat.rendered(r, t)[0] for r, t in turns)
    assert chat.turns_of(text) == turns


def test_control_strings_round_trip():
    rng = random.Random(8)
    parts = ["### ", "assistant", ": ", "</turn>", "\n", "\\", "#", "<", ":", "x", "</turn>\n### user: "]
    for _ in range(3000):
        turns = [
            ("".join(rng.choices(parts, k=3)), "".join(rng.choices(parts, k=6))) for _ in range(3)
        ]
        assert chat.turns_of("".join(chat.rendered(r, t)[0] for r, t in turns)) == turns


def test_examples(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a:1"), (1, 3, "user", "v"),
             (1, 4, "assistant", "a2"), (1, 5, "user", "end"), (2, 0, "user", "alone")]
    rows = chat.examples(spark.createDataFrame([(*t, 0, "x") for t in turns], SCHEMA)).collect()
    rows.sort(key=lambda r: (r["conv_id"], r["example"]))
    assert [(r["conv_id"], r["example"], r["turns"], r["last"]) for r in rows] == [
        (1, 0, 3, False), (1, 1, 5, False), (1, 2, 6, True), (2, 0, 1, True),
    ]
    first, second = rows[0], rows[1]
    assert first["text"] == "### system: s</turn>\n### user: u</turn>\n### assistant: a\\:1</turn>\n"
    assert first["text"][first["loss_start"] : first["loss_end"]] == "a\\:1"
    assert second["text"].startswith(first["text"])
    assert second["text"][second["loss_start"] : second["loss_end"]] == "a2"
    assert rows[2]["loss_start"] is None and rows[3]["loss_start"] is None


def test_awkward_rows(spark):
    long = "x:" * 300_000
    turns = [(1, None, "assistant", "first"), (1, 2, None, None), (1, 2, "assistant", ""), (1, 2, "assistant", ""),
             (None, 0, "user", "no id"), (None, 1, "assistant", "none"), (2, 0, "assistant", long),
             (2, 1, "assistant", long), (3, 0, "user", "\x00 \u2028 😀")]
    frame = spark.createDataFrame([(*t, 0, "x") for t in turns], SCHEMA).repartition(4)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(chat.examples(frame)).collect()}
    assert got == {
        1: wanted([("assistant", "first"), ("", ""), ("assistant", ""), ("assistant", "")]),
        None: wanted([("user", "no id"), ("assistant", "none")]),
        2: wanted([("assistant", long)] * 2),
        3: wanted([("user", "\x00 \u2028 😀")]),
    }
    assert chat.digests(chat.examples(frame.limit(0))).count() == 0


def test_conversations_without_replies_are_handed_on_in_parts():
    size = chat.HANDED // 8 + 1
    batches = (
        pa.RecordBatch.from_arrays(
            [pa.array([i]), pa.array(["user"]), pa.array(["x" * size])], ["conv_id", "role", "text"]
        )
        for i in range(40)
    )
    found = list(chat._expanded(batches))
    assert sum(b.num_rows for b in found) == 40
    assert max(b.num_rows for b in found) <= 9
