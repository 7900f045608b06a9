"""Fill-in-middle examples by one counted, possessive match per row.

A text is cut into units (lines, by default). regexp_count gives their number n, two numbers from a
hash of the row's key choose the cuts a <= b, and the row's own pattern

    \\A((?:unit){a}+)((?:unit){b-a}+)(.*)\\z

captures prefix, middle and suffix in one match, whose replacement writes them in the order of the
row's form. A possessive counted group is matched in a loop that never goes back, so neither the
stack nor the time grows beyond the text's length. All of it is built-in functions on columns: a
row at a time, no shuffle, no Python.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line with its end, or the rest of the text.
LINES = r"[^\n]*+\n|[^\n]++"


class Marks(NamedTuple):
    """The strings that stand before prefix, suffix and middle.

    None may hold another, and no end of one may begin one: what follows a mark could then be
    taken for a mark.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def check(self) -> None:
        for i, one in enumerate(self):
            for j, other in enumerate(self):
                shared = any(one.endswith(other[:n]) for n in range(1, len(other)))
                if not one or shared or (i != j and other in one):
                    raise ValueError(f"marks {one!r} and {other!r} can be mistaken")


MARKS = Marks()


def _draws(key: Column, seed: int, count: int) -> list[Column]:
    """`count` (8 at most) numbers from 0 to 2^32 - 1 out of the key's text; null is empty."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.sha2(named, 256)
    return [
        F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)
    ]


def transformed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rate: int = 100,
    spm_rate: int = 50,
    seed: int = 7,
    unit: str = LINES,
    marks: Marks = MARKS,
) -> DataFrame:
    """(key, n, form, output): each text as a fill-in-middle example.

    n is the number of units. `rate` of 100 texts are transformed, `spm_rate` of 100 of these to
    suffix-prefix-middle ("spm"), the others to prefix-suffix-middle ("psm"); the rest stay as
    they are ("plain"), as do empty texts and those that hold a mark. Null texts are empty, a
    null key counts as an empty one. Equal keys get equal draws, so repeated rows get equal
    results; all rows stay. A very long text is one match in one row. Other columns are not read;
    an empty table gives no rows. `unit` must match without groups and without a look behind, and
    its matches, left to right, must cover the text.
    """
    marks.check()
    draws = [f"_draw{i}" for i in range(4)]
    marked = "|".join(re.escape(m) for m in marks)
    rows = docs.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")
    ).select(
        "_key",
        "_text",
        F.regexp_count("_text", F.lit(unit)).cast("long").alias("n"),
        *(d.alias(name) for d, name in zip(_draws(F.col("_key"), seed, 4), draws)),
    )
    one, other = (F.col(d) % (F.col("n") + 1) for d in draws[:2])
    plain = (
        (F.col("_text") == "")
        | F.col("_text").rlike(marked)
        | (F.col("_draw2") % 100 >= rate)
    )
    form = F.when(plain, "plain").when(F.col("_draw3") % 100 < spm_rate, "spm").otherwise("psm")
    rows = rows.select(
        "_key",
        "_text",
        "n",
        form.alias("form"),
        F.least(one, other).alias("_from"),
        F.greatest(one, other).alias("_to"),
    )
    group = unit.replace("%", "%%")
    pattern = F.format_string(
        rf"(?s)\A((?:{group}){{%d}}+)((?:{group}){{%d}}+)(.*)\z",
        F.col("_from"),
        F.col("_to") - F.col("_from"),
    )
    marks = Marks(*(m.replace("\\", "\\\\").replace("$", "\\$") for m in marks))
    spm = F.lit(f"{marks.suffix}$3{marks.prefix}$1{marks.middle}$2")
    psm = F.lit(f"{marks.prefix}$1{marks.suffix}$3{marks.middle}$2")
    return rows.select(
        F.col("_key").alias(key),
        "n",
        "form",
        F.when(F.col("form") == "plain", F.col("_text"))
        .otherwise(
            F.regexp_replace("_text", pattern, F.when(F.col("form") == "spm", spm).otherwise(psm))
        )
        .alias("output"),
    )


def parts(output: str | Column, form: str | Column, marks: Marks = MARKS) -> Column:
    """Struct (prefix, middle, suffix) read back from an example; nulls for a plain one."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    found = F.split(output, "|".join(re.escape(m) for m in marks))
    spm = form == "spm"
    cut = F.struct(
        F.when(spm, found[2]).otherwise(found[1]).alias("prefix"),
        found[3].alias("middle"),
        F.when(spm, found[1]).otherwise(found[2]).alias("suffix"),
    )
    nothing = F.lit(None).cast("string")
    return F.when(form != "plain", cut).otherwise(
        F.struct(nothing.alias("prefix"), nothing.alias("middle"), nothing.alias("suffix"))
    )


def restored(output: str | Column, form: str | Column, marks: Marks = MARKS) -> Column:
    """The exact text that an example was made of."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    cut = parts(output, form, marks)
    return F.when(form == "plain", output).otherwise(
        F.concat(cut["prefix"], cut["middle"], cut["suffix"])
    )


def digests(found: DataFrame, key: str = "doc_id", marks: Marks = MARKS) -> DataFrame:
    """What the examples of `transformed` hold, read back from their outputs, a row each."""
    cut = found.select(
        key, "n", "form", "output", parts("output", "form", marks).alias("cut")
    ).select("*", restored("output", "form", marks).alias("whole"))
    return cut.select(
        key,
        "n",
        "form",
        F.length("cut.prefix").cast("long").alias("prefix_chars"),
        F.length("cut.middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("whole", 256).alias("restored_sha256"),
    )
