import hashlib
import random
import re

import awkward
import pytest
from compare import connect, spark_rows, sql_rows

from tickspan.llm import infill
from tickspan.llm.queries import SQL, op13_fill_in_middle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(key, text, rate=100, spm_rate=50, seed=7):
    """(n, form, prefix, middle, output) by cutting the list of lines."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    name = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(name[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    prefix, middle, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < spm_rate:
        return len(lines), "spm", prefix, middle, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", prefix, middle, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_query_equals_sql(spark, data):
    found = spark_rows(op13_fill_in_middle(spark, data))
    assert found == sql_rows(connect(data), SQL["op13_fill_in_middle"])
    assert len(found[1]) == awkward.table(spark, data).count()


def test_random_texts(spark):
    rng = random.Random(3)
    parts = ["\n", "\r\n", "a", "<P>", "<S", "P>", "$1", "\\", "é", "😀", " ", "<", ">", " ", "\x85"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(12)))) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for rate, spm_rate, seed in ((100, 50, 7), (40, 0, 8), (0, 50, 7)):
        found = infill.transformed(frame, rate=rate, spm_rate=spm_rate, seed=seed)
        got = found.select(
            "*", infill.parts("output", "form").alias("p"), infill.restored("output", "form").alias("r")
        ).collect()
        texts = dict(rows)
        assert len(got) == len(rows)
        for r in got:
            cut = (r["n"], r["form"], r["p"]["prefix"], r["p"]["middle"], r["output"])
            assert cut == wanted(r["doc_id"], texts[r["doc_id"]], rate, spm_rate, seed)
            assert r["r"] == texts[r["doc_id"]]


def test_other_units_and_marks(spark):
    frame = spark.createDataFrame([(i, "un deux  trois 4%d") for i in range(40)], "doc_id long, text string")
    marks = infill.Marks("[$pre]", "[suf]", "\\mid")
    found = infill.transformed(frame, unit=r" *[^ ]++", marks=marks)
    rows = found.select("*", infill.restored("output", "form", marks).alias("whole")).collect()
    assert {r["whole"] for r in rows} == {"un deux  trois 4%d"}
    assert {r["n"] for r in rows} == {4} and {r["form"] for r in rows} == {"psm", "spm"}
    assert len({r["output"] for r in rows}) > 10


def test_marks_that_can_be_mistaken_are_refused(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for marks in (("<P>", "<P>x", "<M>"), ("ab", "bc", "d"), ("aa", "b", "c"), ("", "b", "c"), ("a", "a", "b")):
        with pytest.raises(ValueError):
            infill.transformed(frame, marks=infill.Marks(*marks))


def test_awkward_rows(spark):
    found = infill.digests(infill.transformed(awkward.documents(spark))).collect()
    texts = awkward.documents(spark).select("doc_id", "text").collect()
    expected = []
    for key, text in texts:
        n, form, prefix, middle, output = wanted(key, text)
        sizes = [None if x is None else len(x) for x in (prefix, middle)]
        expected.append((key, n, form, *sizes, sha(output), sha(text or "")))
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, expected))
    assert infill.transformed(awkward.documents(spark).limit(0)).count() == 0


def test_many_lines_and_one_long_line(spark):
    texts = {1: "a\n" * 1_500_000, 2: "x" * 3_000_000, 3: "\n" * 1_000_000 + "end"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in infill.digests(infill.transformed(frame)).collect():
        n, form, prefix, middle, output = wanted(r["doc_id"], texts[r["doc_id"]])
        assert tuple(r)[1:6] == (n, form, len(prefix), len(middle), sha(output))
        assert r["restored_sha256"] == sha(texts[r["doc_id"]])


def test_plan_is_one_stage_without_python(spark, data):
    plan = op13_fill_in_middle(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("REGEXP_REPLACE") + plan.count("regexp_replace") == 1
