import re

import numpy as np
from compare import connect, spark_rows, sql_rows

from tickspan.llm import urls
from tickspan.llm.queries import BLOCKED, RULES, SQL, op8_url_filter


def test_query_equals_sql(spark, data):
    found = spark_rows(op8_url_filter(spark, data))
    assert found == sql_rows(connect(data), SQL["op8_url_filter"])
    assert found[1]


def test_automaton_against_regular_expressions():
    rng = np.random.default_rng(4)
    letters = list("ab/.")
    patterns = ["".join(rng.choice(list("ab/.*~?"), rng.integers(0, 9))) for _ in range(150)]
    texts = ["".join(rng.choice(letters, rng.integers(0, 12))) for _ in range(600)]
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    automaton = urls.Automaton(patterns)
    assert automaton.words > 8
    found = automaton.run(np.frombuffer(b"".join(raw), np.uint8), bounds)
    marks = {"*": ".*", "~": "[^/]*", "?": "."}
    for i, p in enumerate(patterns):
        own = re.compile("".join(marks.get(c, re.escape(c)) for c in p), re.DOTALL)
        assert found[:, i].tolist() == [own.fullmatch(t) is not None for t in texts]


def test_awkward_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://EXAMPLE.org/es/X?y"), (4, "http://EXAMPLE.org/es/X?y"),
        (None, "http://a.de.com/de/"), (5, "x://notexample.org/es/"), (6, "http://org/"), (7, "http://a.org"),
        (8, "http://evil.net/.example.org/es/"), (9, "http://a.com/fr/" + "z" * 200_000),
        (10, "http://www.cheap-pills.net/"), (11, "a://b://c.org/d"), (12, "http://É.com/de/#x"), (13, "http://b.com?x/de/"),
    ]
    pages = spark.createDataFrame(
        [(*r, "h", "h", "p", "r", "m") for r in rows],
        "page_id long, url string, html string, host string, path string, rule string, m string",
    )
    got = [tuple(r)[:5] for r in urls.judged(pages, RULES, hidden=BLOCKED).collect()]
    assert len(got) == len(rows)
    by_id = {r[0]: r[1:] for r in got}
    for i in (1, 2, 3):
        assert by_id[i] == ("", "", None, "allow")
    assert by_id[4] == ("example.org", "/es/X", "example.org/es/", "block")
    assert by_id[None] == ("a.de.com", "/de/", "com/de/", "block")
    assert by_id[5][2:] == ("org/", "allow")
    assert by_id[6] == ("org", "/", "org/", "allow")
    assert by_id[7] == ("a.org", "", None, "allow")
    assert by_id[8][2:] == (None, "allow")
    assert by_id[9][2:] == ("com/fr/", "allow")
    assert by_id[10][2:] == (None, "block")
    assert by_id[11] == ("b:", "//c.org/d", None, "allow")
    assert by_id[12][2:] == ("com/de/", "block")
    assert by_id[13] == ("b.com", "", None, "allow")
    assert urls.judged(pages.limit(0), RULES).count() == 0


def test_wildcards_in_domain_rules_stand_for_themselves():
    rules = [
        urls.domain_rule("block", rule).pattern
        for rule in ("example.org/~joe/", "example.org/a?b", "example.org/x*", "example.org/c\\d")
    ]
    texts = [".example.org/billy-joe/", ".a.example.org/~joe/x", ".example.org/a?bc", ".example.org/axb"]
    texts += [".example.org/x*y", ".example.org/xy", ".example.org/c\\d", ".example.org/cd"]
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    found = urls.Automaton(rules).run(np.frombuffer(b"".join(raw), np.uint8), bounds)
    assert [np.flatnonzero(row).tolist() for row in found] == [[], [0], [1], [], [2], [], [3], []]
