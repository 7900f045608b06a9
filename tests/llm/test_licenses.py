import re

import awkward
import regex
from compare import connect

from tickspan.llm import licenses
from tickspan.llm.queries import op7_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    base = []
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return words, sorted(base)


def test_query_against_plain_search(spark, data):
    texts = {r["doc_id"]: r["text"] for r in awkward.table(spark, data).collect()}
    rows = op7_licenses(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words, base = plain(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (len(words), len(base))
        assert (r["first_word"], r["last_word"]) == (
            (base[0][0], base[-1][0]) if base else (None, None)
        )
        labels = {label for _, label in base}
        assert r["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert sum(r["n_base"] > 0 for r in rows) > 10


def test_places_in_sql(data, spark):
    """The number of MIT phrases, by SQL."""
    sql = """SELECT doc_id, len(regexp_extract_all(
        ' ' || array_to_string(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[a-z0-9\\x{80}-\\x{10FFFF}]+'), '  ') || ' ', ' mit  license ')) AS n
        FROM documents"""
    wanted = {i: n for i, n in connect(data).execute(sql).fetchall() if n}
    rows = licenses.scanned(
        awkward.table(spark, data), phrases={"mit license": "mit"}, notices={}
    ).collect()
    assert {r["doc_id"]: r["n_base"] for r in rows if r["n_base"]} == wanted


def test_seeds_miss_no_match():
    """Every place that the bounded-error matching finds in the whole text is found."""
    scanner = licenses.Scanner({}, licenses.NOTICES, licenses.CHARACTERS_PER_ERROR)
    notices = [
        "Relesed under teh MIT License", "licensed under the apache lisence, version 2.0",
        "licenced under the gnu general public license version 3", "Licensed under CC BY-NC 4.0",
        "released into he public domian", "nothing of the kind",
    ]
    for text in notices:
        line, _ = licenses.normalised(f"before it {text} and after".encode())
        found = {m.label for m in scanner.fuzzy(line)}
        wanted = {
            label
            for notice, label in licenses.NOTICES.items()
            if regex.search(
                f"(?b)(?:{notice}){{e<={len(notice) // licenses.CHARACTERS_PER_ERROR}}}",
                line.decode("latin-1"),
            )
        }
        assert found == wanted
        assert bool(found) == (text != notices[-1])


def test_spans_and_scores(spark):
    docs = awkward.documents(
        spark,
        [
            (1, "One two. Released under teh MIT license; MIT license", "en"),
            (2, "relaesed into the public domain", "en"),
            (3, "mit license mit license apache license", "en"),
        ],
    )
    rows = {r["doc_id"]: r for r in licenses.scanned(docs).collect()}
    assert (rows[1]["n_base"], rows[1]["first_word"], rows[1]["last_word"]) == (2, 5, 7)
    assert rows[1]["matches"][0]["first_word"] == 2 and rows[1]["score"] == 1.0
    assert rows[2]["labels"] == "public-domain" and rows[2]["base_labels"] == ""
    assert 0.9 < rows[2]["score"] < 1 and rows[2]["matches"][0]["errors"] == 2
    assert (rows[3]["n_base"], rows[3]["base_labels"]) == (3, "apache,mit")


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    rows = licenses.scanned(docs).collect()
    assert len(rows) == 12
    assert {r["n_words"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert {r["n_words"] for r in rows if r["doc_id"] == 7} == {180_000}
    assert licenses.scanned(docs.limit(0)).count() == 0


def labels_of(text):
    scanner = licenses.Scanner({}, licenses.NOTICES, licenses.CHARACTERS_PER_ERROR)
    return [m.label for m in scanner.best(licenses.normalised(f"so {text} it is".encode())[0])]


def test_fewest_errors_win_where_notices_overlap():
    for notice, label in licenses.NOTICES.items():
        assert labels_of(notice) == [label], notice
    assert labels_of("licenced under the gnu general public license version 3") == ["gpl-3"]
    assert labels_of("licenced under the gnu general public license version 2") == ["gpl-2"]
    for version in ("4", "23", "33"):
        assert labels_of(f"licensed under the gnu general public license version {version}") == []
    assert labels_of("Licensed undr CC BY-NC 4.0") == ["cc-by-nc-4.0"]
    assert labels_of("Licensed under CC BY-NC-SA 4.0") == []
    assert labels_of("licensed under cc by 4.0, licensed under cc by sa 4.0") == [
        "cc-by-4.0", "cc-by-sa-4.0"
    ]


def test_every_notice_of_a_run_is_found():
    exact, wrong = "released under the mit license", "releasd under teh mit license"
    scanner = licenses.Scanner({}, {exact: "mit"}, licenses.CHARACTERS_PER_ERROR)
    for lines in ([wrong, exact], [wrong] * 3 + [exact] + [wrong] * 2, [exact] * 4, [wrong] * 200):
        line = licenses.normalised(" ".join(lines).encode())[0]
        for found in (scanner.best(line), scanner.fuzzy(line)):
            assert [m.first_word for m in found] == [5 * i for i in range(len(lines))]
            assert [m.errors == 0 for m in found] == [x == exact for x in lines]


def test_places_are_counted_over_a_long_text():
    text = ("a mit license under cc by b " * 3000).encode()
    line, n = licenses.normalised(text)
    scanner = licenses.Scanner(licenses.PHRASES, {}, 10)
    words, base = plain(text.decode())
    assert (n, scanner.exact(line)) == (len(words), base)
