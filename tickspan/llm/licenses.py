"""License scans: exact phrases, and short notices found with a bounded number of errors.

A notice that may have k errors is cut into k + 1 pieces: k errors leave one piece untouched
(pigeonhole). One automaton of all notices' pieces runs over the normalised text; around each hit
the regex library's bounded-error matching verifies the notice, counts its errors and gives the
span. So the costly matching sees a few places only, and misses nothing that it would find.
Where notices overlap, those with the fewest errors count; numbers and the words that tell
variants of a license apart match without error.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import texts_of

# Phrases that the exact search finds, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Short notices in normalised words, and their labels.
NOTICES = {
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under the gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by nd 4 0": "cc-by-nd-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "released into the public domain": "public-domain",
    "dedicated to the public domain under cc0": "cc0",
}
#: One error for so many characters of a notice.
CHARACTERS_PER_ERROR = 10

#: Words of notices, besides numbers, that match without error.
STRICT = {"nc", "sa", "nd"}

# ASCII other than letters and digits cuts words; A-Z become a-z; all else stands in words.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)


def normalised(text: bytes) -> tuple[bytes, int]:
    """The words between single blanks, one before and one after all, and their number."""
    words = text.translate(NORMAL).split()
    return b" " + b" ".join(words) + b" ", len(words)


@dataclass(frozen=True)
class Match:
    label: str
    first_word: int
    words: int
    errors: int
    similarity: float
    start: int = 0  # in characters of the normalised text
    end: int = 0


class Scanner:
    """The phrases and notices, ready to search."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, str], per_error: int):
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.notices = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (notice, label) in enumerate(notices.items()):
            errors = len(notice) // per_error
            # The best match with the fewest errors; each error is one character.
            pattern = regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={errors}}}")
            self.notices.append((notice, label, errors, pattern, _strict(notice, errors)))
            cuts = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(notice[a:b], []).append((n, a))
        self.pieces = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.pieces.add_word(piece, (len(piece), uses))
        if pieces:
            self.pieces.make_automaton()
        self.any = bool(pieces)

    def exact(self, text: bytes) -> list[tuple[int, str]]:
        """(first word, label) of each place of a phrase in normalised text, in order."""
        out = []
        for phrase, label in self.phrases:
            at, blanks, counted = text.find(phrase), 0, 0
            while at >= 0:
                blanks += text.count(b" ", counted, at)
                counted = at
                out.append((blanks, label))
                at = text.find(phrase, at + 1)
        return sorted(out)

    def fuzzy(self, text: bytes) -> list[Match]:
        """Each notice by itself in normalised text, by their places; one match for each place."""
        return self._found(text, 3)

    def best(self, text: bytes) -> list[Match]:
        """The notices with their strict words; of those that overlap, the ones of fewest errors."""
        out: list[Match] = []
        found = self._found(text, 4)
        at = 0
        while at < len(found):
            # A run of matches that overlap, one with the next.
            run, end = [], found[at].end
            while at < len(found) and (not run or found[at].start < end):
                run.append(found[at])
                end = max(end, found[at].end)
                at += 1
            kept: list[Match] = []
            for m in sorted(run, key=lambda x: (x.errors, x.start - x.end, x.start)):
                same = [k for k in kept if _shared(k, m)]
                if not any(k.errors < m.errors or k.label == m.label for k in same):
                    kept.append(m)
            out += kept
        return sorted(out, key=lambda x: (x.first_word, x.label, x.errors))

    def _found(self, text: bytes, kind: int) -> list[Match]:
        """The matches of all notices by their start; kind: which pattern of a notice."""
        if not self.any:
            return []
        line = text.decode("latin-1")  # one character per byte
        begins: dict[int, set[int]] = {}
        for end, (size, uses) in self.pieces.iter(line):
            for n, offset in uses:
                begins.setdefault(n, set()).add(end + 1 - size - offset)
        out = []
        for n, places in begins.items():
            notice, label, most, *_ = self.notices[n]
            blanks = counted = 0
            for start, end, errors in _spans(
                line, len(notice), most, self.notices[n][kind], sorted(places)
            ):
                blanks += line.count(" ", counted, start)
                counted = start
                first = blanks if line[start] == " " else blanks - 1
                words = len(line[start:end].split())
                similarity = 1 - errors / len(notice)
                out.append(Match(label, max(0, first), words, errors, similarity, start, end))
        return sorted(out, key=lambda x: (x.start, x.label, x.errors))


def _strict(notice: str, errors: int) -> regex.Pattern:
    """The notice with errors in all words but numbers and STRICT ones.

    Every run of other words may have all errors; who searches checks their sum.
    """
    runs: list[tuple[bool, list[str]]] = []
    for word in notice.split():
        strict = word.isdigit() or word in STRICT
        if not runs or runs[-1][0] != strict:
            runs.append((strict, []))
        runs[-1][1].append(word)
    parts = [
        f"(?<= ){regex.escape(' '.join(words))}(?= )"
        if strict
        else f"(?:{regex.escape(' '.join(words))}){{e<={errors}}}"
        for strict, words in runs
    ]
    return regex.compile(f"(?b){regex.escape(' ').join(parts)}")


def _spans(
    line: str, length: int, most: int, pattern: regex.Pattern, begins: list[int]
) -> list[tuple[int, int, int]]:
    """(start, end, errors) of one notice's matches: fewest errors first, none that overlap.

    Begins that lie close share a window, which is hardly longer than the notice. What the spans
    leave free of the windows is searched again until it has no match.
    """
    windows: list[tuple[int, int]] = []
    first = None
    for begin in begins:
        stop = min(len(line), begin + length + most + 1)
        if first is not None and begin - first <= 2 * most:
            windows[-1] = (windows[-1][0], stop)
        else:
            first = begin
            windows.append((max(0, begin - most), stop))
    spans: list[tuple[int, int, int]] = []  # by start
    while windows:
        found, left = [], []
        for window in windows:
            (a, b), hit = window, False
            i = max(0, bisect_right(spans, (a, len(line), 0)) - 1)
            for start, end, _ in [*_until(spans, i, b), (b, b, 0)]:
                if start - a >= length - most:
                    m = pattern.search(line, a, min(start, b))
                    if m is not None and sum(m.fuzzy_counts) <= most and m.end() > m.start():
                        found.append((sum(m.fuzzy_counts), m.start(), m.end()))
                        hit = True
                a = max(a, end)
            if hit:
                left.append(window)
        new: list[tuple[int, int, int]] = []
        for errors, start, end in sorted(set(found)):
            i = bisect_right(new, (start, len(line), 0))
            if (i == 0 or new[i - 1][1] <= start) and (i == len(new) or new[i][0] >= end):
                new.insert(i, (start, end, errors))
        spans = sorted(spans + new)
        windows = left
    return spans


def _until(spans: list[tuple[int, int, int]], i: int, stop: int) -> Iterator[tuple[int, int, int]]:
    """The spans from number i on that begin before `stop`."""
    while i < len(spans) and spans[i][0] < stop:
        yield spans[i]
        i += 1


def _shared(a: Match, b: Match) -> bool:
    """Whether two matches are at one place: they share more than half of the shorter one."""
    shared = min(a.end, b.end) - max(a.start, b.start)
    return 2 * shared > min(a.end - a.start, b.end - b.start)


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, notices: tuple, per_error: int) -> Scanner:
    return Scanner(dict(phrases), dict(notices), per_error)


RESULT = (
    "struct<n_words:long, n_base:long, first_word:long, last_word:long, base_labels:string, "
    "labels:string, score:double, matches:array<struct<label:string, first_word:long, "
    "words:long, errors:int>>>"
)


def scan(
    text: Column,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    per_error: int = CHARACTERS_PER_ERROR,
) -> Column:
    """Phrases and notices of a whole text, as a struct.

    n_words; n_base: all places of phrases; first_word, last_word: their smallest and largest
    start, else null; base_labels and, with those of the notices, labels: distinct, sorted, joined
    by commas, else empty; score: 1 with a phrase, else the best notice's share of characters
    without error, else 0; matches: the notices with their spans in words and errors. Null and
    empty texts have no words.
    """
    key = (tuple(phrases.items()), tuple(notices.items()), per_error)

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = _scanner(*key)
        names = [
            "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"
        ]
        kinds = [
            pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
            pa.list_(
                pa.struct(
                    [
                        ("label", pa.string()),
                        ("first_word", pa.int64()),
                        ("words", pa.int64()),
                        ("errors", pa.int32()),
                    ]
                )
            ),
        ]
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for text in texts_of(batch):
                line, n = normalised(text)
                base, found = scanner.exact(line), scanner.best(line)
                own = {label for _, label in base}
                best = max([0.0, *(m.similarity for m in found)])
                row = (
                    n,
                    len(base),
                    base[0][0] if base else None,
                    base[-1][0] if base else None,
                    ",".join(sorted(own)),
                    ",".join(sorted(own | {m.label for m in found})),
                    1.0 if base else best,
                    [
                        {"label": m.label, "first_word": m.first_word, "words": m.words, "errors": m.errors}
                        for m in found
                    ],
                )
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names
            )

    return run(text)


def scanned(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """(id, and the fields of `scan`) of every row.

    Rows are judged one by one: repeated rows and null ids are returned as they are; other columns
    are not read.
    """
    found = docs.select(F.col(id_column), scan(F.col(text_column), **options).alias("s"))
    return found.select(id_column, "s.*")
