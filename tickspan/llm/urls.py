"""URL filters by a bit-parallel automaton over wildcard rules.

All rules are packed into the bits of one multiword Shift-And mask, one bit per character that a
rule must match. One step per character of the URL advances all rules at once:

    states = ((states << 1 | first bits) & matches[character]) | (states & loops[character])

where `loops` keeps the states that a wildcard follows. Wildcards: `*` is any run of characters,
`~` any run without a slash, `?` one character; after a backslash each of them stands for itself.
The steps run over batches of URLs in numpy.

A rule is matched against the canonical URL: a dot, the host in lower case, and the path. The dot
lets `~.example.org/` mean the host and all of its subdomains.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import flat, steps

#: Stands for a rule's beginning; no URL of valid UTF-8 has this byte.
BEGIN = 0xFF
#: Bytes of URLs that are worked on at once.
STEP = 1 << 18


@dataclass(frozen=True)
class Rule:
    """`name` is returned; `pattern` is a wildcard pattern of the canonical URL."""

    name: str
    verdict: str
    pattern: str


def domain_rule(verdict: str, host_and_path: str) -> Rule:
    """A rule for a host with all subdomains, and all paths that begin with the path given."""
    host, _, path = host_and_path.partition("/")
    return Rule(host_and_path, verdict, f"~.{escaped(host)}/{escaped(path)}*")


def escaped(text: str) -> str:
    """The pattern that matches just this text."""
    return "".join(f"\\{c}" if c in "\\*~?" else c for c in text)


class Automaton:
    """The masks of many wildcard patterns.

    Each pattern's first bit is matched by BEGIN alone; the others by its characters in order.
    """

    def __init__(self, patterns: list[str]):
        places: list[tuple[set[int], set[int]]] = []  # bytes that match, bytes that loop after
        self.first, self.last = [], []
        every, host = set(range(256)) - {BEGIN}, set(range(256)) - {BEGIN, ord("/")}
        for pattern in patterns:
            self.first.append(len(places))
            places.append(({BEGIN}, set()))
            literal = False
            for c in pattern.encode():
                if literal:
                    places.append(({c}, set()))
                    literal = False
                elif c == ord("\\"):
                    literal = True
                elif c in b"*~":
                    places[-1][1].update(every if c == ord("*") else host)
                else:
                    places.append((every if c == ord("?") else {c}, set()))
            self.last.append(len(places) - 1)
        self.words = max(1, -(-len(places) // 64))
        self.matches = np.zeros((256, self.words), np.uint64)
        self.loops = np.zeros((256, self.words), np.uint64)
        self.begins = np.zeros(self.words, np.uint64)
        for i, (match, loop) in enumerate(places):
            bit = np.uint64(1 << i % 64)
            for table, own in ((self.matches, match), (self.loops, loop)):
                table[sorted(own), i // 64] |= bit
        for i in self.first:
            self.begins[i // 64] |= np.uint64(1 << i % 64)

    def run(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """texts x patterns: whether the whole text matches."""
        starts, lengths = bounds[:-1], np.diff(bounds)
        states = np.tile(self.begins, (len(starts), 1))  # after BEGIN
        order = np.argsort(-lengths, kind="stable")
        live = len(order)
        ranked = lengths[order]
        for i in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-ranked[:live], -i, "left"))
            at = order[:live]
            c = np.minimum(data[starts[at] + i], BEGIN - 1)
            old = states[at]
            moved = old << np.uint64(1)
            moved[:, 1:] |= old[:, :-1] >> np.uint64(63)
            states[at] = (moved & self.matches[c]) | (old & self.loops[c])
        last = np.array(self.last, np.int64)
        bits = states[:, last // 64] >> (last % 64).astype(np.uint64)
        return (bits & np.uint64(1)).astype(bool)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    return F.translate(
        F.regexp_extract(_rest(url), r"^([^/?#]*)", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def matches(canonical: Column, patterns: list[str]) -> Column:
    """array<int>: the numbers of the patterns that a canonical URL matches, ascending."""
    automaton = Automaton(patterns)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data, bounds = flat(batch)
            out = []
            for a, b in steps(bounds, STEP):
                found = automaton.run(data, bounds[a : b + 1])
                out += [np.flatnonzero(row).astype(np.int32) for row in found]
            yield pa.array(out, pa.list_(pa.int32()))

    return run(canonical)


def judged(
    pages: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
    hidden: list[Rule] | None = None,
) -> DataFrame:
    """(id, host, path, rule, verdict, matched) of every row.

    The longest of the matching `rules` (by its name, ties to the smaller name) gives rule and
    verdict. Where none matches, rule is null and the verdict is that of the first matching
    pattern of `hidden`, else the default. `matched` has the names of all that match. Null URLs
    and those without `://` have an empty host and path. Repeated rows and null ids are returned
    as they are; other columns are not read.
    """
    everything = [*rules, *(hidden or [])]
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), rules[i].name))
    ranked += range(len(rules), len(everything))
    ordered = [everything[i] for i in ranked]
    url = F.col(url_column)
    found = pages.select(F.col(id_column), host_of(url).alias("host"), path_of(url).alias("path"))
    found = found.withColumn(
        "m", matches(F.concat(F.lit("."), "host", "path"), [r.pattern for r in ordered])
    )
    names = F.array(*[F.lit(r.name) for r in ordered])
    verdicts = F.array(*[F.lit(r.verdict) for r in ordered])
    first = F.try_element_at("m", F.lit(1))
    return found.select(
        id_column,
        "host",
        "path",
        F.when(first < len(rules), F.get(names, first)).alias("rule"),
        F.coalesce(F.get(verdicts, first), F.lit(default)).alias("verdict"),
        F.transform("m", lambda i: F.get(names, i)).alias("matched"),
    )
