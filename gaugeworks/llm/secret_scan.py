"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query of trigrams is derived that every text with a match
fulfils. Texts are indexed segment by segment: the postings of the trigrams that the queries name.
Postings are united and intersected as the queries say, and only the candidates run the
expression. Rules whose query is empty (no mandatory trigram) run on every text. A segment lies within
a task, so neither texts nor postings are shuffled.

Trigrams are of UTF-8 bytes with A-Z folded to a-z, in texts and queries alike.

Edge cases: NULL counts as empty text, with no spans; a text longer than a segment is a segment of its
own; equal rows give equal spans; spans of one rule do not overlap, those of different rules may. Rows and
columns are kept, a column of the input named like the new one as ``<name>_in``; an empty table gives
an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import astuple, dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import broadcast_value, kept_in, set_aside

# Bytes of text in a segment of the index; a single longer text has its own.
SEGMENT_BYTES = 4 << 20

# Strings that the analysis of an expression carries on exactly; more become trigrams at once.
MOST_STRINGS = 24

# Repetitions that are written out; further ones add no mandatory trigram of their own.
MOST_REPEATS = 3


@dataclass(frozen=True)
class Rule:
    """An expression; a match counts if the group has so many characters at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The rules every scan has.
BASE_RULES = (
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # A whole run at a time, as its first character is the first with 31 more after it.
    Rule("hex", r"[0-9a-f]{32,}"),
)

# Public formats of keys.
ADDED_RULES = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abeoprs]-[A-Za-z0-9-]{10,250}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,250}"),
    Rule("web", r"eyJ[A-Za-z0-9_-]{8,900}\.eyJ[A-Za-z0-9_-]{8,900}\.[A-Za-z0-9_-]{8,900}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("login", r"://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)

RULES = (*BASE_RULES, *ADDED_RULES)


# A query is a trigram (int), or ("and" | "or", queries); ALL asks for nothing.
ALL = ("and", ())


def both(*queries):
    parts: list = []
    for query in queries:
        parts += query[1] if isinstance(query, tuple) and query[0] == "and" else [query]
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("and", tuple(parts))


def either(*queries):
    if ALL in queries:
        return ALL
    parts: list = []
    for query in queries:
        parts += query[1] if isinstance(query, tuple) and query[0] == "or" else [query]
    parts = list(dict.fromkeys(parts))
    # A part that asks for all that another one asks for, and more, adds nothing.
    needs = [set(p[1]) if isinstance(p, tuple) and p[0] == "and" else {p} for p in parts]
    parts = [p for p, need in zip(parts, needs) if not any(other < need for other in needs)]
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def trigrams(text: bytes) -> list[int]:
    return [a << 16 | b << 8 | c for a, b, c in zip(text, text[1:], text[2:])]


def _all_of(strings: Iterable[bytes]):
    """Each match contains one of the strings."""
    return either(*(both(*trigrams(text)) for text in strings))


@dataclass(frozen=True)
class Found:
    """What is known of the matches of a part of an expression.

    Either all of them exactly, or sets of which one string begins and one ends each match; and a
    query they all fulfil.
    """

    exact: frozenset[bytes] | None
    starts: frozenset[bytes]
    ends: frozenset[bytes]
    query: tuple | int = ALL

    def opened(self) -> Found:
        """The same without exact strings."""
        if self.exact is None:
            return self
        return Found(
            None,
            frozenset(text[:2] for text in self.exact),
            frozenset(text[-2:] for text in self.exact),
            both(self.query, _all_of(self.exact)),
        )


_EMPTY = frozenset([b""])
NOTHING = Found(_EMPTY, _EMPTY, _EMPTY)
ANYTHING = Found(None, _EMPTY, _EMPTY)


def exactly(strings: Iterable[bytes]) -> Found:
    found = Found(frozenset(strings), _EMPTY, _EMPTY)
    return found if len(found.exact) <= MOST_STRINGS else found.opened()


def _then(left: Found, right: Found) -> Found:
    if left.exact is not None and right.exact is not None:
        if len(left.exact) * len(right.exact) <= MOST_STRINGS:
            return exactly(a + b for a, b in product(left.exact, right.exact))
    # The seam: one of the ends meets one of the starts.
    a, b = left.opened(), right.opened()
    seam = _all_of(x + y for x, y in product(a.ends, b.starts))
    starts, ends = a.starts, b.ends
    # A side that may be short or empty lets the other one show.
    if left.exact is not None and len(left.exact) * len(b.starts) <= MOST_STRINGS:
        starts = frozenset((x + y)[:2] for x, y in product(left.exact, b.starts))
    if right.exact is not None and len(right.exact) * len(a.ends) <= MOST_STRINGS:
        ends = frozenset((x + y)[-2:] for x, y in product(a.ends, right.exact))
    return Found(None, starts, ends, both(a.query, b.query, seam))


def _or(left: Found, right: Found) -> Found:
    if left.exact is not None and right.exact is not None:
        return exactly(left.exact | right.exact)
    a, b = left.opened(), right.opened()
    return Found(None, a.starts | b.starts, a.ends | b.ends, either(a.query, b.query))


def _letters(codes: Iterable[int], flags: int) -> Found:
    """One of the characters; letter case that goes beyond ASCII is not followed."""
    letters = [chr(code) for code in codes]
    if flags & re.IGNORECASE and any(not c.isascii() for c in letters):
        return ANYTHING
    if flags & re.IGNORECASE and not flags & re.ASCII and any(c in "iksIKS" for c in letters):
        return ANYTHING
    return exactly(c.encode().lower() for c in letters)


def _class(items: list, flags: int) -> Found:
    codes: list[int] = []
    for kind, value in items:
        if kind is op.LITERAL:
            codes.append(value)
        elif kind is op.RANGE and value[1] - value[0] < 4 * MOST_STRINGS:
            codes += range(value[0], value[1] + 1)
        else:
            return ANYTHING
    folded = {chr(code).lower() for code in codes}
    return _letters(codes, flags) if len(folded) <= MOST_STRINGS else ANYTHING


def _known(items: Iterable, flags: int) -> Found:
    found = NOTHING
    for kind, value in items:
        if kind is op.LITERAL:
            part = _letters([value], flags)
        elif kind is op.IN:
            part = _class(value, flags)
        elif kind is op.SUBPATTERN:
            _, on, off, inner = value
            part = _known(inner, (flags | on) & ~off)
        elif kind is op.ATOMIC_GROUP:
            part = _known(value, flags)
        elif kind is op.BRANCH:
            choices = [_known(branch, flags) for branch in value[1]]
            part = choices[0]
            for choice in choices[1:]:
                part = _or(part, choice)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            part = _repeated(*value, flags)
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            part = NOTHING
        else:
            part = ANYTHING
        found = _then(found, part)
    return found


def _repeated(least: int, most: int, inner, flags: int) -> Found:
    one = _known(inner, flags)
    found = NOTHING
    for _ in range(min(least, MOST_REPEATS)):
        found = _then(found, one)
    if least == most <= MOST_REPEATS:
        return found
    if least == 0 and most == 1:
        return _or(NOTHING, one)
    # More repetitions may follow; the last one ends the match.
    rest = Found(None, _EMPTY, one.opened().ends if least else _EMPTY)
    return _then(found, rest)


def trigram_query(pattern: str, flags: int = 0):
    """A query that every text with a match of the expression fulfils."""
    parsed = parser.parse(pattern, flags)
    return _known(parsed, parsed.state.flags).opened().query


def asked(query) -> set[int]:
    """The trigrams that a query names."""
    if isinstance(query, int):
        return {query}
    return set().union(*map(asked, query[1])) if query[1] else set()


class Segment:
    """The inverted index of some texts: for each trigram that is asked for, their numbers in order."""

    def __init__(self, texts: list[bytes], slots: np.ndarray, names: list[int]):
        self.size = len(texts)
        # A zero byte parts the texts; a trigram across it is asked for by none.
        data = np.frombuffer(b"\x00".join(texts).lower() + b"\x00\x00", np.uint8)
        code = data[:-2].astype(np.int32)
        for step in (1, 2):
            code <<= 8
            code |= data[step : len(data) - 2 + step]
        met = slots[code]
        at = np.flatnonzero(met)
        starts = np.cumsum([0, *(len(text) + 1 for text in texts)])
        row = np.searchsorted(starts, at, "right") - 1
        pairs = np.unique(met[at].astype(np.int64) * (self.size + 1) + row)
        slot, row = pairs // (self.size + 1), pairs % (self.size + 1)
        cuts = np.searchsorted(slot, np.arange(1, len(names) + 2))
        self.postings = {
            name: row[cuts[k] : cuts[k + 1]] for k, name in enumerate(names) if cuts[k] < cuts[k + 1]
        }

    def candidates(self, query) -> np.ndarray:
        if isinstance(query, int):
            return self.postings.get(query, np.empty(0, np.int64))
        kind, parts = query
        if kind == "or":
            return np.unique(np.concatenate([self.candidates(part) for part in parts]))
        found = np.arange(self.size)
        for part in parts:
            found = np.intersect1d(found, self.candidates(part), assume_unique=True)
            if not len(found):
                break
        return found


class Scanner:
    """Rules with their queries, ready to scan."""

    def __init__(self, rules: Iterable[Rule]):
        self.rules = [(rule, re.compile(rule.pattern)) for rule in rules]
        self.queries = [trigram_query(rule.pattern) for rule, _ in self.rules]
        self.names = sorted(set().union(*map(asked, self.queries)))
        self.slots = np.zeros(1 << 24, np.uint16)
        self.slots[self.names] = np.arange(1, len(self.names) + 1)

    def spans(self, texts: list[str]) -> list[list[dict]]:
        """The spans of each text, by start and then by the order of the rules."""
        segment = Segment([text.encode() for text in texts], self.slots, self.names)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, expression) in enumerate(self.rules):
            for row in segment.candidates(self.queries[number]).tolist():
                found[row] += (
                    (match.start(), number, match.end())
                    for match in expression.finditer(texts[row])
                    if match.end(rule.group) - match.start(rule.group) >= rule.least
                )
        kinds = [rule.kind for rule, _ in self.rules]
        return [
            [{"kind": kinds[k], "start": start, "end": end} for start, k, end in sorted(spans)]
            for spans in found
        ]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def with_secrets(
    documents: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text_column: str = "text",
    spans_column: str = "secrets",
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """Adds the spans (kind, start, end in code points) that the rules find in every whole text."""
    documents = set_aside(documents, spans_column)
    shared = broadcast_value(documents.sparkSession, {"rules": [astuple(rule) for rule in rules]})

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        scanner = kept_in(known, "scanner", lambda: Scanner([Rule(*r) for r in known["rules"]]))
        for batch in batches:
            spans: list[list[dict]] = []
            texts: list[str] = []
            size = 0
            for value in batch:
                text = value.as_py() or ""
                if texts and size + len(text) > segment_bytes:
                    spans += scanner.spans(texts)
                    texts, size = [], 0
                texts.append(text)
                size += len(text)
            yield pa.array(spans + scanner.spans(texts), _SPANS)

    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    found = F.arrow_udf(scan, kind, F.ArrowUDFType.SCALAR_ITER)(F.col(text_column))
    return documents.withColumn(spans_column, found)
