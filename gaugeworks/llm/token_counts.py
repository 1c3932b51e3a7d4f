"""Token counts by a linear longest-match automaton.

The vocabulary becomes a trie. Every node knows where matching goes on when the next byte has no
edge (its failure link) and how many pieces are popped on the way there, so a word is read once, byte by
byte, and its greedy longest-match pieces are counted without being built.

Edge cases: NULL counts as empty text (0 words, 0 tokens); a word that the vocabulary cannot
spell counts as one unknown token; very long texts and words cost linear time; repeated rows give
repeated results; an empty table gives an empty one. All rows and columns are kept, a column of the
input named like a new one as ``<name>_in``.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import ENTRY_BYTES, WORD_BYTES, broadcast_value, kept_in, set_aside

ROOT = 0


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes, by rule: printable
    Latin-1 characters stand for themselves, the others are numbered on from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_vocabulary(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file, as bytes."""
    letters = byte_alphabet()
    with open(path, encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    return [bytes(letters[c] for c in piece) for piece in pieces if all(c in letters for c in piece)]


def build_automaton(pieces: Iterable[bytes]) -> dict:
    """Edges keyed by node * 256 + byte, failure links (-1: none) and popped-piece counts."""
    edges: dict[int, int] = {}
    parent, letter, whole = [-1], [0], [False]
    for piece in pieces:
        node = ROOT
        for byte in piece:
            key = node << 8 | byte
            if key not in edges:
                edges[key] = len(parent)
                parent.append(node)
                letter.append(byte)
                whole.append(False)
            node = edges[key]
        whole[node] = node != ROOT
    failure, popped = [-1] * len(parent), [0] * len(parent)
    children: dict[int, list[int]] = {}
    for node in range(1, len(parent)):
        children.setdefault(parent[node], []).append(node)
    queue = deque(children.get(ROOT, ()))
    while queue:
        node = queue.popleft()
        queue.extend(children.get(node, ()))
        if whole[node]:
            failure[node], popped[node] = ROOT, 1
            continue
        place, count = failure[parent[node]], popped[parent[node]]
        while place >= 0 and (place << 8 | letter[node]) not in edges:
            count += popped[place]
            place = failure[place]
        if place >= 0:
            failure[node], popped[node] = edges[place << 8 | letter[node]], count
    return {"edges": edges, "failure": failure, "popped": popped}


def count_pieces(word: bytes, automaton: dict) -> int:
    """Greedy longest-match pieces of a word; 1 (unknown) if it cannot be spelled."""
    edges, failure, popped = automaton["edges"], automaton["failure"], automaton["popped"]
    node = total = 0
    for byte in word:
        while (step := edges.get(node << 8 | byte)) is None:
            if failure[node] < 0:
                return 1
            total += popped[node]
            node = failure[node]
        node = step
    while node != ROOT:
        if failure[node] < 0:
            return 1
        total += popped[node]
        node = failure[node]
    return total


class _Counts(dict):
    def __init__(self, automaton: dict, lead: bytes):
        super().__init__()
        self.automaton, self.lead, self.held = automaton, lead, 0

    def __missing__(self, word: bytes) -> int:
        if self.held > WORD_BYTES:
            self.clear()
            self.held = 0
        self.held += ENTRY_BYTES + len(word)
        value = self[word] = count_pieces(self.lead + word, self.automaton)
        return value


def with_token_counts(
    documents: DataFrame,
    pieces: Iterable[bytes],
    text_column: str = "text",
    lead: bytes = b" ",
    words_column: str = "n_words",
    tokens_column: str = "n_tokens",
) -> DataFrame:
    """Adds the words and the greedy word pieces of every whole text.

    Words are runs without blanks and control spaces; ``lead`` marks a word's start in the
    vocabulary.
    """
    documents = set_aside(documents, words_column, tokens_column)
    shared = broadcast_value(documents.sparkSession, {"automaton": build_automaton(pieces)})

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        counts = kept_in(known, "counts", lambda: _Counts(known["automaton"], lead))
        for batch in batches:
            words, tokens = [], []
            for text in batch:
                split = (text.as_py() or "").encode().split()
                words.append(len(split))
                tokens.append(sum(map(counts.__getitem__, split)))
            yield pa.StructArray.from_arrays(
                [pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["words", "tokens"]
            )

    counted = F.arrow_udf(count, "words long, tokens long", F.ArrowUDFType.SCALAR_ITER)(
        F.col(text_column)
    )
    own = "__gw_counts"
    return (
        documents.withColumn(own, counted)
        .withColumns({words_column: F.col(own)["words"], tokens_column: F.col(own)["tokens"]})
        .drop(own)
    )
