"""Byte-level BPE encoding and decoding by speculation and verification.

Words are first encoded by a guess, for many words at once (numpy): every pair that ranks before the
pairs beside it is merged, whatever is still to happen further off; long words are cut by greedy
longest match. All adjacent pairs of the guesses are then tested at once: a sequence is the BPE
encoding exactly if every two neighbours are what BPE makes of the two of them. Only words with a
failing pair go through the merges one by one.

Edge cases: NULL encodes like empty text, to no ids; special tokens in a text become their ids, as the
file's own added tokens ask for; very long texts and words are encoded whole, words merging in
n log n; repeated rows give repeated results; ids outside the vocabulary raise; an empty table gives an
empty one. All rows and columns are kept, a column of the input named like a new one as ``<name>_in``.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import OWN, broadcast_value, kept_in, release, set_aside
from gaugeworks.llm.token_counts import byte_alphabet

# Fixed value: how byte-level BPE files of this kind cut text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NEVER = np.int64(1) << 40

# Longer words (in bytes) are merged with a heap.
SHORT = 48
# Words encoded at once; bounds the memory, not the result.
LEARNT = 1 << 15
# Texts whose words are proposed and verified together.
TOGETHER = 64
# Bytes of encoded words that a task remembers, with what Python needs for an entry beside its text.
KNOWN_BYTES = 32 << 20
ENTRY_BYTES = 200


@cache
def plain_words() -> re.Pattern:
    """``WORDS`` for texts within the first 65536 code points, where ``re`` is the faster one.

    Its classes hold what ``regex`` counts as such there.
    """
    everything = "".join(map(chr, range(1 << 16)))
    blank, letter, number = (
        "".join(f"\\u{m.start():04x}-\\u{m.end() - 1:04x}" for m in regex.finditer(kind, everything))
        for kind in (r"\s+", r"\p{L}+", r"\p{N}+")
    )
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{blank}{letter}{number}]+"
        rf"|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


def read_vocabulary(path: str) -> dict:
    """Pieces by id, merges in order of rank, special tokens: what a file of the format holds."""
    letters = byte_alphabet()
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    pieces: dict[int, bytes] = {}
    for piece, number in data["model"]["vocab"].items():
        pieces[number] = bytes(letters[c] for c in piece)
    special = {token["content"]: token["id"] for token in data["added_tokens"]}
    pieces |= {number: content.encode() for content, number in special.items()}
    ids = {piece: number for number, piece in pieces.items() if number not in special.values()}
    merges = []
    for merge in data["model"]["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        left, right = (bytes(letters[c] for c in part) for part in (left, right))
        merges.append((ids[left], ids[right], ids[left + right]))
    return {"pieces": pieces, "special": special, "merges": np.array(merges, np.int64).reshape(-1, 3)}


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: dict):
        pieces, merges = vocabulary["pieces"], vocabulary["merges"]
        self.special = vocabulary["special"]
        self.pieces = pieces
        self.ids = {p: k for k, p in pieces.items() if k not in self.special.values()}
        self.width = max(pieces, default=0) + 1
        keys = merges[:, 0] * self.width + merges[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.rank_of = {(int(a), int(b)): k for k, (a, b, _) in enumerate(merges)}
        self.made = merges[:, 2].tolist()
        self.bytes = [self.ids.get(bytes([byte]), -1) for byte in range(256)]
        self.byte_ids, self.made_ids = np.array(self.bytes, np.int64), merges[:, 2].astype(np.int64)
        # When a piece comes into being, and of which two it is made; bytes are there from the start.
        self.born = np.full(self.width, -1, np.int64)
        self.left = np.arange(self.width, dtype=np.int64)
        self.right = np.arange(self.width, dtype=np.int64)
        first = merges[::-1]
        self.born[first[:, 2]] = np.arange(len(merges))[::-1]
        self.left[first[:, 2]], self.right[first[:, 2]] = first[:, 0], first[:, 1]
        # Pieces that the merges never leave whole are not proposed.
        whole = self._stay_apart(merges[:, 0], merges[:, 1], self.born[merges[:, 2]])
        whole &= self.born[merges[:, 2]] == np.arange(len(merges))
        usable = {k for p, k in self.ids.items() if len(p) == 1}
        for left, right, made in merges[whole].tolist():
            if left in usable and right in usable:
                usable.add(made)
        self.proposed = {p: k for p, k in self.ids.items() if k in usable}
        self.usable = np.zeros(self.width, bool)
        self.usable[list(usable)] = True
        self.longest = max(map(len, self.proposed), default=1)
        self.cut, self.cut_plain = regex.compile(WORDS), plain_words()
        self.specials = (
            regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
            if self.special
            else None
        )
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    def forget(self) -> None:
        self.known.clear()
        self.known_bytes = 0

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        if not len(self.keys):
            return np.full(len(keys), _NEVER)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.ranks[place], _NEVER)

    def _stay_apart(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the seam of each pair before the time ``limit``.

        Goes back in time: the later made of the two pieces at the seam is taken apart, and what
        then touches must not merge sooner than that piece came into being. At the same rank the
        leftmost merge is the first.
        """
        apart = np.ones(len(left), bool)
        rows = np.arange(len(left))
        left, right, limit = left.copy(), right.copy(), limit.copy()
        tied = np.zeros(len(left), bool)
        while len(rows):
            rank = self._rank(left, right)
            crossed = (rank < limit) | (tied & (rank == limit) & (rank < _NEVER))
            apart[rows[crossed]] = False
            born_left, born_right = self.born[left], self.born[right]
            alive = ~crossed & ((born_left >= 0) | (born_right >= 0))
            later = born_left > born_right
            limit = np.where(later, born_left, born_right)[alive]
            tied = ~later[alive]
            left, right = (
                np.where(later, self.right[left], left)[alive],
                np.where(later, right, self.left[right])[alive],
            )
            rows = rows[alive]
        return apart

    def propose(self, word: bytes) -> list[int]:
        found, place, size = [], 0, len(word)
        proposed, longest = self.proposed, self.longest
        while place < size:
            for end in range(min(size, place + longest), place, -1):
                number = proposed.get(word[place:end])
                if number is not None:
                    found.append(number)
                    place = end
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return found

    def propose_each(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Proposals for words of any length, as ``propose_all`` gives them."""
        guesses = [self.propose(word) for word in words]
        flat = np.array([number for guess in guesses for number in guess], np.int64)
        return flat, np.cumsum([len(guess) for guess in guesses])

    def propose_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Proposals for short words: their ids one after the other, and where each word ends.

        Of pairs with the same rank that overlap, every second is merged, as from the left.
        """
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        if (ids < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        last = np.zeros(len(ids), bool)
        last[np.cumsum([len(word) for word in words], dtype=np.int64) - 1] = True
        rank = np.full(len(ids), _NEVER)  # of each id and the next of its word
        stale = np.flatnonzero(~last)
        while len(stale):
            rank[stale] = self._rank(ids[stale], ids[stale + 1])
            ready = np.flatnonzero(rank < _NEVER)
            own = rank[ready]
            ready = ready[(own <= rank[ready - 1]) & (own <= rank[ready + 1])]
            place = np.arange(len(ready))
            begins = np.diff(ready, prepend=-2) > 1
            ready = ready[(place - np.maximum.accumulate(place * begins)) % 2 == 0]
            ids[ready] = self.made_ids[rank[ready]]
            last[ready] = last[ready + 1]
            rank[ready] = _NEVER
            stays = np.ones(len(ids), bool)
            stays[ready + 1] = False
            ids, last, rank = ids[stays], last[stays], rank[stays]
            ready -= np.arange(len(ready))
            stale = np.concatenate([ready, ready - 1])
            stale = stale[~last[stale]]
        return ids, np.flatnonzero(last) + 1

    def merge(self, word: bytes) -> list[int]:
        """The encoding by the merges themselves: lowest rank first, leftmost first."""
        ids = [self.bytes[byte] for byte in word]
        if len(ids) > SHORT:
            return self._merge_long(ids)
        rank_of, never = self.rank_of.get, len(self.made)
        ranks = [rank_of(pair, never) for pair in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < never:
            k = ranks.index(rank)
            ids[k : k + 2] = [self.made[rank]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank_of((ids[k - 1], ids[k]), never)
            if k < len(ranks):
                ranks[k] = rank_of((ids[k], ids[k + 1]), never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs, for long words."""
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = [
            (rank, k)
            for k in range(len(ids) - 1)
            if (rank := self.rank_of.get((ids[k], ids[k + 1]))) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            other = after[k]
            if ids[k] < 0 or other < 0 or self.rank_of.get((ids[k], ids[other])) != rank:
                continue
            ids[k], ids[other] = self.made[rank], -1
            after[k] = after[other]
            if after[k] >= 0:
                before[after[k]] = k
            for start, end in ((before[k], k), (k, after[k])):
                if start >= 0 and end >= 0:
                    new = self.rank_of.get((ids[start], ids[end]))
                    if new is not None:
                        heapq.heappush(heap, (new, start))
        return [number for number in ids if number >= 0]

    def learn(self, words: set[str]) -> None:
        """Encodes words that are not known yet, many at once."""
        data = {name: name.encode() for name in words}
        short = [name for name, word in data.items() if len(word) <= SHORT]
        long = [name for name, word in data.items() if len(word) > SHORT]
        for names, propose in ((short, self.propose_all), (long, self.propose_each)):
            for start in range(0, len(names), LEARNT):
                some = names[start : start + LEARNT]
                coded = [data[name] for name in some]
                self._learn(some, coded, *propose(coded))

    def _learn(self, names: list[str], data: list[bytes], flat: np.ndarray, ends: np.ndarray) -> None:
        """Keeps the proposals that are right, and merges the other words."""
        pairs = flat[:-1] * self.width + flat[1:]
        unique, place = np.unique(pairs, return_inverse=True)
        apart = self._stay_apart(
            unique // self.width, unique % self.width, np.full(len(unique), _NEVER)
        )[place]
        apart[ends[:-1] - 1] = True  # the seam between two words
        wrong = ~self.usable[flat]
        wrong[:-1] |= ~apart
        wrong = np.concatenate([[0], np.cumsum(wrong)])[np.concatenate([[0], ends])]
        packed, cuts = flat.astype(np.int32).tobytes(), pairwise([0, *(4 * ends).tolist()])
        self.known.update(zip(names, (packed[start:end] for start, end in cuts), strict=True))
        self.known_bytes += ENTRY_BYTES * len(names) + 2 * sum(map(len, names)) + len(packed)
        for k in np.flatnonzero(np.diff(wrong)).tolist():
            exact = np.array(self.merge(data[k]), np.int32).tobytes()
            self.known_bytes += len(exact) - len(self.known[names[k]])
            self.known[names[k]] = exact

    def words(self, text: str) -> list[str]:
        plain = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return (self.cut_plain if plain else self.cut).findall(text)

    def parts(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """Words up to each special token, and its id."""
        place = 0
        for match in self.specials.finditer(text) if self.specials else ():
            yield self.words(text[place : match.start()]), self.special[match[0]]
            place = match.end()
        yield self.words(text[place:] if place else text), None

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as 32-bit integers."""
        cut = [list(self.parts(text)) for text in texts]
        words = set().union(*(part for parts in cut for part, _ in parts))
        if self.known_bytes > KNOWN_BYTES:
            self.forget()
        self.learn(words.difference(self.known))
        known = self.known.__getitem__
        return [
            b"".join(
                b"".join(map(known, part))
                + (b"" if special is None else np.array([special], np.int32).tobytes())
                for part, special in parts
            )
            for parts in cut
        ]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")

    def decode_all(self, ids: list[int], sizes: list[int | None]) -> list[str | None]:
        """The texts of several id lists that lie one after the other."""
        found, place = [], 0
        for size in sizes:
            found.append(None if size is None else self.decode(ids[place : place + size]))
            place += size or 0
        return found


def _codec(shared) -> Codec:
    return kept_in(shared.value, "codec", lambda: Codec(shared.value["vocabulary"]))


def _done(shared) -> None:
    """What a task built goes with it; the next task builds it anew in a fraction of a second."""
    shared.value.pop("codec", None)
    release()


def _in_parts(batch: pa.Array) -> Iterator[pa.Array]:
    for start in range(0, len(batch), TOGETHER):
        yield batch.slice(start, TOGETHER)


def _id_lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(ids) // 4 for ids in packed)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def with_round_trip(
    documents: DataFrame,
    vocabulary: dict,
    text_column: str = "text",
    ids_column: str = "token_ids",
    decoded_column: str = "decoded",
) -> DataFrame:
    """Adds the token ids of every whole text and the text that they stand for, in one pass."""
    documents = set_aside(documents, ids_column, decoded_column)
    shared = broadcast_value(documents.sparkSession, {"vocabulary": vocabulary})

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(shared)
        for batch in batches:
            packed: list[bytes] = []
            texts: list[str] = []
            for part in _in_parts(batch):
                found = codec.encode([text or "" for text in part.to_pylist()])
                texts += [codec.decode(np.frombuffer(ids, np.int32).tolist()) for ids in found]
                packed += found
            yield pa.StructArray.from_arrays(
                [_id_lists(packed), pa.array(texts, pa.string())], ["ids", "decoded"]
            )
        _done(shared)

    both = F.arrow_udf(run, "ids array<int>, decoded string", F.ArrowUDFType.SCALAR_ITER)
    own = f"{OWN}tokens"
    return (
        documents.withColumn(own, both(F.col(text_column)))
        .withColumns({ids_column: F.col(own)["ids"], decoded_column: F.col(own)["decoded"]})
        .drop(own)
    )


def with_token_ids(
    documents: DataFrame, vocabulary: dict, text_column: str = "text", ids_column: str = "token_ids"
) -> DataFrame:
    """Adds the token ids (array of int) of every whole text."""
    documents = set_aside(documents, ids_column)
    shared = broadcast_value(documents.sparkSession, {"vocabulary": vocabulary})

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(shared)
        for batch in batches:
            packed: list[bytes] = []
            for part in _in_parts(batch):
                packed += codec.encode([text or "" for text in part.to_pylist()])
            yield _id_lists(packed)
        _done(shared)

    encoder = F.arrow_udf(encode, "array<int>", F.ArrowUDFType.SCALAR_ITER)
    return documents.withColumn(ids_column, encoder(F.col(text_column)))


def with_decoded_text(
    frame: DataFrame, vocabulary: dict, ids_column: str = "token_ids", text_column: str = "decoded"
) -> DataFrame:
    """Adds the text that token ids stand for; NULL ids give NULL."""
    frame = set_aside(frame, text_column)
    shared = broadcast_value(frame.sparkSession, {"vocabulary": vocabulary})

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(shared)
        for batch in batches:
            texts: list[str | None] = []
            for part in _in_parts(batch):
                flat = part.flatten().to_numpy(zero_copy_only=False).tolist()
                sizes = pc.list_value_length(part).to_pylist()
                texts += codec.decode_all(flat, sizes)
            yield pa.array(texts, pa.string())

    decoder = F.arrow_udf(decode, "string", F.ArrowUDFType.SCALAR_ITER)
    return frame.withColumn(text_column, decoder(F.col(ids_column)))
