"""Substring deduplication by content-defined chunking.

A gear rolling hash runs over a text's bytes; a cut falls where the hash is the smallest of its
neighbourhood, moved on to the next word. So cuts depend on nearby content only: after an insertion,
and in another document, the same passage is cut at the same places. Pairs of neighbouring chunks
are compared by digest over the whole corpus, and chunks of ``min_run`` bytes by themselves. What an
earlier document (smaller id) has, or what stands earlier in the same text, is repeated; runs of
repeated neighbours that are long enough are cut out, so the first holder of a passage keeps it.

A chunk alone can be alike by chance, and chunks of different documents side by side are no passage: a
run needs every two of its neighbours next to each other in an earlier place. Of a repeated passage at
most about one neighbourhood and one chunk stay at either end.

Edge cases: NULL stays NULL, empty text empty; text without cuts (one byte repeated) is cut every
``LONGEST`` bytes; very long texts are chunked whole; documents without an id follow those that have
one, ordered by a hash of their text; rows with the same id are parts of one document: what they share
stays; repeated rows give repeated results; an empty table gives an empty one. Other columns are kept,
one named like a new one as ``<name>_in``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import OWN, mixed, release, set_aside, text_key, written

# A cut is the smallest hash among so many bytes on either side; chunks are longer than that.
AROUND = 16
# Bytes that the rolling hash sees (a power of two).
WINDOW = 16
# Chunks without a cut for so long are cut anyway.
LONGEST = 512
# Repeated runs of fewer bytes stay.
MIN_RUN = 96
# Stand-ins of missing ids begin here.
_NAMELESS = 1 << 62
# How far a cut may move to start at a word.
_TO_WORD = 32

# Texts are chunked together in blocks of about so many bytes.
BLOCK = 1 << 18

_PAIR = np.uint64(0x9E3779B97F4A7C15)
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)
_GEAR[0] = 0  # the filling between texts adds nothing to a hash
_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
_FILLING = bytes(max(AROUND, WINDOW))
_HIGHEST = np.uint32(0xFFFFFFFF)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash of the last ``WINDOW`` bytes at every place, by doubling the window."""
    rolled, width = _GEAR[data], 1
    while width < WINDOW:
        shifted = np.zeros_like(rolled)
        shifted[width:] = rolled[:-width] << np.uint32(width)
        rolled = rolled + shifted
        width *= 2
    return rolled


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    low, have = values, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def chunk_block(texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For every text the ends of its chunks (bytes, the text's own end last) and their digests.

    The texts lie in one buffer with filling between them, which no hash and no neighbourhood
    reaches across, so a text's chunks do not depend on its company.
    """
    if not texts:
        return [], []
    buffer = _FILLING + b"".join(text + _FILLING for text in texts)
    sizes = np.array([len(text) for text in texts], np.int64)
    begins = np.cumsum([len(_FILLING), *(sizes[:-1] + len(_FILLING))])
    stops = begins + sizes
    data = np.frombuffer(buffer, np.uint8)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, begins, 1)
    np.add.at(inside, stops, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    hashes = np.where(inside, gear_hashes(data), _HIGHEST)
    edge = np.full(AROUND, _HIGHEST)
    low = _smallest(np.concatenate([edge, hashes, edge]), AROUND)
    left, right = low[: len(data)], low[AROUND + 1 : AROUND + 1 + len(data)]
    cuts = np.flatnonzero((hashes < left) & (hashes <= right)) + 1
    owner = np.searchsorted(begins, cuts, "right") - 1
    words = np.flatnonzero(_SPACE[data]) + 1
    words = np.append(words, len(data))
    target = np.minimum(words[np.searchsorted(words, cuts)], stops[owner])
    cuts = np.where(target - cuts <= _TO_WORD, target, cuts)
    for _ in range(3):  # never inside a character of UTF-8
        cuts = cuts + ((data[np.minimum(cuts, len(data) - 1)] & 0xC0) == 0x80)
    full = sizes > 0
    cuts = np.unique(np.concatenate([np.minimum(cuts, stops[owner]), stops[full]]))
    owner = np.searchsorted(begins[full], cuts - 1, "right") - 1
    owner = np.flatnonzero(full)[owner] if full.any() else owner
    starts = np.concatenate([[0], cuts[:-1]])
    starts = np.where(np.diff(owner, prepend=-1) != 0, begins[owner], starts)
    extra = []
    for k in np.flatnonzero(cuts - starts > LONGEST).tolist():
        stop = int(starts[k]) + LONGEST
        while stop < cuts[k]:
            while data[stop] & 0xC0 == 0x80:
                stop -= 1
            extra.append((stop, owner[k]))
            stop += LONGEST
    if extra:
        cuts = np.append(cuts, [stop for stop, _ in extra])
        owner = np.append(owner, [text for _, text in extra])
        order = np.argsort(cuts, kind="stable")
        cuts, owner = cuts[order], owner[order]
        starts = np.concatenate([[0], cuts[:-1]])
        starts = np.where(np.diff(owner, prepend=-1) != 0, begins[owner], starts)
    digest = xxhash.xxh3_64_intdigest
    digests = np.fromiter(
        (digest(buffer[a:b]) for a, b in zip(starts.tolist(), cuts.tolist(), strict=True)),
        np.uint64,
        len(cuts),
    ).view(np.int64)
    splits = np.searchsorted(owner, np.arange(1, len(texts)))
    return np.split(cuts - begins[owner], splits), np.split(digests, splits)


def _blocks(texts: Iterator[str | None]) -> Iterator[list[bytes]]:
    block: list[bytes] = []
    size = 0
    for text in texts:
        block.append((text or "").encode())
        size += len(block[-1])
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def link_digests(ends: np.ndarray, digests: np.ndarray, min_run: int) -> tuple[np.ndarray, np.ndarray]:
    """What is compared of a chunked text: a digest per pair of neighbours, and one per long chunk.

    Gives the digests and the first chunk of each: k for the pair (k, k + 1), ~k for the chunk k.
    """
    values = digests.view(np.uint64)
    pairs = mixed(values[:-1] * _PAIR + values[1:])
    long = np.flatnonzero(np.diff(ends, prepend=0) >= min_run)
    found = np.concatenate([pairs, mixed(values[long] ^ _PAIR)]).view(np.int64)
    return found, np.concatenate([np.arange(len(pairs)), ~long])


def _digests(min_run: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [
                link_digests(ends, digests, min_run)[0]
                for block in _blocks(text.as_py() for text in batch)
                for ends, digests in zip(*chunk_block(block), strict=True)
            ]
            sizes = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([*found, np.empty(0, np.int64)])
            yield pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))
        release()

    return run


def cut_repeats(
    ends: np.ndarray, digests: np.ndarray, elsewhere: set[int], min_run: int
) -> tuple[list[tuple[int, int]], int, int]:
    """Spans to remove (bytes) from a chunked text, the chunks in them, and the repeated chunks of
    runs that are too short."""
    links, places = link_digests(ends, digests, min_run)
    seen: set[int] = set()
    joined = np.zeros(len(ends), bool)  # with the next chunk
    alone = np.zeros(len(ends), bool)
    for link, place in zip(links.tolist(), places.tolist(), strict=True):
        if link in elsewhere or link in seen:
            if place >= 0:
                joined[place] = True
            else:
                alone[~place] = True
        seen.add(link)
    spans: list[tuple[int, int]] = []
    starts = [0, *ends[:-1].tolist()]
    cut = short = first = 0
    for k in range(len(ends)):
        if joined[k]:
            continue
        # The run of the chunks from ``first`` to k, or a single chunk.
        if first < k or alone[k]:
            begin, end = starts[first], int(ends[k])
            if end - begin >= min_run:
                cut += k + 1 - first
                if spans and spans[-1][1] == begin:
                    begin = spans.pop()[0]
                spans.append((begin, end))
            else:
                short += k + 1 - first
        first = k + 1
    return spans, cut, short


def _cut(min_run: int):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, digests in batches:
            kept, spans, chunks, repeated, alike = [], [], [], [], []
            rows = iter(zip(texts, digests, strict=True))
            for block in _blocks(text.as_py() for text in texts):
                for data, ends, found in zip(block, *chunk_block(block), strict=True):
                    text, elsewhere = next(rows)
                    known = set(elsewhere.as_py()) if elsewhere.is_valid else set()
                    gone, again, few = cut_repeats(ends, found, known, min_run)
                    place, parts = 0, []
                    for begin, end in gone:
                        parts.append(data[place:begin])
                        place = end
                    parts.append(data[place:])
                    kept.append(b"".join(parts).decode() if text.is_valid else None)
                    spans.append([{"start": a, "end": b} for a, b in gone])
                    chunks.append(len(ends))
                    repeated.append(again)
                    alike.append(few)
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.StructArray.from_arrays(
                [
                    pa.array(kept, pa.string()),
                    pa.array(spans, pa.list_(span)),
                    pa.array(chunks, pa.int64()),
                    pa.array(repeated, pa.int64()),
                    pa.array(alike, pa.int64()),
                ],
                ["text", "spans", "chunks", "repeated", "alike"],
            )
        release()

    return run


def deduplicate_chunks(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_run: int = MIN_RUN,
    spans_column: str = "removed_spans",
    chunks_column: str = "n_chunks",
    repeated_column: str = "n_repeated",
    alike_column: str = "n_alike",
    holders_column: str = "repeat_of",
) -> DataFrame:
    """Every document with its repeated runs cut out of the text.

    Adds the removed spans (bytes of the old text), the chunks, those of them that were removed, those
    repeated in runs that are too short, and the ids of the documents that have them first.
    """
    added = (spans_column, chunks_column, repeated_column, alike_column, holders_column)
    documents = set_aside(documents, *added)
    # A document without an id comes after all others; a hash of its text stands for it.
    nameless = F.shiftrightunsigned(text_key(text_column), 2) + F.lit(_NAMELESS)
    key = F.coalesce(F.col(id_column).cast("long"), nameless)
    digests = F.arrow_udf(_digests(min_run), "array<long>", F.ArrowUDFType.SCALAR_ITER)
    chunks = written(
        documents.select(key.alias("owner"), F.col(text_column).alias("text"))
        .select("owner", digests("text").alias("digests")),
        "chunk-digests",
    ).select("owner", F.explode("digests").alias("digest"))
    first = written(
        chunks.groupBy("digest")
        .agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
        .filter("first <> last")
        .select("digest", "first"),
        "chunk-first",
    )
    repeats = written(
        chunks.join(first.hint("merge"), "digest")
        .filter("first < owner")
        .groupBy("owner")
        .agg(
            F.collect_set("digest").alias(f"{OWN}digests"),
            F.collect_set("first").alias(f"{OWN}holders"),
        ),
        "chunk-repeats",
    ).withColumnRenamed("owner", f"{OWN}key")
    cut = F.arrow_udf(
        _cut(min_run),
        "text string, spans array<struct<start:long,end:long>>, chunks long, repeated long, "
        "alike long",
        F.ArrowUDFType.SCALAR_ITER,
    )
    return (
        documents.withColumn(f"{OWN}key", key)
        .join(repeats, f"{OWN}key", "left")
        .withColumn(f"{OWN}cut", cut(F.col(text_column), F.col(f"{OWN}digests")))
        .withColumns(
            {
                text_column: F.col(f"{OWN}cut")["text"],
                spans_column: F.col(f"{OWN}cut")["spans"],
                chunks_column: F.col(f"{OWN}cut")["chunks"],
                repeated_column: F.col(f"{OWN}cut")["repeated"],
                alike_column: F.col(f"{OWN}cut")["alike"],
                holders_column: F.coalesce(
                    F.filter(f"{OWN}holders", lambda holder: holder < _NAMELESS),
                    F.array().cast("array<long>"),
                ),
            }
        )
        .drop(f"{OWN}key", f"{OWN}digests", f"{OWN}holders", f"{OWN}cut")
    )
