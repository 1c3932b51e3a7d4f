"""Benchmark decontamination by winnowing.

Of every few neighbouring k-gram hashes a text keeps the smallest, so two texts that share a span of
``span`` words always share a kept hash. The kept hashes of the corpus are joined with those of
the benchmark; a document and an item that meet are compared word for word, and every
occurrence of an item's window is extended to all its words. Items of fewer words than a span are
one window each; for them every run of their length counts as kept.

Edge cases: NULL and word-less texts have no words and no hit; items without words never occur;
equal items and repeated ids are all reported; repeated rows give repeated results; very long texts are
read whole; an empty table on either side is fine; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import (
    WordHashes,
    broadcast_value,
    gram_hashes,
    mixed,
    release,
    small,
    text_key,
    written,
)

# Lower-cases A-Z; everything in ASCII but digits and letters divides words.
_LETTERS = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or chr(byte).isalnum() else 0x20
    for byte in range(256)
)
# Words of a hashed run: the smaller, the fewer hashes are kept.
GRAM = 4
# K-grams of several items that sort last, the commonest ones.
RANKED = 1 << 18
# Items that one row of the verifying step compares with a document, about.
ITEMS_PER_ROW = 1000


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, lower-cased letters and everything beyond ASCII."""
    return (text or "").encode().translate(_LETTERS).split()


def _windows_min(values: np.ndarray, width: int) -> np.ndarray:
    low, have = values, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    return low


def ordered_hashes(grams: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Hashes that sort by how often a k-gram is in the benchmark, then by the k-gram's hash.

    ``often`` are the sorted hashes of the k-grams of several items, and the number of items on a
    scale of powers of two; all others come first.
    """
    known, steps = often
    grams, step = grams >> np.uint64(8), np.zeros(len(grams), np.uint64)
    if len(known):
        place = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        step = np.where(known[place] == grams, steps[place], step)
    return step << np.uint64(56) | grams


NONE_OFTEN = np.empty(0, np.uint64), np.empty(0, np.uint64)


def kept_hashes(
    words: np.ndarray, span: int, gram: int, often: tuple[np.ndarray, np.ndarray] = NONE_OFTEN
) -> np.ndarray:
    """Distinct winnowed k-gram hashes of a text; two texts with a common run of ``span`` words
    have one in common, as both take the smallest of its k-grams. Phrases of many items sort last,
    so a window keeps them only if it has nothing else."""
    grams = gram_hashes(words, gram)
    width = span - gram + 1
    if len(grams) < width:
        return np.empty(0, np.uint64)
    return np.unique(_windows_min(ordered_hashes(grams, often), width))


def _item_grams(gram: int):
    """The distinct k-gram hashes of every item, without their lowest eight bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [
                np.unique(gram_hashes(hashes.of(words_of(text.as_py())), gram) >> np.uint64(8))
                for text in batch.column("text")
            ]
            flat = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat)], names=["gram"])

    return run


def _often(item_texts: DataFrame, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-grams of several items, the ``RANKED`` commonest of them; any number gives the same hits."""
    counted = (
        item_texts.select("text")
        .mapInArrow(_item_grams(gram), "gram long")
        .groupBy("gram")
        .agg(F.count("*").alias("items"))
        .filter("items > 1")
        .orderBy(F.desc("items"), "gram")
        .limit(RANKED)
        .toPandas()
        .sort_values("gram")
    )
    known = counted["gram"].to_numpy(np.int64).view(np.uint64)
    return known, np.log2(counted["items"].to_numpy(np.float64)).astype(np.uint64)


def _short(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of a short window's length, kept apart from those of whole spans."""
    if not length:
        return np.empty(0, np.uint64)
    return np.unique(mixed(gram_hashes(words, length) + np.uint64(length)))


def _item_hashes(span: int, gram: int, often):
    """Rows (text key, words, kept hashes) of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            counts, found = [], []
            for text in batch.column("text"):
                words = hashes.of(words_of(text.as_py()))
                counts.append(len(words))
                found.append(
                    kept_hashes(words, span, gram, often.value)
                    if len(words) >= span
                    else _short(words, len(words))
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("ikey"), pa.array(counts, pa.int64()), _lists(found)],
                names=["ikey", "n_words", "hashes"],
            )

    return run


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _document_hashes(span: int, gram: int, short: list[int], often):
    """Rows (id, text key, words, kept hashes) of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            counts, found = [], []
            for text in batch.column("text"):
                words = hashes.of(words_of(text.as_py()))
                counts.append(len(words))
                found.append(
                    np.concatenate(
                        [
                            kept_hashes(words, span, gram, often.value),
                            *(_short(words, k) for k in short),
                        ]
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tkey"),
                    pa.array(counts, pa.int64()),
                    _lists(found),
                ],
                names=["doc_id", "tkey", "n_words", "hashes"],
            )
        hashes.clear()
        release()

    return run


def find_hits(words: list[bytes], items: list[list[bytes]], span: int) -> tuple[np.ndarray, list[int]]:
    """The places of the words inside any occurrence of an item's window, and the occurring items."""
    windows: dict[int, dict[tuple, list[int]]] = {}
    for number, item in enumerate(items):
        length = min(span, len(item))
        for k in range(len(item) - length + 1 if length else 0):
            windows.setdefault(length, {}).setdefault(tuple(item[k : k + length]), []).append(number)
    change, real = np.zeros(len(words) + 1, np.int64), set()
    for length, of_length in windows.items():
        heads = {window[0] for window in of_length}
        for k in range(len(words) - length + 1):
            if words[k] in heads and (met := of_length.get(tuple(words[k : k + length]))):
                change[k] += 1
                change[k + length] -= 1
                real.update(met)
    return np.flatnonzero(np.cumsum(change)[:-1] > 0), sorted(real)


def _extended(span: int):
    """For a document and the items met in it: hit words, and the items that really occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, occurring = [], []
            for text, keys, texts in zip(
                batch.column("text"), batch.column("keys"), batch.column("texts"), strict=True
            ):
                names = keys.as_py()
                places, real = find_hits(
                    words_of(text.as_py()), [words_of(item) for item in texts.as_py()], span
                )
                hits.append(places.tolist())
                occurring.append([names[k] for k in real])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tkey"),
                    pa.array(hits, pa.list_(pa.int32())),
                    pa.array(occurring, pa.list_(pa.int64())),
                ],
                names=["doc_id", "tkey", "hit_words", "keys"],
            )

    return run


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    span: int = 10,
    gram: int = GRAM,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, tkey (see ``text_key``), n_words, hit_words (their places),
    items (ids of the items of which a window occurs, as strings)."""
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).withColumn("tkey", text_key())
    items = benchmark.select(
        F.col(item_column).cast("string").alias("item"), F.col(item_text_column).alias("text")
    ).withColumn("ikey", text_key())
    item_texts = items.select("ikey", "text").dropDuplicates(["ikey"])
    often = broadcast_value(documents.sparkSession, _often(item_texts, gram))
    item_rows = written(
        item_texts.mapInArrow(
            _item_hashes(span, gram, often), "ikey long, n_words long, hashes array<long>"
        ),
        "winnow-items",
    )
    lengths = item_rows.filter((F.col("n_words") > 0) & (F.col("n_words") < span))
    short = sorted(row[0] for row in lengths.select("n_words").distinct().collect())  # under span
    kept = written(
        texts.mapInArrow(
            _document_hashes(span, gram, short, often),
            "doc_id long, tkey long, n_words long, hashes array<long>",
        ),
        "winnow-documents",
    )
    item_hashes = item_rows.select("ikey", F.explode("hashes").alias("hash"))
    wanted = written(item_hashes.select("hash").distinct(), "winnow-hashes")
    met = written(
        kept.select("doc_id", "tkey", F.explode("hashes").alias("hash"))
        .join(small(wanted, wanted.count()), "hash")
        .distinct(),
        "winnow-met",
    )
    rows = max(1, item_rows.count() // ITEMS_PER_ROW)
    pairs = met.join(item_hashes, "hash").select("doc_id", "tkey", "ikey").distinct()
    grouped = written(
        pairs.join(item_texts, "ikey")
        .groupBy("doc_id", "tkey", F.pmod("ikey", F.lit(rows)).alias("part"))
        .agg(F.collect_list("ikey").alias("keys"), F.collect_list("text").alias("texts")),
        "winnow-pairs",
    )
    suspects = written(grouped.select("doc_id", "tkey").distinct(), "winnow-suspects")
    suspect_texts = (
        _same_document(texts, small(suspects, suspects.count()), "left_semi")
        .dropDuplicates(["doc_id", "tkey"])
    )
    found = written(
        _same_document(suspect_texts, grouped, "inner").mapInArrow(
            _extended(span), "doc_id long, tkey long, hit_words array<int>, keys array<long>"
        ),
        "winnow-found",
    )
    hits = found.groupBy("doc_id", "tkey").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words")
    )
    occurring = (
        found.select("doc_id", "tkey", F.explode("keys").alias("ikey"))
        .join(items.select("ikey", "item"), "ikey")
        .groupBy("doc_id", "tkey")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    result = written(_same_document(hits, occurring, "inner"), "winnow-result")
    none = F.array().cast("array<string>")
    return _same_document(kept.drop("hashes"), result, "left").select(
        "doc_id",
        "tkey",
        "n_words",
        F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
        F.coalesce("items", none).alias("items"),
    )


def _same_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """A join on id and text key in which NULL ids are equal; the right key columns go."""
    right = right.withColumnsRenamed({"doc_id": "__gw_id", "tkey": "__gw_key"})
    match = F.col("doc_id").eqNullSafe(F.col("__gw_id")) & (F.col("tkey") == F.col("__gw_key"))
    return left.join(right, match, how).drop("__gw_id", "__gw_key")
