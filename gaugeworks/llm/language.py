"""Language identification with bit-sliced Bloom filters of character n-grams.

All languages share one Bloom filter whose slots hold a bitmask of languages instead of one bit, so a
look-up (the AND of an n-gram's slots) returns every language that has the n-gram. A text's hits are
counted per language (popcounts over its n-grams), corrected for the false positives each
language's filter is expected to give, and the largest share decides.

Learning counts n-grams by language in Spark; a language gets an n-gram if the n-gram is frequent there
compared with the language that has it most. The texts counted are bounded (``sample`` per language,
chosen by a hash of the text), and so is the filter.

Edge cases: NULL or letterless text is ``und`` with score 0; without anything to learn from
everything is ``und``; a text with a letter always has one of the learnt languages; rows without a
language are not learnt from, repeated ones once; ties go to the language that sorts first; very long
texts are read whole; an empty table gives an empty one. All rows and columns are kept, a column of the
input named like a new one as ``<name>_in``. More than 64 languages take several mask words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import broadcast_value, set_aside

UNKNOWN = "und"
# Texts per language that are learnt from, n-grams kept per language, slots of the filter.
SAMPLE = 3000
GRAMS = 1 << 15
SLOTS = 1 << 20
# A language gets an n-gram if its share there is at least this part of the largest share.
RELATIVE = 0.5
PROBES = 2

_LETTER = regex.compile(r"\p{L}")
_BLANK = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def gram_codes(text: str) -> np.ndarray:
    """The 4-byte n-grams of a text in lower case, in which all but letters are blanks.

    Two blanks on either side give a text of a single letter n-grams of its own.
    """
    words = text.lower().encode().translate(_BLANK).split()
    if not words:
        return np.empty(0, np.uint32)
    codes = np.frombuffer(b"  " + b" ".join(words) + b"  ", np.uint8).astype(np.uint32)
    return codes[:-3] | codes[1:-2] << 8 | codes[2:-1] << 16 | codes[3:] << 24


def _slots(codes: np.ndarray, size: int) -> list[np.ndarray]:
    shift = np.uint64(64 - (size.bit_length() - 1))
    wide = codes.astype(np.uint64) + np.uint64(1)
    return [(wide * odd) >> shift for odd in _ODD[:PROBES]]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            by_lang.setdefault(lang.as_py(), []).append(gram_codes(text.as_py()))
        for lang, parts in by_lang.items():
            codes, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(codes), pa.string()),
                    pa.array(codes.astype(np.int64)),
                    pa.array(counts.astype(np.int64)),
                ],
                names=["lang", "gram", "often"],
            )


def learn_languages(
    labelled: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    sample: int = SAMPLE,
    grams: int = GRAMS,
    slots: int = SLOTS,
) -> dict:
    """A filter learnt from labelled texts: languages, mask table, false-positive rates."""
    rows = labelled.select(
        F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    ).filter("text is not null and lang is not null")
    # Distinct texts, about, as copies are learnt from once; one row per language.
    distinct = rows.groupBy("lang").agg(F.approx_count_distinct("text").alias("texts")).collect()
    totals = {row.lang: max(1, row.texts) for row in distinct}
    share = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, sample / n)])
    dice = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    counted = (
        rows.filter(dice < share[F.col("lang")])
        .dropDuplicates(["lang", "text"])  # copies have one hash, so they come all or none
        .mapInArrow(_count_grams, "lang string, gram long, often long")
        .groupBy("lang", "gram")
        .agg(F.sum("often").alias("often"))
        if totals
        else rows.select("lang", F.lit(0).cast("long").alias("gram"), F.lit(0).alias("often")).limit(0)
    )
    in_lang, of_gram = Window.partitionBy("lang"), Window.partitionBy("gram")
    chosen = (
        counted.withColumn("share", F.col("often") / F.sum("often").over(in_lang))
        .withColumn("most", F.max("share").over(of_gram))
        .filter((F.col("share") >= RELATIVE * F.col("most")) & (F.col("often") > 1))
        .withColumn("place", F.row_number().over(in_lang.orderBy(F.desc("share"), "gram")))
        .filter(F.col("place") <= grams)
        .select("lang", "gram")
        .toPandas()  # at most ``grams`` rows per language
    )
    languages = sorted(totals)
    masks = np.zeros((max(1, (len(languages) + 63) // 64), slots), np.uint64)
    for number, lang in enumerate(languages):
        codes = chosen.loc[chosen["lang"] == lang, "gram"].to_numpy(np.int64).astype(np.uint32)
        for place in _slots(codes, slots):
            masks[number // 64, place] |= np.uint64(1) << np.uint64(number % 64)
    fill = [
        np.mean(masks[k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(languages))
    ]
    return {"languages": languages, "masks": masks, "wrong": np.array(fill) ** PROBES}


def score_text(text: str | None, filters: dict) -> tuple[str, float]:
    """The language of a text, and the corrected share of its n-grams that this language has."""
    languages = filters["languages"]
    if text is None or not languages or not _LETTER.search(text):
        return UNKNOWN, 0.0
    codes = gram_codes(text)
    if not len(codes):
        return UNKNOWN, 0.0
    masks = filters["masks"]
    places = _slots(codes, masks.shape[1])
    hits = np.empty(len(languages))
    for word, table in enumerate(masks):
        found = table[places[0]]
        for place in places[1:]:
            found = found & table[place]
        for k in range(64 * word, min(len(languages), 64 * word + 64)):
            hits[k] = np.count_nonzero(found & (np.uint64(1) << np.uint64(k % 64)))
    wrong = filters["wrong"]
    right = np.clip((hits / len(codes) - wrong) / np.maximum(1 - wrong, 1e-9), 0.0, 1.0)
    best = int(np.argmax(right))
    return languages[best], float(right[best])


def with_language(
    documents: DataFrame,
    filters: dict,
    text_column: str = "text",
    lang_column: str = "lang_pred",
    score_column: str = "score",
) -> DataFrame:
    """Adds the predicted language of every whole text and its score (0 to 1)."""
    documents = set_aside(documents, lang_column, score_column)
    shared = broadcast_value(documents.sparkSession, filters)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [score_text(text.as_py(), shared.value) for text in batch]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["lang", "score"],
            )

    predictor = F.arrow_udf(predict, "lang string, score double", F.ArrowUDFType.SCALAR_ITER)
    own = "__gw_language"
    return (
        documents.withColumn(own, predictor(F.col(text_column)))
        .withColumns({lang_column: F.col(own)["lang"], score_column: F.col(own)["score"]})
        .drop(own)
    )
