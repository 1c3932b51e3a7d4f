"""The corpus operators over the whole test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.bpe import read_vocabulary, with_round_trip
from gaugeworks.llm.chunk_dedup import deduplicate_chunks
from gaugeworks.llm.common import OWN, written
from gaugeworks.llm.decontaminate import contamination
from gaugeworks.llm.fill_in_middle import store_frames, with_digests, with_plan
from gaugeworks.llm.hilbert_shards import assign_shards, with_rank
from gaugeworks.llm.jaccard import jaccard_components, jaccard_join
from gaugeworks.llm.language import learn_languages, with_language
from gaugeworks.llm.oracle import oracle_sql
from gaugeworks.llm.perspectives import rotate_perspectives
from gaugeworks.llm.quality_rules import (
    COUNTS,
    base_failed,
    kept,
    learn_rules,
    rule_number,
    with_statistics,
)
from gaugeworks.llm.secret_scan import BASE_RULES, with_secrets
from gaugeworks.llm.spelling import spelling_variants, word_counts
from gaugeworks.llm.token_counts import byte_vocabulary, with_token_counts
from gaugeworks.llm.url_rules import ALLOW, BLOCK, judge_urls

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 24

# The rules of the URL query.
URL_RULES = [
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_counts(documents, byte_vocabulary(vocabulary)).drop("text")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    statistics = written(with_statistics(documents).drop("text"), "quality-statistics")
    rules = learn_rules(statistics, _table(spark, sf_dir, "labels"))
    return statistics.select(
        "doc_id",
        *COUNTS,
        base_failed().alias("base_failed"),
        kept(rules).alias("kept"),
        rule_number(rules).alias("rule"),
    )


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).drop("url")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicate_chunks(documents)


def bpe_round_trip(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_round_trip(documents, read_vocabulary(vocabulary)).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = rotate_perspectives(_table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return rendered.withColumn("mask", F.array_join(spans, ","))


def hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        "lang",
        "source",
    )
    for name in ("lang", "source"):
        rows = with_rank(rows, name, f"{OWN}{name}")
    dimensions = {name: F.col(name) for name in (f"{OWN}lang", f"{OWN}source", "size")}
    placed = assign_shards(rows, dimensions, SHARDS, tie=["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # An id is text in the checksum; a missing one counts as empty text.
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    split = documents.withColumn("held_out", F.pmod(F.crc32(name), F.lit(4)) == 2)
    filters = learn_languages(split.filter(~F.col("held_out")))
    return with_language(split.drop("lang"), filters).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its class of equal sets and the number of its links."""
    _, members = jaccard_join(_table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "class_id", "n_links")


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_secrets(documents).drop("text")
    base = [rule.kind for rule in BASE_RULES]

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of(*kinds: str) -> Column:
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(joined(of(*base)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(_table(spark, sf_dir, "documents"), spoil_every=97))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = written(store_frames(documents), "middle-frames")
    return with_digests(with_plan(stored)).select(
        "doc_id",
        F.col("stored")["n_units"].alias("n"),
        "form",
        F.col("from_char").alias("prefix_chars"),
        (F.col("to_char") - F.col("from_char")).alias("middle_chars"),
        "output_sha256",
        "restored_sha256",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": token_counts,
        "op2_quality_rules": quality_rules,
        "op3_url_filters": url_filters,
        "op4_substring_dedup": substring_dedup,
        "op5_bpe_round_trip": bpe_round_trip,
        "op6_chat_perspectives": chat_perspectives,
        "op7_hilbert_shards": hilbert_shards,
        "op8_benchmark_decontamination": benchmark_decontamination,
        "op9_language_id": language_id,
        "op10_ngram_jaccard": ngram_jaccard,
        "op11_secret_scans": secret_scans,
        "op12_spelling_variants": spelling_groups,
        "op13_fill_in_middle": fill_in_middle,
    }


def more_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Further results of the operators, checked like the first ten."""
    return {"op10_ngram_jaccard_join": ngram_jaccard_join}


__all__ = ["more_queries", "oracle_sql", "queries"]
