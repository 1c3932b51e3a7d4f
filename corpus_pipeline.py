"""A corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, documents, sf_dir) and returns a DataFrame; between stages the rows are
written as Parquet and read again, so a stage starts from stored data only. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.bpe import read_vocabulary, with_round_trip
from gaugeworks.llm.chunk_dedup import deduplicate_chunks
from gaugeworks.llm.common import OWN, small, text_key, written
from gaugeworks.llm.decontaminate import contamination
from gaugeworks.llm.jaccard import jaccard_components
from gaugeworks.llm.quality_rules import keep_good, learn_rules, with_statistics
from gaugeworks.llm.queries import VOCABULARY

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learnt decision list keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    named = written(
        labels.filter("doc_id is not null and quality is not null").select("doc_id").distinct(),
        "pipeline-labelled",
    )
    labelled = docs.select("doc_id", "text").join(small(named, named.count()), "doc_id", "left_semi")
    statistics = written(with_statistics(labelled).drop("text"), "pipeline-statistics")
    rules = learn_rules(statistics, labels)
    return keep_good(docs.select(*COLUMNS), rules)


def _same() -> Column:
    """Whether a document has the id and text key of a row of names (see ``_names``)."""
    return F.col("doc_id").cast("long").eqNullSafe(F.col(f"{OWN}id")) & (
        text_key() == F.col(f"{OWN}key")
    )


def _names(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias(f"{OWN}id"), F.col("tkey").alias(f"{OWN}key"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose id and text key are not in ``gone``."""
    gone = written(gone.distinct(), "pipeline-gone")
    return docs.join(small(gone, gone.count()), _same(), "left_anti").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of similar texts, and all rows without shingles.

    The row with the smallest id stays (NULL last), of one id that with the smallest text key, and of
    rows equal in both a single one, the smallest by the other columns.
    """
    groups = jaccard_components(docs, with_key=True)
    keys = written(
        groups.filter("n_shingles > 0")
        .groupBy("group", "doc_id", "tkey")
        .agg(F.count("*").alias("copies")),
        "pipeline-groups",
    )
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "tkey", "copies")
    kept = written(
        keys.groupBy("group").agg(F.min(first).alias("own")).select("group", "own.*"),
        "pipeline-kept",
    )
    others = keys.alias("k").join(
        kept.alias("o"),
        (F.col("k.group") == F.col("o.group"))
        & (F.col("k.tkey") == F.col("o.tkey"))
        & F.col("k.doc_id").eqNullSafe(F.col("o.doc_id")),
        "left_anti",
    )
    repeated = written(_names(kept.filter("copies > 1")), "pipeline-repeated")
    alone = _without(docs, _names(others).union(repeated))
    order = ("doc_id", *(name for name in COLUMNS if name not in ("doc_id", "text")), "text")
    single = (
        docs.join(small(repeated, repeated.count()), _same(), "left_semi")
        .groupBy("doc_id", text_key().alias("tkey"))
        .agg(F.min(F.struct(*order)).alias("row"))
    )
    return alone.union(single.select(*(f"row.{name}" for name in COLUMNS)))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; texts that were nothing else go."""
    cut = deduplicate_chunks(docs)
    empty = (F.size("removed_spans") > 0) & ~F.col("text").rlike(r"[^\x09-\x0D\x20]")
    return (
        cut.filter(~F.coalesce(empty, F.lit(False)))
        .withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
        .select(*COLUMNS)
    )


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    hits = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, _names(hits.filter(F.size("hit_words") > 0)))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text's token ids and what they decode to."""
    return with_round_trip(docs.select(*COLUMNS), read_vocabulary(VOCABULARY)).select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]

# The learnt rules, the rolling hash and the token ids are not SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
