"""Archive of raw messages: one message per engine and cycle, the last one sent wins.

Each micro-batch adds its own partition, so the cost of a write does not grow with the archive, and a
stream over the archive sees each file once. Which message of a key is the last is settled per batch on
writing and over all of them on reading. ``fold_archive`` merges batches into levels of runs, dealt
into buckets by engine and sorted by key: superseded messages are shed there, and a look-up of one
engine reads one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.sinks.folds import PLACE_COLUMN, Folds, fold_batches, folds_of, read_whole
from gaugeworks.sinks.tables import write_batch

ENGINE = "engine"
CYCLE = "cycle"
_PLACE = ("partition", "offset")

# Parts of a level of the archive; an engine is in one of them.
BUCKETS = 64


def keyed_messages(messages: DataFrame) -> DataFrame:
    """Messages with the engine and cycle their JSON names, as the text they were sent as."""
    text = F.col("value").cast("string")
    partition = F.col("partition") if "partition" in messages.columns else F.lit(0)
    return messages.select(
        F.get_json_object(text, "$.engine_id").alias(ENGINE),
        F.get_json_object(text, "$.cycle").alias(CYCLE),
        partition.cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        text.alias("value"),
    )


def latest_messages(keyed: DataFrame) -> DataFrame:
    """The last message of each engine and cycle; messages without both ids are all kept.

    The key of a message decides its topic partition, so offsets order the messages of a key.
    """
    has_key = F.col(ENGINE).isNotNull() & F.col(CYCLE).isNotNull()
    own = F.when(~has_key, F.struct(*_PLACE)).alias("_own")
    last = F.max(F.struct("offset", "partition", "value")).alias("_last")
    grouped = keyed.groupBy(ENGINE, CYCLE, own).agg(last)
    return grouped.select(ENGINE, CYCLE, *[F.col("_last")[n].alias(n) for n in (*_PLACE, "value")])


def archive_batch(messages: DataFrame, table: str, batch: str) -> None:
    """Store the last message per key of one batch; the same ``batch`` again replaces it.

    Rows are sorted by engine and cycle inside each file, so that a lookup skips by statistics.
    """
    latest = latest_messages(keyed_messages(messages))
    write_batch(latest.sortWithinPartitions(ENGINE, CYCLE), table, batch)


def fold_archive(
    spark: SparkSession, table: str, batches: Sequence[str] | None = None, buckets: int = BUCKETS
) -> Folds:
    """Merge batches that every stream over the archive has taken into its levels.

    After the first fold the number of buckets stays as it is.
    """
    place = f"pmod(xxhash64({ENGINE}), {buckets})"
    before = folds_of(spark, table)
    return fold_batches(
        spark,
        table,
        before.place if before else place,
        batches,
        shed=latest_messages,
        sort=(ENGINE, CYCLE),
    )


def read_archive(spark: SparkSession, table: str, engine: str | None = None) -> DataFrame:
    """The last message of each key over all batches and levels, of one engine if given."""
    stored = read_whole(spark, table)
    if engine is not None:
        stored = stored.where(F.col(ENGINE) == engine)
        if state := folds_of(spark, table):
            # The place of the engine, as a literal that skips the other buckets.
            place = spark.range(1).select(F.lit(engine).alias(ENGINE)).selectExpr(state.place)
            stored = stored.where(F.col(PLACE_COLUMN) == place.first()[0])
    return latest_messages(stored)


def export_archive(archive: DataFrame, path: str) -> None:
    """Write archived messages as JSON lines in one folder per engine.

    Folders of other engines below ``path`` stay. Rows are rebalanced by engine: adaptive
    execution packs small engines together and splits one that holds a large share.
    """
    (
        archive.select(ENGINE, "value")
        .hint("rebalance", ENGINE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(ENGINE)
        .text(path)
    )
