"""Facts and large dimensions stored by key, so that their join shuffles neither.

Both sides are written into the same number of buckets of the key, sorted. Keys with more rows than a
task should have would fill one bucket; their facts are stored apart, unbucketed, and meet the
few rows of the dimension that belong to them by a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.joins import fits_broadcast
from gaugeworks.settings import JOIN_TASK_ROWS, MAX_BROADCAST_BYTES
from gaugeworks.sinks.versions import new_version, publish, remove_versions


# Rows of a bucket, about: a task sorts one on writing and one on joining.
BUCKET_ROWS = 1_000_000


def buckets_for(rows: int, least: int = 1) -> int:
    """Buckets for facts of so many rows: their number grows with the rows, their size does not."""
    return max(least, -(-rows // BUCKET_ROWS))


def _bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    version = new_version(table)
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(version)
    )
    publish(df.sparkSession, table, version)
    remove_versions(df.sparkSession, table)


def _plain(df: DataFrame, table: str) -> None:
    version = new_version(table)
    df.write.saveAsTable(version)
    publish(df.sparkSession, table, version)
    remove_versions(df.sparkSession, table)


def hot_table(table: str) -> str:
    return f"{table}__hot"


def store_facts(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, task_rows: int = JOIN_TASK_ROWS
) -> None:
    """Store facts by key; rows of a key with more than ``task_rows`` of them go to the hot table.

    There are at most rows / ``task_rows`` such keys; an aggregate finds them.
    """
    hot = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > task_rows)
        .select(*[F.col(key).alias(f"_hot_{key}") for key in keys])
    )
    hot_keys = new_version(f"{table}__keys")
    hot.write.saveAsTable(hot_keys)
    known = F.broadcast(df.sparkSession.table(hot_keys))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_hot_{key}"))
    _plain(df.join(known, same, "left_semi"), hot_table(table))
    _bucketed(df.join(known, same, "left_anti"), table, keys, buckets)
    df.sparkSession.sql(f"DROP TABLE {hot_keys}")


def store_reference(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Store a dimension, unique by key, in the buckets of the facts."""
    _bucketed(df, table, keys, buckets)


def join_stored(
    spark: SparkSession,
    facts: str,
    reference: str,
    keys: Sequence[str],
    how: str = "left",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Stored facts with their stored dimension: buckets merged in place, hot keys by broadcast.

    The rows of the dimension for the hot keys are at most one each; should they not fit a
    broadcast, they are joined by a shuffle whose skew adaptive execution splits.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot join {how}")
    keys = list(keys)
    dimension = spark.table(reference)
    cold = spark.table(facts).join(dimension.hint("merge"), keys, how)
    hot_facts = spark.table(hot_table(facts))
    wanted = dimension.join(F.broadcast(hot_facts.select(*keys).distinct()), keys, "left_semi")
    small = F.broadcast(wanted) if fits_broadcast(wanted, max_broadcast_bytes) else wanted
    return cold.unionByName(hot_facts.join(small, keys, how))
