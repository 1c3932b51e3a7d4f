"""Tables that are replaced as a whole, for readers from one moment to the next.

Every overwrite writes a table of its own with a name nobody else has (a version). The name that readers
know is a view on one version; replacing the view is a single catalog operation, so a reader
resolves the old rows or the new ones, never neither and never some of both. Versions that the view
does not name are removed later, the newest of them last, so that a reader that resolved the view just
before a swap can finish.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.sinks.quoting import quoted_text

# Property of a published view: the version it shows.
_SHOWN = "gaugeworks.version"
_MARK = "__v"

# Versions kept beside the published one, for readers that are still at work.
KEEP = 1


def overwrite(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    keep: int = KEEP,
    **options: str,
) -> None:
    """Replace rows and schema of ``table``; ``df`` may read it.

    A failure at any step leaves readers with the old rows or the new ones. A stream over the table
    would take all rows for new ones, so this is for tables that no stream reads.
    """
    spark = df.sparkSession
    if any(column.isPartition for column in _columns(spark, table)):
        raise ValueError(f"{table} is partitioned; its partitions are replaced batch by batch")
    version = new_version(table)
    writer = df.write.format(fmt).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(version)
    publish(spark, table, version)
    remove_versions(spark, table, keep)


def _columns(spark: SparkSession, table: str) -> list:
    return spark.catalog.listColumns(table) if spark.catalog.tableExists(table) else []


def new_version(table: str) -> str:
    """A name that sorts by time and is taken by nobody."""
    return f"{table}{_MARK}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, table: str, version: str) -> None:
    """Let ``table`` show a version.

    A plain table of the name, as earlier releases wrote it, becomes a version first. Between the two
    steps that takes, once in its life, the name is missing; ``recover`` finishes it.
    """
    if spark.catalog.tableExists(table) and shown_version(spark, table) is None:
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}{_MARK}{0:020d}_{uuid.uuid4().hex[:8]}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({quoted_text(_SHOWN)} = "
        f"{quoted_text(version)}) AS SELECT * FROM {version}"
    )


def shown_version(spark: SparkSession, table: str) -> str | None:
    """The version a published name shows; None for a plain table or none."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {row["key"]: row["value"] for row in rows}.get(_SHOWN)


def stored_name(spark: SparkSession, table: str) -> str:
    """The table that holds the rows: the shown version, or the table itself."""
    return shown_version(spark, table) or table


def versions(spark: SparkSession, table: str) -> list[str]:
    """All whole versions of a table, oldest first; one that was never written to its end is in no catalog."""
    schema, _, name = table.rpartition(".")
    place = f" IN {schema}" if schema else ""
    found = spark.sql(f"SHOW TABLES{place} LIKE {quoted_text(f'{name.lower()}{_MARK}*')}").collect()
    start = f"{name.lower()}{_MARK}"
    dot = f"{schema}." if schema else ""
    return sorted(f"{dot}{row.tableName}" for row in found if row.tableName.startswith(start))


def remove_versions(spark: SparkSession, table: str, keep: int = KEEP) -> list[str]:
    """Drop the versions older than the shown one but for the newest ``keep``; returns them.

    Versions newer than the shown one may be about to be published by another run and stay.
    """
    shown = shown_version(spark, table)
    if shown is None:
        return []
    older = [name for name in versions(spark, table) if name.lower() < shown.lower()]
    gone = older[: len(older) - keep] if keep else older
    for version in gone:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
    return gone


def recover(spark: SparkSession, table: str) -> bool:
    """Publish the newest whole version of a name that is missing; True if there was one."""
    found = versions(spark, table)
    if spark.catalog.tableExists(table) or not found:
        return False
    publish(spark, table, found[-1])
    return True
