"""The three streaming stages. Each drains what is available and then stops."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.functions.messages import parse_json_lines
from gaugeworks.functions.widening import read_widest, stored_as
from gaugeworks.operators.alerts import threshold_alerts
from gaugeworks.operators.columns import rename_cast, stamp
from gaugeworks.operators.rules import (
    UNREADABLE_RULE,
    evaluate_rules,
    route_measures,
    split_evaluated,
)
from gaugeworks.settings import (
    ALERT_SENSORS,
    BATCH_COLUMN,
    MAX_BATCH_BYTES,
    QUARANTINE_RULES,
    SENSOR_COLUMNS,
    Rule,
)
from gaugeworks.sinks.archive import archive_batch
from gaugeworks.sinks.tables import add_missing_columns, drop_batch, write_batch

log = logging.getLogger(__name__)


def drain(writer) -> StreamingQuery:
    """Run a stream over everything available now; raises what made it fail."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_table(
    spark: SparkSession, table: str, max_bytes: int = MAX_BATCH_BYTES
) -> DataFrame:
    """New rows of a table as a stream, without the batch column, columns in their widest type."""
    rows = spark.readStream.option("maxBytesPerTrigger", max_bytes).table(table)
    return read_widest(rows.drop(BATCH_COLUMN))


def ingest_stream(
    lines: DataFrame, table: str, checkpoint: str, schema: T.StructType
) -> StreamingQuery:
    """Append new JSON lines (value, source_file_path) to ``table``, exactly once.

    Adds the rescue column and the ingestion time. A schema with new columns widens the table
    before the first row is written; a column of a wider type than the table has is stored beside
    it, for ``read_widest``.
    """
    spark = lines.sparkSession
    rows = stamp(parse_json_lines(lines, schema), "ingestion_timestamp")
    if spark.catalog.tableExists(table):
        rows = stored_as(rows, spark.table(table).schema)
        add_missing_columns(spark, table, rows.schema)
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
    query.awaitTermination()
    return query


def widening(spark: SparkSession, table: str) -> Callable[[T.StructType], object]:
    """For ``SchemaStore.evolve``: adds new columns to the table, if there is one already."""

    def widen(schema: T.StructType) -> None:
        if spark.catalog.tableExists(table):
            empty = spark.createDataFrame([], schema)
            add_missing_columns(spark, table, stored_as(empty, spark.table(table).schema).schema)

    return widen


def archive_stream(messages: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Archive the messages of a stream, the last one per key and micro-batch."""

    def store(batch: DataFrame, batch_id: int) -> None:
        archive_batch(batch, table, batch_name(batch, batch_id))

    return drain(messages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint))


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch. It holds the query's own id, as numbers restart with a checkpoint."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query_id}-{batch_id}"


def log_counts(name: str, counts: dict[str, int]) -> None:
    log.info("batch %s: %s", name, counts)
    if counts["unknown"]:
        log.warning("batch %s: %d rows match no branch", name, counts["unknown"])


def routing(
    valid_table: str,
    quarantine_table: str,
    rules: Sequence[Rule] = QUARANTINE_RULES,
    null_policy: str = "drop",
    cache: bool = False,
    on_counts: Callable[[str, dict[str, int]], None] = log_counts,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch function that writes valid and quarantined rows to their tables.

    The valid table is strict, the quarantine takes new columns. The write of the valid rows passes
    every row of the batch, so the counts are observed there and cost no scan; a quarantine
    without rows is not written, and a batch without valid rows leaves no partition. A batch is read
    twice at most; set ``cache`` for sources that are costly to read again.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(batch, batch_id)
        evaluated = evaluate_rules(batch, rules)
        if cache:
            evaluated = evaluated.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = Observation(f"route {name}")
            observed = evaluated.observe(seen, *route_measures())
            valid = split_evaluated(observed, null_policy).valid
            if not write_batch(valid, valid_table, name):
                return
            counts = seen.get
            undecided = counts["unknown"]
            if not counts["valid"] and not (undecided and null_policy == "valid"):
                drop_batch(spark, valid_table, name)
            if counts["quarantined"] or (undecided and null_policy == "quarantine"):
                quarantined = split_evaluated(evaluated, null_policy).quarantined
                write_batch(quarantined, quarantine_table, name, True, few_rows=True)
            else:
                drop_batch(spark, quarantine_table, name)
            on_counts(name, counts)
        finally:
            if cache:
                evaluated.unpersist()

    return route


def run_silver(
    spark: SparkSession,
    bronze_table: str,
    valid_table: str,
    quarantine_table: str,
    checkpoint: str,
    mapping: Sequence[tuple[str, str, str]] = SENSOR_COLUMNS,
    rules: Sequence[Rule] = QUARANTINE_RULES,
    null_policy: str = "drop",
    telemetry_time: Column | None = None,
    on_bad_cast: str = "fail",
    max_bytes: int = MAX_BATCH_BYTES,
    cache: bool = False,
    on_counts: Callable[[str, dict[str, int]], None] = log_counts,
) -> StreamingQuery:
    """Rename and type new bronze rows and route them into valid and quarantine tables.

    ``on_bad_cast="quarantine"`` sends rows with an unreadable value to the quarantine, where
    "fail" stops the stream.
    """
    if on_bad_cast not in ("fail", "quarantine"):
        raise ValueError(f"on_bad_cast must be fail or quarantine, not {on_bad_cast!r}")
    lenient = on_bad_cast == "quarantine"
    if lenient:
        rules = (*rules, UNREADABLE_RULE)
    raw = stream_table(spark, bronze_table, max_bytes)
    rows = rename_cast(raw, mapping, telemetry_time, lenient)
    route = routing(valid_table, quarantine_table, rules, null_policy, cache, on_counts)
    return drain(rows.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint))


def alerting(
    limits_table: str, alerts_table: str, sensors: Sequence[str] = ALERT_SENSORS
) -> Callable[[DataFrame, int], None]:
    """Micro-batch function that writes the threshold alerts of a batch.

    The limits are read anew for each batch, so a change counts from the next batch on.
    """

    def alert(batch: DataFrame, batch_id: int) -> None:
        limits = batch.sparkSession.table(limits_table)
        alerts = stamp(threshold_alerts(batch, limits, sensors), "alert_generated_at")
        write_batch(alerts, alerts_table, batch_name(batch, batch_id), True, few_rows=True)

    return alert


def run_alerts(
    spark: SparkSession,
    telemetry_table: str,
    limits_table: str,
    alerts_table: str,
    checkpoint: str,
    sensors: Sequence[str] = ALERT_SENSORS,
    max_bytes: int = MAX_BATCH_BYTES,
) -> StreamingQuery:
    """Raise alerts for new rows of the telemetry table."""
    rows = stream_table(spark, telemetry_table, max_bytes)
    alert = alerting(limits_table, alerts_table, sensors)
    return drain(rows.writeStream.foreachBatch(alert).option("checkpointLocation", checkpoint))
