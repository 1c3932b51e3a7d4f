"""The runs a user starts: dimensions, telemetry, gold tables, and both in order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeworks.operators.columns import stamp
from gaugeworks.operators.dimensions import clean_dimension
from gaugeworks.operators.wide import build_wide_clustered, fleet_daily_summary
from gaugeworks.plans.gold import FACT_PLACE, refresh_gold
from gaugeworks.settings import (
    BRONZE_TELEMETRY,
    DIMENSIONS,
    FOLD_AFTER,
    GOLD_ALERTS,
    GOLD_SUMMARY,
    GOLD_WIDE,
    MAX_BATCH_BYTES,
    PAYLOAD_SCHEMA,
    SILVER_QUARANTINE,
    SILVER_TELEMETRY,
    TARGET_FILE_BYTES,
    DimensionSpec,
)
from gaugeworks.sinks.folds import fold_batches, list_batches
from gaugeworks.sinks.layout import compact, files_for_all
from gaugeworks.sinks.tables import (
    Namespace,
    create_tenant_view,
    read_batches,
    read_if_present,
)
from gaugeworks.sinks.versions import overwrite
from gaugeworks.sources.files import read_snapshot, stream_lines
from gaugeworks.sources.schema_store import SchemaStore
from gaugeworks.streaming.flows import ingest_stream, run_alerts, run_silver, widening


@dataclass(frozen=True)
class TableStatus:
    dimension: str
    status: str
    rows_read: int | None = None
    rows_dropped: int | None = None
    message: str | None = None


class RunFailed(RuntimeError):
    """At least one table of a run could not be written."""


def status_frame(spark: SparkSession, statuses: Sequence[TableStatus]) -> DataFrame:
    schema = (
        "dimension string, status string, rows_read long, rows_dropped long, message string"
    )
    return spark.createDataFrame([astuple(status) for status in statuses], schema)


def require_written(statuses: Sequence[TableStatus]) -> None:
    failed = [f"{s.dimension}: {s.message}" for s in statuses if s.status == "failed"]
    if failed:
        raise RunFailed("; ".join(failed))


def _each(items: Sequence, work: Callable[..., TableStatus]) -> list[TableStatus]:
    """``work`` on all items at once: small independent jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        return list(pool.map(work, items))


def ingest_dimensions(
    spark: SparkSession,
    source: str,
    namespace: Namespace,
    names: Sequence[str] = tuple(spec.name for spec in DIMENSIONS),
    fmt: str = "json",
) -> list[TableStatus]:
    """Replace each bronze dimension by its current snapshot in ``source``/<name>.

    A snapshot that cannot be read is skipped, a table that cannot be written is reported;
    the others go on.
    """

    def ingest(name: str) -> TableStatus:
        try:
            snapshot = read_snapshot(spark, f"{source}/{name}", fmt)
        except AnalysisException as error:
            return TableStatus(name, "skipped", message=error.getCondition())
        try:
            overwrite(stamp(snapshot, "ingestion_timestamp"), namespace.bronze(f"brz_{name}"))
        except PySparkException as error:
            return TableStatus(name, "failed", message=str(error))
        return TableStatus(name, "written")

    return _each(names, ingest)


def clean_dimensions(
    spark: SparkSession,
    namespace: Namespace,
    specs: Sequence[DimensionSpec] = DIMENSIONS,
) -> list[TableStatus]:
    """Clean each bronze dimension into silver, compact it, and count what was dropped.

    Both counts are taken from stored tables, where they need no column.
    """

    def clean(spec: DimensionSpec) -> TableStatus:
        raw = read_if_present(spark, namespace.bronze(f"brz_{spec.name}"))
        if raw is None:
            return TableStatus(spec.name, "skipped", message="bronze table missing")
        target = namespace.silver(f"slv_{spec.name}")
        try:
            cleaned = clean_dimension(raw, spec)
            overwrite(stamp(cleaned, "silver_processing_timestamp"), target)
            compact(spark, target)
            read, kept = raw.count(), spark.table(target).count()
        except PySparkException as error:
            return TableStatus(spec.name, "failed", message=str(error))
        return TableStatus(spec.name, "written", read, read - kept)

    return _each(specs, clean)


def build_gold_wide(
    spark: SparkSession, namespace: Namespace, target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """Rebuild the wide table, clustered by date and engine."""
    facts = namespace.silver(SILVER_TELEMETRY)
    files = files_for_all(spark, facts, target_bytes)
    dims = [namespace.silver(f"slv_dim_{name}") for name in ("engines", "aircraft", "locations")]
    wide = build_wide_clustered(read_batches(spark, facts), *map(spark.table, dims), files=files)
    target = namespace.gold(GOLD_WIDE)
    overwrite(stamp(wide, "gold_obt_updated_at"), target)
    return spark.table(target)


def build_gold_summary(spark: SparkSession, namespace: Namespace) -> DataFrame:
    """Rebuild the daily summary from the stored wide table."""
    target = namespace.gold(GOLD_SUMMARY)
    overwrite(fleet_daily_summary(spark.table(namespace.gold(GOLD_WIDE))), target)
    return spark.table(target)


def sync_dimensions(
    spark: SparkSession, source: str, namespace: Namespace, fmt: str = "json"
) -> DataFrame:
    """Snapshots to bronze to silver; returns what happened to each dimension."""
    require_written(ingest_dimensions(spark, source, namespace, fmt=fmt))
    statuses = clean_dimensions(spark, namespace)
    require_written(statuses)
    return status_frame(spark, statuses)


def _fold(
    spark: SparkSession, table: str, place: str, taken: Sequence[str], fold_after: int
) -> None:
    if len(taken) >= fold_after:
        fold_batches(spark, table, place, taken)


def process_telemetry(
    spark: SparkSession,
    source: str,
    namespace: Namespace,
    state: str,
    telemetry_time: Column | None = None,
    extra_schema: str | None = None,
    sampling_ratio: float = 1.0,
    max_bytes: int = MAX_BATCH_BYTES,
    rebuild_gold: bool = True,
    gold_period: str | None = None,
    fold_after: int = FOLD_AFTER,
    tenants: Mapping[str, str] | None = None,
    **silver_options,
) -> None:
    """New telemetry files to bronze, silver, alerts and gold tables, in that order.

    ``state`` is the folder of checkpoints and the schema store. A stage that fails raises and
    the ones after it do not run. With ``gold_period`` ("day", "month", …) the gold tables are kept
    by period and follow new facts and changed dimensions (see ``plans.gold``); without it they
    are rebuilt in full, and ``rebuild_gold=False`` leaves that to a rarer run. The batch-written
    tables are folded once they have ``fold_after`` batches that the stages after them have taken.
    ``tenants`` names views by the airline owner whose rows of the summary they show.
    """
    ddl = f"{PAYLOAD_SCHEMA}, {extra_schema}" if extra_schema else PAYLOAD_SCHEMA
    store = SchemaStore(spark, f"{state}/schema")
    bronze = namespace.bronze(BRONZE_TELEMETRY)
    schema = store.evolve(
        source, T.StructType.fromDDL(ddl), sampling_ratio, widening(spark, bronze)
    )
    silver = namespace.silver(SILVER_TELEMETRY)
    lines = stream_lines(spark, source, max_bytes=max_bytes)
    ingest_stream(lines, bronze, f"{state}/{BRONZE_TELEMETRY}", schema)
    run_silver(
        spark,
        bronze,
        silver,
        namespace.silver(SILVER_QUARANTINE),
        f"{state}/{SILVER_TELEMETRY}",
        telemetry_time=telemetry_time,
        max_bytes=max_bytes,
        **silver_options,
    )
    taken = list_batches(spark, silver)
    run_alerts(
        spark,
        silver,
        namespace.silver("slv_dim_thresholds"),
        namespace.gold(GOLD_ALERTS),
        f"{state}/{GOLD_ALERTS}",
        max_bytes=max_bytes,
    )
    if gold_period:
        refresh_gold(spark, namespace, gold_period)
    elif rebuild_gold:
        build_gold_wide(spark, namespace)
        build_gold_summary(spark, namespace)
    _fold(spark, silver, FACT_PLACE, taken, fold_after)
    for table, time in (
        (namespace.silver(SILVER_QUARANTINE), "telemetry_timestamp"),
        (namespace.gold(GOLD_ALERTS), "event_time"),
    ):
        _fold(spark, table, f"to_date({time})", list_batches(spark, table), fold_after)
    if gold_period or rebuild_gold:
        for view, owner in (tenants or {}).items():
            summary = namespace.gold(GOLD_SUMMARY)
            create_tenant_view(spark, namespace.gold(view), summary, "airline_owner", owner)
