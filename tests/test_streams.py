from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import as_list, as_set
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.alerts import threshold_alerts
from gaugeworks.plans.medallion import (
    RunFailed,
    TableStatus,
    build_gold_summary,
    build_gold_wide,
    clean_dimensions,
    ingest_dimensions,
    process_telemetry,
    require_written,
    sync_dimensions,
)
from gaugeworks.settings import (
    BRONZE_TELEMETRY,
    GOLD_ALERTS,
    GOLD_SUMMARY,
    GOLD_WIDE,
    PAYLOAD_COLUMNS,
    SILVER_QUARANTINE,
    SILVER_TELEMETRY,
)
from gaugeworks.sinks.archive import read_archive
from gaugeworks.sinks.tables import read_batches
from gaugeworks.sinks.versions import overwrite
from gaugeworks.sources.files import stream_archive, stream_lines
from gaugeworks.sources.schema_store import SchemaStore, merge_schemas
from gaugeworks.streaming.flows import (
    archive_stream,
    ingest_stream,
    routing,
    run_alerts,
    run_silver,
)

PAYLOAD = T.StructType([T.StructField(name, T.DoubleType()) for name in PAYLOAD_COLUMNS])


def reading(engine, cycle, s3=1400.0, s9=8900.0, **extra):
    values = {name: 1.0 for name in PAYLOAD_COLUMNS}
    return {**values, "engine_id": engine, "cycle": cycle, "s3": s3, "s9": s9, **extra}


def land(folder: Path, name: str, *readings):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in readings)
    (folder / name).write_text(text + "\n")


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    land(
        folder / "engine_1.0",
        "cycle_1.0.json",
        reading(1.0, 1.0),
        reading(None, 2.0),
        reading(2.0, 3.0, s3=-60.0),
    )
    land(
        folder / "engine_2.0",
        "cycle_4.0.json",
        reading(2.0, 4.0, s9=None),
        reading(3.0, 5.0, s9=-1.0),
    )
    return folder


def ingest(spark, landing, names, tmp_path, schema=PAYLOAD):
    table = names.bronze(BRONZE_TELEMETRY)
    lines = stream_lines(spark, str(landing), max_files=1)
    ingest_stream(lines, table, str(tmp_path / "state/bronze"), schema)
    return table


def silver(spark, names, tmp_path, **options):
    targets = names.silver(SILVER_TELEMETRY), names.silver(SILVER_QUARANTINE)
    run_silver(
        spark, names.bronze(BRONZE_TELEMETRY), *targets, str(tmp_path / "state/silver"), **options
    )
    return targets


def test_ingest_takes_each_file_once_and_keeps_its_path(spark, landing, names, tmp_path):
    table = ingest(spark, landing, names, tmp_path)
    ingest(spark, landing, names, tmp_path)
    assert spark.table(table).count() == 5
    assert spark.table(table).where("ingestion_timestamp IS NULL").count() == 0
    paths = {Path(p).name for (p,) in as_set(spark.table(table), "source_file_path")}
    assert paths == {"cycle_1.0.json", "cycle_4.0.json"}
    land(landing, "later.json", reading(9.0, 9.0))
    ingest(spark, landing, names, tmp_path)
    assert spark.table(table).count() == 6


def test_silver_routes_rows_and_counts_the_undecided(spark, landing, names, tmp_path):
    ingest(spark, landing, names, tmp_path)
    seen = []
    valid, quarantine = silver(
        spark, names, tmp_path, on_counts=lambda batch, counts: seen.append(counts)
    )
    assert as_set(spark.table(valid), "engine_id", "cycle") == {(1, 1)}
    assert as_set(spark.table(quarantine), "cycle", "quarantine_reason") == {
        (2, "CRITICAL: Missing Engine ID"),
        (3, "ERROR: Impossible negative temperature"),
        (5, "ERROR: Negative RPM detected"),
    }
    totals = {key: sum(c[key] for c in seen) for key in seen[0]}
    assert totals == {"valid": 1, "quarantined": 3, "unknown": 1}
    silver(spark, names, tmp_path)
    assert spark.table(valid).count() == 1 and spark.table(quarantine).count() == 3


@pytest.mark.parametrize("cache", [False, True])
def test_replaying_a_batch_adds_nothing(spark, names, cache):
    rows = spark.createDataFrame(
        [(1, 1.0, 1.0), (None, 1.0, 1.0), (2, None, 1.0)],
        "engine_id int, temp_hpc_out double, physical_core_speed double",
    )
    valid, quarantine = names.silver("v"), names.silver("q")
    route = routing(valid, quarantine, cache=cache)
    for batch_id in (0, 1, 1, 0):
        route(rows, batch_id)
    assert spark.table(valid).count() == 2 and spark.table(quarantine).count() == 2
    route(rows.where("engine_id IS NULL"), 1)
    assert spark.table(valid).count() == 1 and spark.table(quarantine).count() == 2


def test_a_batch_that_failed_after_writing_is_replayed_without_duplicates(
    spark, landing, names, tmp_path
):
    ingest(spark, landing, names, tmp_path)

    def fail(batch, counts):
        raise RuntimeError("lost the driver here")

    with pytest.raises(StreamingQueryException, match="lost the driver"):
        silver(spark, names, tmp_path, on_counts=fail)
    valid, quarantine = silver(spark, names, tmp_path)
    assert spark.table(valid).count() == 1 and spark.table(quarantine).count() == 3


def test_a_fresh_checkpoint_does_not_overwrite_earlier_batches(spark, landing, names, tmp_path):
    ingest(spark, landing, names, tmp_path)
    valid, _ = silver(spark, names, tmp_path)
    silver(spark, names, tmp_path / "again")
    assert spark.table(valid).count() == 2


def test_empty_branches_write_no_table(spark, names):
    rows = spark.createDataFrame(
        [(1, 1.0, 1.0)], "engine_id int, temp_hpc_out double, physical_core_speed double"
    )
    routing(names.silver("v"), names.silver("q"))(rows, 0)
    assert spark.catalog.tableExists(names.silver("v"))
    assert not spark.catalog.tableExists(names.silver("q"))


def test_unreadable_values_stop_the_stream_or_are_quarantined(spark, names, tmp_path):
    folder = tmp_path / "landing"
    land(folder, "a.json", reading(1.0, 1.0), reading(3e9, 2.0))
    ingest(spark, folder, names, tmp_path)
    with pytest.raises(StreamingQueryException, match="CAST_OVERFLOW"):
        silver(spark, names, tmp_path)
    valid, quarantine = silver(spark, names, tmp_path, on_bad_cast="quarantine")
    assert as_set(spark.table(valid), "cycle") == {(1,)}
    assert as_set(spark.table(quarantine), "cycle") == {(2,)}
    with pytest.raises(ValueError, match="on_bad_cast"):
        silver(spark, names, tmp_path, on_bad_cast="ignore")


def test_alert_stream_equals_the_batch_result_and_rereads_limits(spark, landing, names, tmp_path):
    ingest(spark, landing, names, tmp_path)
    valid, _ = silver(spark, names, tmp_path)
    limits = names.silver("slv_dim_thresholds")
    shape = "sensor_name string, critical_limit double, alert_description string"
    overwrite(spark.createDataFrame([("temp_hpc_out", 1399.0, "Hot")], shape), limits)
    alerts, state = names.gold(GOLD_ALERTS), str(tmp_path / "state/alerts")
    run_alerts(spark, valid, limits, alerts, state)
    want = threshold_alerts(read_batches(spark, valid), spark.table(limits))
    assert as_list(read_batches(spark, alerts).drop("alert_generated_at")) == as_list(want)
    assert spark.table(alerts).count() == 1
    overwrite(spark.createDataFrame([("press_hpc_out", 0.5, "Pressed")], shape), limits)
    land(landing, "later.json", reading(9.0, 9.0))
    ingest(spark, landing, names, tmp_path)
    silver(spark, names, tmp_path)
    run_alerts(spark, valid, limits, alerts, state)
    assert as_set(spark.table(alerts), "engine_id", "alert_description") == {
        (1, "Hot"),
        (9, "Pressed"),
    }


def test_schema_store_grows_by_new_keys_only(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "a.json", {"x": 1.5, "t": "a"}, "not json")
    store = SchemaStore(spark, str(tmp_path / "store"))
    assert store.load() is None
    first = store.evolve(str(folder), T.StructType.fromDDL("k double"))
    assert first.simpleString() == "struct<k:double,t:string,x:double>"
    assert store.load() == first
    land(folder, "b.json", {"x": "now text", "y": 2, "empty": None})
    second = store.evolve(str(folder))
    # What was a number has text now; both are read as text.
    assert second.simpleString() == "struct<k:double,t:string,x:string,y:bigint>"
    assert SchemaStore(spark, str(tmp_path / "store")).load() == second
    assert store.evolve(str(folder)) == second


def test_schema_store_without_new_files_keeps_the_schema(spark, tmp_path):
    (tmp_path / "in").mkdir()
    store = SchemaStore(spark, str(tmp_path / "store"))
    base = T.StructType.fromDDL("k double")
    assert store.evolve(str(tmp_path / "in"), base) == base
    assert store.evolve(str(tmp_path / "in")) == base


def test_merge_schemas_lets_known_types_win(spark):
    known, found = T.StructType.fromDDL("a int"), T.StructType.fromDDL("a string, b int")
    assert merge_schemas(known, found).simpleString() == "struct<a:int,b:int>"
    assert merge_schemas(known, None) == known


def test_new_columns_widen_the_bronze_table(spark, landing, names, tmp_path):
    store = SchemaStore(spark, str(tmp_path / "store"))
    table = ingest(spark, landing, names, tmp_path, store.evolve(str(landing), PAYLOAD))
    land(landing, "new.json", reading(5.0, 6.0, s11=7.5))
    # A key that comes before the schema knows it is rescued; later ones get a column.
    ingest(spark, landing, names, tmp_path)
    land(landing, "newer.json", reading(5.0, 7.0, s11=8.5))
    ingest(spark, landing, names, tmp_path, store.evolve(str(landing)))
    got = as_set(spark.table(table).where("cycle >= 6"), "cycle", "s11", "_rescued_data")
    assert got == {(6.0, None, '{"s11":"7.5"}'), (7.0, 8.5, None)}


def test_an_unmapped_column_does_not_reach_the_strict_silver_table(
    spark, landing, names, tmp_path
):
    ingest(spark, landing, names, tmp_path)
    valid, _ = silver(spark, names, tmp_path)
    land(landing, "new.json", reading(5.0, 6.0, s11=7.5))
    wider = T.StructType([*PAYLOAD, T.StructField("s11", T.DoubleType())])
    ingest(spark, landing, names, tmp_path, wider)
    with pytest.raises(StreamingQueryException, match="s11"):
        silver(spark, names, tmp_path)
    assert spark.table(valid).count() == 1


def test_archive_feeds_the_bronze_stream(spark, names, tmp_path):
    folder = tmp_path / "topic"
    rows = [(n % 2, n, json.dumps(reading(float(n % 3), float(n % 5)))) for n in range(30)]
    frame = spark.createDataFrame(rows, "partition int, offset long, value string")
    frame.write.parquet(str(folder))
    topic = spark.readStream.schema(frame.schema).parquet(str(folder))
    archive = names.bronze("raw_messages")
    archive_stream(topic, archive, str(tmp_path / "state/archive"))
    assert read_archive(spark, archive).count() == 15
    table = names.bronze(BRONZE_TELEMETRY)
    ingest_stream(stream_archive(spark, archive), table, str(tmp_path / "state/b"), PAYLOAD)
    assert as_set(spark.table(table), "engine_id", "cycle") == {
        (float(n % 3), float(n % 5)) for n in range(30)
    }


def export(folder: Path):
    land(
        folder / "dim_engines",
        "e.json",
        {"engine_id": 1, "tail_number": "N1", "home_location_id": "L", "model": "m",
         "aircraft_type_supported": "heron 200", "manufacture_date": "03/04/2016"},
    )
    land(
        folder / "dim_aircraft",
        "a.json",
        *[{"tail_number": "N1", "airline_owner": "delta", "fleet_status": "Active",
           "total_flight_hours": 9}] * 2,
    )
    land(
        folder / "dim_locations",
        "l.json",
        {"location_id": "L", "airport": "a", "city": "c", "climate": None, "region": "asia"},
    )
    land(
        folder / "dim_thresholds",
        "t.json",
        {"sensor_name": "TEMP_HPC_OUT", "critical_limit": 1399, "alert_description": "hot"},
    )


def test_a_missing_snapshot_is_skipped_and_the_rest_goes_on(spark, names, tmp_path):
    export(tmp_path / "erp")
    ingested = ingest_dimensions(spark, str(tmp_path / "erp"), names)
    assert {s.dimension: s.status for s in ingested} == {
        "dim_engines": "written", "dim_aircraft": "written", "dim_locations": "written",
        "dim_thresholds": "written", "dim_parts_bom": "skipped",
    }
    cleaned = {s.dimension: s for s in clean_dimensions(spark, names)}
    assert (cleaned["dim_aircraft"].rows_read, cleaned["dim_aircraft"].rows_dropped) == (2, 1)
    assert cleaned["dim_parts_bom"].status == "skipped"


def test_a_snapshot_with_bad_data_fails_alone(spark, names, tmp_path):
    export(tmp_path / "erp")
    land(
        tmp_path / "erp" / "dim_parts_bom",
        "p.json",
        {"part_id": "P", "engine_id": 1, "component_name": "c", "supplier_name": "s",
         "last_replaced_date": "02.01.2024"},
    )
    require_written(ingest_dimensions(spark, str(tmp_path / "erp"), names))
    cleaned = {s.dimension: s.status for s in clean_dimensions(spark, names)}
    assert cleaned.pop("dim_parts_bom") == "failed"
    assert set(cleaned.values()) == {"written"}


def test_failed_tables_stop_the_run():
    with pytest.raises(RunFailed, match="dim_x: broken"):
        require_written(
            [TableStatus("dim_y", "written"), TableStatus("dim_x", "failed", message="broken")]
        )


def test_all_stages_in_order(spark, landing, names, tmp_path):
    export(tmp_path / "erp")
    sync_dimensions(spark, str(tmp_path / "erp"), names)
    for _ in range(2):
        process_telemetry(spark, str(landing), names, str(tmp_path / "state"))
    assert spark.table(names.bronze(BRONZE_TELEMETRY)).count() == 5
    wide = spark.table(names.gold(GOLD_WIDE))
    assert len(wide.columns) == 30
    assert as_list(wide, "engine_id", "airline_owner", "climate") == [(1, "Delta", "unknown")]
    summary = spark.table(names.gold(GOLD_SUMMARY))
    got = as_list(summary, "airline_owner", "region", "total_sensor_pings")
    assert got == [("Delta", "Asia", 1)]
    alerts = spark.table(names.gold(GOLD_ALERTS))
    assert as_list(alerts, "engine_id", "alert_description") == [(1, "Hot")]
    today = spark.sql("SELECT current_date() AS d").first().d
    assert abs((summary.first().telemetry_date - today).days) <= 1


def test_gold_tables_can_be_rebuilt(spark, landing, names, tmp_path):
    export(tmp_path / "erp")
    sync_dimensions(spark, str(tmp_path / "erp"), names)
    process_telemetry(spark, str(landing), names, str(tmp_path / "state"))
    assert build_gold_wide(spark, names).count() == 1
    assert build_gold_summary(spark, names).agg(F.sum("total_sensor_pings")).first()[0] == 1
