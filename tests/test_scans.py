"""What stored tables are asked for: columns and filters that reach the scan."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest

from gaugeworks.operators.alerts import threshold_alerts
from gaugeworks.operators.rules import evaluate_rules, route_counts
from gaugeworks.operators.wide import fleet_daily_summary
from gaugeworks.settings import CLEAN_COLUMNS
from gaugeworks.sinks.tables import create_tenant_view
from gaugeworks.sinks.versions import overwrite


def scan(df) -> tuple[set[str], str]:
    """Columns read and filters pushed by the only table scan of ``df``."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(lines) == 1
    schema = re.search(r"ReadSchema: struct<(.*?)>", lines[0]).group(1)
    pushed = re.search(r"PushedFilters: \[(.*?)\]", lines[0]).group(1)
    return {part.split(":")[0] for part in schema.split(",") if part}, pushed


@pytest.fixture
def facts(spark, names):
    row = (1, 1, *[1.0] * 13, datetime(2024, 1, 1), date(2024, 1, 1), "Delta", "Asia")
    kinds = ["int", "int", *["double"] * 13]
    shape = ", ".join(f"{n} {k}" for n, k in zip(CLEAN_COLUMNS, kinds, strict=True))
    shape += ", telemetry_timestamp timestamp, telemetry_date date"
    shape += ", airline_owner string, region string"
    table = names.gold("facts")
    overwrite(spark.createDataFrame([row], shape), table)
    return table


def test_summary_reads_six_columns_and_pushes_its_filter(spark, facts):
    columns, pushed = scan(fleet_daily_summary(spark.table(facts)))
    assert columns == {
        "engine_id", "telemetry_date", "airline_owner", "region", "temp_hpc_out",
        "physical_core_speed",
    }
    assert "IsNotNull(airline_owner)" in pushed and "IsNotNull(region)" in pushed


def test_tenant_view_pushes_the_tenant(spark, names, facts):
    view = create_tenant_view(spark, names.gold("v"), facts, "airline_owner", "Delta")
    columns, pushed = scan(view.select("region"))
    assert columns == {"airline_owner", "region"}
    assert "EqualTo(airline_owner,Delta)" in pushed


def test_alerts_read_eight_columns(spark, facts):
    limits = spark.range(1).selectExpr(
        "'temp_hpc_out' AS sensor_name", "0D AS critical_limit", "'Hot' AS alert_description"
    )
    columns, _ = scan(threshold_alerts(spark.table(facts), limits))
    assert columns == {
        "engine_id", "cycle", "telemetry_timestamp", "temp_hpc_out", "temp_lpt_out",
        "press_hpc_out", "physical_core_speed", "engine_pressure_ratio",
    }


def test_counting_a_batch_reads_the_columns_of_the_rules_only(spark, facts):
    columns, _ = scan(route_counts(evaluate_rules(spark.table(facts))))
    assert columns == {"engine_id", "temp_hpc_out", "physical_core_speed"}
