"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from conftest import SF_DIR

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402
from gaugeworks.plans.oracle import oracle_sql  # noqa: E402
from gaugeworks.plans.queries import queries  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return check_queries.database(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_its_sql(spark, con, name):
    assert check_queries.compare(spark, con, SF_DIR, name) is None


def test_entry_is_the_daily_summary(spark):
    frame = entry.entry(spark)
    assert frame.columns == [
        "telemetry_date",
        "airline_owner",
        "region",
        "total_sensor_pings",
        "avg_high_pressure_compressor_temp",
        "max_core_speed_rpm",
    ]
    assert frame.count() > 0


def test_flagship_scans_few_columns_and_shuffles_the_facts_once(spark):
    text = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    facts = next(line for line in text.splitlines() if "lineitem" in line)
    schema = facts.split("ReadSchema:")[1]
    assert "l_discount" not in schema and "l_returnflag" not in schema
    assert text.count("hashpartitioning(telemetry_date") == 1
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
