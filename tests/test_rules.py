from __future__ import annotations

import math

import pytest
from conftest import as_set
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeworks.operators.columns import rename_cast
from gaugeworks.operators.rules import (
    UNREADABLE_RULE,
    evaluate_rules,
    route_counts,
    split_by_rules,
)
from gaugeworks.settings import PAYLOAD_COLUMNS, PAYLOAD_SCHEMA, QUARANTINE_RULES, Rule

EDGES = [
    ("normal", 1, 1.0, 5.0),
    ("missing id", None, 1.0, 5.0),
    ("null temp", 2, None, 5.0),
    ("null rpm", 3, 1.0, None),
    ("cold, null rpm", 4, -60.0, None),
    ("all three", None, -60.0, -1.0),
    ("boundary", 5, -50.0, 0.0),
    ("null temp, bad rpm", 6, None, -1.0),
    ("nan temp", 7, math.nan, 1.0),
]
MISSING = "CRITICAL: Missing Engine ID"
COLD = "ERROR: Impossible negative temperature"
NEGATIVE = "ERROR: Negative RPM detected"


@pytest.fixture
def edges(spark):
    return spark.createDataFrame(
        EDGES, "name string, engine_id int, temp_hpc_out double, physical_core_speed double"
    )


def test_split_follows_three_valued_logic(edges):
    split = split_by_rules(edges)
    assert as_set(split.valid, "name") == {("normal",), ("boundary",), ("nan temp",)}
    assert as_set(split.quarantined, "name", "quarantine_reason") == {
        ("missing id", MISSING),
        ("cold, null rpm", COLD),
        ("all three", MISSING),
        ("null temp, bad rpm", NEGATIVE),
    }
    assert as_set(split.unknown, "name", "quarantine_reason") == {
        ("null temp", "Valid"),
        ("null rpm", "Valid"),
    }


def test_only_the_valid_branch_loses_the_routing_columns(edges):
    split = split_by_rules(edges)
    assert split.valid.columns == edges.columns
    assert split.quarantined.columns == [*edges.columns, "is_quarantined", "quarantine_reason"]


@pytest.mark.parametrize(
    ("policy", "valid", "quarantined"), [("drop", 3, 4), ("valid", 5, 4), ("quarantine", 3, 6)]
)
def test_null_policy_places_undecided_rows(edges, policy, valid, quarantined):
    split = split_by_rules(edges, null_policy=policy)
    assert split.valid.count() == valid
    assert split.quarantined.count() == quarantined
    assert split.unknown.count() == 2


def test_unknown_policy_is_refused(edges):
    with pytest.raises(ValueError, match="null_policy"):
        split_by_rules(edges, null_policy="keep")


def test_route_counts_cover_every_row(edges):
    assert route_counts(evaluate_rules(edges)).first().asDict() == {
        "valid": 3,
        "quarantined": 4,
        "unknown": 2,
    }


def test_rules_are_data(edges):
    rules = (Rule("physical_core_speed > 4", "fast"), Rule("engine_id = 7", "seven"))
    assert as_set(split_by_rules(edges, rules).quarantined, "name", "quarantine_reason") == {
        ("normal", "fast"),
        ("missing id", "fast"),
        ("null temp", "fast"),
        ("nan temp", "seven"),
    }


def test_rename_cast_types_and_drops_the_codes(spark):
    raw = spark.createDataFrame([tuple(float(n) for n in range(15))], PAYLOAD_SCHEMA)
    row = rename_cast(raw.withColumn("_rescued_data", F.lit("x"))).first().asDict()
    assert row["engine_id"] == 0 and isinstance(row["engine_id"], int)
    assert row["cycle"] == 1 and row["altitude_ft"] == 2.0 and row["engine_pressure_ratio"] == 14.0
    assert not set(row) & ({"_rescued_data", *PAYLOAD_COLUMNS} - {"engine_id", "cycle"})
    assert row["telemetry_timestamp"] == row["silver_processing_timestamp"]


def test_rename_cast_sees_the_input_columns_only(spark):
    raw = spark.createDataFrame([(1.9, 2.0)], "a double, b double")
    swapped = rename_cast(raw, [("a", "b", "double"), ("b", "a", "int")])
    assert tuple(swapped.select("a", "b").first()) == (2.0, 1)


def test_bad_cast_fails_or_is_quarantined(spark):
    text = "s double, t string, u string"
    raw = spark.createDataFrame([(1.0, "2.5", "x"), (2.0, "1e3", "7")], text)
    mapping = [
        ("engine_id", "s", "int"),
        ("temp_hpc_out", "t", "double"),
        ("physical_core_speed", "u", "double"),
    ]
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        rename_cast(raw, mapping).collect()
    lenient = rename_cast(raw, mapping, lenient=True)
    split = split_by_rules(lenient, (*QUARANTINE_RULES, UNREADABLE_RULE))
    assert as_set(split.valid, "engine_id") == {(2,)}
    assert as_set(split.quarantined, "engine_id", "quarantine_reason") == {
        (1, "ERROR: Unreadable value")
    }
