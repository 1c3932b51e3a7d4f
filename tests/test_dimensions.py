from __future__ import annotations

from datetime import date

import pytest
from conftest import as_list, as_set
from pyspark.errors import PySparkException

from gaugeworks.functions import first_date, lowered, titled, trimmed
from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.dimensions import clean_dimension, quality_counts
from gaugeworks.settings import dimension


def test_text_functions(spark):
    df = spark.createDataFrame(
        [("JFK International",), ("Tokyo ",), ("AeroForge Inc.",), ("a-b c_d",), (None,)],
        "t string",
    )
    assert [r[0] for r in df.select(titled("t")).collect()] == [
        "Jfk International", "Tokyo", "Aeroforge Inc.", "A-b C_d", None,
    ]
    assert [r[0] for r in df.select(lowered("t")).collect()][1] == "tokyo"
    assert [r[0] for r in df.select(trimmed("t")).collect()][1] == "Tokyo"


def test_first_date_takes_the_first_format_that_reads(spark):
    df = spark.createDataFrame([("2016-03-04",), ("03/04/2016",), ("junk",), (None,)], "d string")
    got = [r[0] for r in df.select(first_date("d", ("yyyy-MM-dd", "MM/dd/yyyy"))).collect()]
    assert got == [date(2016, 3, 4), date(2016, 3, 4), None, None]


def test_locations(spark):
    raw = spark.createDataFrame(
        [
            ("L1", "haneda", "Tokyo ", "Temperate/Humid", "asia"),
            ("L2", "Heathrow", "LONDON", None, "Europe"),
            ("L3", "x", "y", "", "z"),
            (None, "nowhere", "nowhere", None, "none"),
        ],
        "location_id string, airport string, city string, climate string, region string",
    )
    assert as_set(clean_dimension(raw, dimension("dim_locations"))) == {
        ("L1", "Haneda", "Tokyo", "temperate/humid", "Asia"),
        ("L2", "Heathrow", "London", "unknown", "Europe"),
        ("L3", "X", "Y", "", "Z"),
    }


def test_keys_are_compared_untrimmed_where_the_spec_says_nothing(spark):
    raw = spark.createDataFrame(
        [("N1 ", "delta", " Active", 5), ("N1", "delta", "Active", 5)],
        "tail_number string, airline_owner string, fleet_status string, total_flight_hours bigint",
    )
    cleaned = clean_dimension(raw, dimension("dim_aircraft"))
    assert as_set(cleaned, "tail_number") == {("N1 ",), ("N1",)}
    assert dict(cleaned.dtypes)["total_flight_hours"] == "int"


def test_engines_move_the_date_to_the_end(spark):
    raw = spark.createDataFrame(
        [(1.0, "N1", "junk", " Sigma-4 "), (1.0, "N1", "junk", " Sigma-4 "), (None, "N", "", "")],
        "engine_id double, tail_number string, manufacture_date string, model string",
    ).selectExpr("*", "'Osprey LONG Range' AS aircraft_type_supported")
    cleaned = clean_dimension(raw, dimension("dim_engines"))
    assert cleaned.columns[-1] == "manufacture_date"
    assert as_list(cleaned) == [(1, "N1", "Sigma-4", "Osprey Long Range", None)]


def test_parts_refuse_bad_dates(spark):
    shape = (
        "part_id string, engine_id bigint, component_name string, supplier_name string, "
        "last_replaced_date string"
    )
    good = spark.createDataFrame([("P", 1, "fuel pump", "AeroForge Inc.", "2024-01-02")], shape)
    cleaned = clean_dimension(good, dimension("dim_parts_bom"))
    assert as_list(cleaned) == [("P", 1, "Fuel Pump", "Aeroforge Inc.", date(2024, 1, 2))]
    bad = spark.createDataFrame([("P", 1, "c", "s", "02.01.2024")], shape)
    with pytest.raises(PySparkException):
        clean_dimension(bad, dimension("dim_parts_bom")).collect()


def test_thresholds_normalise_the_key_before_deduplication(spark):
    raw = spark.createDataFrame(
        [(" S ", 2.0, "b"), ("s", 1.0, "a"), (None, 0.0, "n")],
        "sensor_name string, critical_limit double, alert_description string",
    )
    assert as_list(clean_dimension(raw, dimension("dim_thresholds"))) == [("s", 1.0, "A")]


def test_first_per_key_keeps_the_smallest_row_whatever_the_order(spark):
    rows = [("k", 2, "b"), ("k", None, "z"), ("k", 1, "a"), ("j", 5, None), (None, 1, "n")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, a int, b string").repartition(3)
        assert as_set(first_per_key(df, ["k"])) == {
            ("k", None, "z"), ("j", 5, None), (None, 1, "n"),
        }
    keys_only = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert as_list(first_per_key(keys_only, ["k"])) == [(1,), (2,)]


def test_quality_counts(spark):
    raw = spark.range(5)
    counts = quality_counts(raw, raw.where("id > 1"), "d")
    assert as_list(counts) == [("d", 5, 2)]
    assert as_list(quality_counts(raw.where("false"), raw.where("false"), "e")) == [("e", 0, 0)]
