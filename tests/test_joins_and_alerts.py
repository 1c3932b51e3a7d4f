from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from conftest import as_list, as_set
from pyspark.sql import functions as F

from gaugeworks.operators.alerts import alert_latency, threshold_alerts
from gaugeworks.operators.columns import unpivot_sensors
from gaugeworks.operators.joins import fits_broadcast, join_reference, measured_bytes, salted_join
from gaugeworks.operators.wide import (
    build_wide,
    build_wide_clustered,
    exact_mean,
    fleet_daily_summary,
)
from gaugeworks.settings import ALERT_SENSORS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """A third of the rows under one key, all of them exact copies, and a NULL key."""
    hot = spark.range(3000).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    key = (F.col("id") % 50).cast("int").alias("k")
    cold = spark.range(6000).select(key, F.lit("c").alias("v"))
    none = spark.range(10).select(F.lit(None).cast("int").alias("k"), F.lit("n").alias("v"))
    return hot.unionByName(cold).unionByName(none).repartition(8)


@pytest.fixture
def reference(spark):
    return spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_every_way_of_joining_gives_the_same_rows(skewed, reference, how):
    want = skewed.join(reference, "k", how).groupBy("k", "v", "w").count()
    for joined in (
        join_reference(skewed, reference, ["k"], how),
        join_reference(skewed, reference, ["k"], how, max_broadcast_bytes=0),
        salted_join(skewed, reference, ["k"], how, task_rows=100),
    ):
        assert as_set(joined.groupBy("k", "v", "w").count()) == as_set(want)


def test_the_measured_size_decides_the_broadcast(spark, skewed, reference):
    size = measured_bytes(reference)
    assert 40 * 12 <= size <= 40 * 100
    assert fits_broadcast(reference, size) and not fits_broadcast(reference, size - 1)
    assert "BroadcastHashJoin" in plan(join_reference(skewed, reference, ["k"]))
    joined = join_reference(skewed, reference, ["k"], max_broadcast_bytes=size - 1)
    assert "SortMergeJoin" in plan(joined) and "BroadcastHashJoin" not in plan(joined)
    assert "SortMergeJoin" in plan(salted_join(skewed, reference, ["k"], "left"))
    assert measured_bytes(reference.where("false")) == 0
    texts = spark.createDataFrame([("x" * 1000,), (None,)], "t string")
    assert measured_bytes(texts) >= 1000


def test_without_adaptive_execution_a_large_reference_is_salted(spark, skewed, reference):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_reference(skewed, reference, ["k"], "inner", max_broadcast_bytes=0)
        assert "_salt" in plan(joined)
        assert joined.count() == skewed.join(reference, "k").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_salted_hot_key_reaches_several_partitions(spark, skewed, reference):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(skewed, reference, ["k"], "inner", task_rows=500)
        hot = joined.where("k = 7").select(F.spark_partition_id().alias("p"))
        assert hot.distinct().count() > 1
        # Equal rows of one key in one input partition are spread evenly, others stay together.
        equal = spark.range(9000, numPartitions=1).select(
            F.when(F.col("id") < 3000, 7).otherwise(F.col("id") % 30 + 8).cast("int").alias("k"),
            F.lit("same").alias("v"),
        )
        spread = salted_join(equal, reference, ["k"], "inner", task_rows=500)
        sizes = spread.where("k = 7").groupBy("w", F.spark_partition_id().alias("p")).count()
        found = [r["count"] for r in sizes.collect()]
        assert sum(found) == 3000 and len(found) >= 3 and max(found) <= 2 * 3000 / len(found)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salting_refuses_other_joins(skewed, reference):
    with pytest.raises(ValueError, match="full"):
        salted_join(skewed, reference, ["k"], "full")


@pytest.fixture
def tables(spark):
    facts = spark.createDataFrame(
        [
            (1, 10.0, 5.0, datetime(2024, 1, 1, 1), "p"),
            (1, 20.0, 9.0, datetime(2024, 1, 1, 23), "p"),
            (2, 30.0, 1.0, datetime(2024, 1, 2, 0), "p"),
            (9, 40.0, 1.0, datetime(2024, 1, 2, 0), "p"),
        ],
        "engine_id int, temp_hpc_out double, physical_core_speed double, "
        "telemetry_timestamp timestamp, source_file_path string",
    ).withColumn("ingestion_timestamp", F.current_timestamp())
    engines = spark.createDataFrame(
        [(1, "N1", "L1"), (2, "N2", "L9")],
        "engine_id int, tail_number string, home_location_id string",
    ).withColumn("ingestion_timestamp", F.current_timestamp())
    aircraft = spark.createDataFrame(
        [("N1", "Delta"), ("N2", "United")], "tail_number string, airline_owner string"
    )
    places = spark.createDataFrame([("L1", "Asia")], "location_id string, region string")
    places = places.withColumn("silver_processing_timestamp", F.current_timestamp())
    return facts, engines, aircraft, places


def test_wide_keeps_every_fact_once_and_no_audit_column(tables):
    wide = build_wide(*tables)
    assert set(wide.columns) == {
        "engine_id", "temp_hpc_out", "physical_core_speed", "telemetry_timestamp",
        "telemetry_date", "tail_number", "home_location_id", "airline_owner", "region",
    }
    assert as_set(wide, "engine_id", "temp_hpc_out", "airline_owner", "region") == {
        (1, 10.0, "Delta", "Asia"),
        (1, 20.0, "Delta", "Asia"),
        (2, 30.0, "United", None),
        (9, 40.0, None, None),
    }


def test_clustered_wide_has_the_same_rows(tables):
    want = as_list(build_wide(*tables).select("engine_id", "temp_hpc_out", "region"))
    for limit in (0, 1 << 20):
        wide = build_wide_clustered(*tables, files=2, max_broadcast_bytes=limit)
        assert as_list(wide.select("engine_id", "temp_hpc_out", "region")) == want


def test_summary_leaves_out_unknown_owner_or_region(tables):
    assert as_list(fleet_daily_summary(build_wide(*tables))) == [
        (date(2024, 1, 1), "Delta", "Asia", 2, 15.0, 9.0)
    ]


def test_rounding_is_half_up(spark):
    rows = [(1, 2.675, 1.005, date(2024, 1, 1), "o", "r")]
    shape = (
        "engine_id int, temp_hpc_out double, physical_core_speed double, telemetry_date date, "
        "airline_owner string, region string"
    )
    got = fleet_daily_summary(spark.createDataFrame(rows, shape)).first()
    assert got["avg_high_pressure_compressor_temp"] == 2.68
    assert got["max_core_speed_rpm"] == 1.01


READINGS = (
    "engine_id int, cycle int, telemetry_timestamp timestamp, temp_hpc_out double, "
    "temp_lpt_out double, press_hpc_out double, physical_core_speed double, "
    "engine_pressure_ratio double"
)


@pytest.fixture
def telemetry(spark):
    when = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [
            (1, 1, when, 1500.0, 9999.0, 1.0, 9000.5, None),
            (2, 1, when, 1500.1, 9999.0, 1.0, 9000.0, 1.6),
            (3, 1, when, math.nan, None, None, None, 1.5),
        ],
        READINGS,
    )


@pytest.fixture
def limits(spark):
    return spark.createDataFrame(
        [
            ("temp_hpc_out", 1500.0, "Hot"),
            ("physical_core_speed", 9000.0, "Fast"),
            ("engine_pressure_ratio", 1.5, "Pressure"),
            ("not_a_sensor", 0.0, "None"),
        ],
        "sensor_name string, critical_limit double, alert_description string",
    )


def test_unpivot_keeps_nulls(telemetry):
    long = unpivot_sensors(telemetry, ["engine_id"])
    assert long.count() == 3 * len(ALERT_SENSORS)
    assert long.where("sensor_value IS NULL").count() == 4


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_alerts_are_strictly_above_the_limit(telemetry, limits, broadcast_bytes):
    alerts = threshold_alerts(telemetry, limits, max_broadcast_bytes=broadcast_bytes)
    assert as_set(alerts, "engine_id", "sensor_name", "alert_description") == {
        (1, "physical_core_speed", "Fast"),
        (2, "temp_hpc_out", "Hot"),
        (2, "engine_pressure_ratio", "Pressure"),
        (3, "temp_hpc_out", "Hot"),
    }


def test_a_limit_can_work_downwards(telemetry, limits):
    directed = limits.withColumn(
        "direction", F.when(F.col("sensor_name") == "engine_pressure_ratio", "below")
    ).withColumn("critical_limit", F.col("critical_limit") + 0.05)
    got = as_set(threshold_alerts(telemetry, directed), "engine_id", "sensor_name")
    assert (3, "engine_pressure_ratio") in got
    assert (2, "engine_pressure_ratio") not in got
    assert (1, "physical_core_speed") in got


def test_alert_join_needs_no_shuffle_of_the_readings(telemetry, limits):
    text = plan(threshold_alerts(telemetry, limits))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_alert_latency(spark):
    alerts = spark.createDataFrame(
        [("s", datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 5)),
         ("s", datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 5, 1))],
        "sensor_name string, event_time timestamp, alert_generated_at timestamp",
    )
    row = alert_latency(alerts).first()
    assert (row.alerts, row.within_target) == (2, 1)
    assert (row.mean_seconds, row.max_seconds) == (300.5, 301.0)


@pytest.mark.parametrize(
    "readings, want",
    [
        ([1.0, 2.0, None], 1.5),
        ([0.125, 0.125], 0.13),
        ([1e13, 3e13], 2e13),
        ([9e15, -9e15, 3.0], 1.0),
        ([1e300, 1e300], 1e300),
        ([float("inf"), 1.0], float("inf")),
        ([float("-inf"), float("inf")], float("nan")),
        ([float("nan"), 1.0, 1e300], float("nan")),
        ([None, None], None),
    ],
)
def test_the_mean_takes_every_double(spark, readings, want):
    rows = spark.createDataFrame([(v,) for v in readings], "v double")
    got = rows.agg(exact_mean("v", 2).alias("m")).first().m
    assert got == want or (want != want and got != got)


def test_the_mean_does_not_depend_on_the_order(spark):
    rows = spark.range(2000).select((F.rand(3) * F.pow(F.lit(10.0), F.col("id") % 14)).alias("v"))
    rows = spark.createDataFrame(rows.collect(), "v double")
    means = {
        rows.repartition(n).orderBy(F.rand(n)).agg(exact_mean("v", 4)).first()[0] for n in (1, 3, 8)
    }
    assert len(means) == 1
