"""Threshold alerts, for batch frames and micro-batches alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.columns import unpivot_sensors
from gaugeworks.operators.joins import join_reference
from gaugeworks.settings import ALERT_SENSORS, MAX_BROADCAST_BYTES

ALERT_COLUMNS = (
    "engine_id",
    "cycle",
    "event_time",
    "sensor_name",
    "sensor_value",
    "critical_limit",
    "alert_description",
)


def threshold_alerts(
    telemetry: DataFrame,
    limits: DataFrame,
    sensors: Sequence[str] = ALERT_SENSORS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Readings above the limit of their sensor, one row per reading and limit.

    A value equal to the limit, a NULL value and a sensor without a limit give no row. When
    ``limits`` has a ``direction`` column, "below" turns the comparison of that limit around.
    """
    ids = ["engine_id", "cycle", F.col("telemetry_timestamp").alias("event_time")]
    readings = unpivot_sensors(telemetry, ids, sensors)
    columns = ["sensor_name", "critical_limit", "alert_description"]
    breach = F.col("sensor_value") > F.col("critical_limit")
    if "direction" in limits.columns:
        columns.append("direction")
        below = F.coalesce(F.col("direction") == "below", F.lit(False))
        breach = F.when(below, F.col("sensor_value") < F.col("critical_limit")).otherwise(breach)
    # Limits of other sensors cannot match; dropping them bounds what is broadcast.
    usable = limits.select(*columns).where(F.col("sensor_name").isin(*sensors))
    joined = join_reference(readings, usable, ["sensor_name"], "inner", max_broadcast_bytes)
    return joined.where(breach).select(*ALERT_COLUMNS)


def alert_latency(
    alerts: DataFrame,
    raised: str = "alert_generated_at",
    happened: str = "event_time",
    target_seconds: int = 300,
    exact: bool = False,
) -> DataFrame:
    """Per sensor: alerts, share raised within the target, and the spread of the delay.

    The percentiles are within a ten-thousandth of the exact rank; ``exact`` makes them exact, at the
    price of a map of all distinct delays of a sensor in one task, so for delays of few values.
    """
    percentile = F.percentile if exact else F.percentile_approx
    delay = F.unix_micros(F.col(raised).cast("timestamp")) - F.unix_micros(
        F.col(happened).cast("timestamp")
    )
    timed = alerts.select("sensor_name", (delay / 1e6).alias("delay"))
    return timed.groupBy("sensor_name").agg(
        F.count("*").alias("alerts"),
        F.count_if(F.col("delay") <= target_seconds).alias("within_target"),
        F.avg("delay").alias("mean_seconds"),
        F.max("delay").alias("max_seconds"),
        percentile("delay", F.lit(0.5)).alias("p50_seconds"),
        percentile("delay", F.lit(0.95)).alias("p95_seconds"),
    )
