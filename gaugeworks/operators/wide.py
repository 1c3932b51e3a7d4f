"""Facts joined with all dimensions into one wide table, and its daily summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.joins import fits_broadcast, join_reference
from gaugeworks.settings import MAX_BROADCAST_BYTES
from gaugeworks.sinks.layout import cluster

CLUSTER_COLUMNS = ("telemetry_date", "engine_id")

_AUDIT = ("source_file_path", "ingestion_timestamp", "silver_processing_timestamp")


def engine_profile(engines: DataFrame, aircraft: DataFrame, locations: DataFrame) -> DataFrame:
    """Each engine with its aircraft and home location.

    All inputs are dimensions, unique by key, so the profile has one row per engine.
    """
    located = locations.drop(*_AUDIT).withColumnRenamed("location_id", "home_location_id")
    return (
        engines.drop(*_AUDIT)
        .join(aircraft.drop(*_AUDIT), "tail_number", "left")
        .join(located, "home_location_id", "left")
    )


def dated_facts(facts: DataFrame) -> DataFrame:
    """Facts without audit columns, with the date of the reading (session time zone)."""
    return facts.drop(*_AUDIT).withColumn("telemetry_date", F.to_date("telemetry_timestamp"))


def build_wide(
    facts: DataFrame,
    engines: DataFrame,
    aircraft: DataFrame,
    locations: DataFrame,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Every fact with the attributes of its engine, aircraft and home location.

    Aircraft and location hang on the engine, so left-joining them to the engines first and
    the result to the facts gives the same rows as three joins on the facts, while the facts
    are joined once. Facts without a match keep NULL attributes.
    """
    profile = engine_profile(engines, aircraft, locations)
    return join_reference(dated_facts(facts), profile, ["engine_id"], "left", max_broadcast_bytes)


def build_wide_clustered(
    facts: DataFrame,
    engines: DataFrame,
    aircraft: DataFrame,
    locations: DataFrame,
    files: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``build_wide`` in clustered order, ready to be written in one pass.

    The narrow facts are clustered and then joined: a broadcast join keeps partitions and
    order. Only when the profile is too large for that are the joined rows clustered.
    """
    profile = engine_profile(engines, aircraft, locations)
    dated = dated_facts(facts)
    if fits_broadcast(profile, max_broadcast_bytes):
        return join_reference(
            cluster(dated, CLUSTER_COLUMNS, files), profile, ["engine_id"], "left", broadcast=True
        )
    joined = join_reference(dated, profile, ["engine_id"], "left", broadcast=False)
    return cluster(joined, CLUSTER_COLUMNS, files)


def exact_mean(column: str, digits: int) -> Column:
    """The mean, rounded, from values at six decimal places.

    Sums of decimals do not depend on the order of the rows, so a rerun of a task or another
    partitioning gives the same figure to the last digit. That holds for values below 10^16 in
    size. With a larger one, NaN or an infinity it is the mean of doubles: NaN for NaN or infinities
    of both signs, else the infinity.
    """
    value = F.col(column)
    exact = value.try_cast("decimal(22,6)")
    mean = F.try_divide(F.try_sum(exact), F.count(exact).cast("decimal(18,0)"))
    plain = F.count(value) > F.count(exact)
    return F.when(plain, F.round(F.avg(value), digits)).otherwise(
        F.round(mean, digits).cast("double")
    )


def known_owners(wide: DataFrame) -> DataFrame:
    """The rows that the summary counts."""
    return wide.where(F.col("airline_owner").isNotNull() & F.col("region").isNotNull())


def fleet_daily_summary(wide: DataFrame) -> DataFrame:
    """Pings, mean compressor temperature and top core speed per day, owner and region."""
    mean_temp = exact_mean("temp_hpc_out", 2)
    top_speed = F.round(F.max("physical_core_speed"), 2)
    return (
        known_owners(wide)
        .groupBy("telemetry_date", "airline_owner", "region")
        .agg(
            F.count("engine_id").alias("total_sensor_pings"),
            mean_temp.alias("avg_high_pressure_compressor_temp"),
            top_speed.alias("max_core_speed_rpm"),
        )
    )
