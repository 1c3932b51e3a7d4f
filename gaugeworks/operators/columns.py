"""Projections: renaming with types, audit columns, unpivoting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.settings import ALERT_SENSORS, RESCUED_COLUMN, SENSOR_COLUMNS

UNREADABLE = "_unreadable"


def rename_cast(
    df: DataFrame,
    mapping: Sequence[tuple[str, str, str]] = SENSOR_COLUMNS,
    telemetry_time: Column | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Payload codes to domain names and types, in one projection; the codes are dropped.

    ``telemetry_time`` is the reading's time when the source has one, else processing time.
    With ``lenient`` a value that does not fit its type becomes NULL and its code is listed in
    ``_unreadable`` for the quality rules; otherwise Spark's cast decides (ANSI: an error).
    """
    cast = Column.try_cast if lenient else Column.cast
    produced = {name: cast(F.col(source), kind) for name, source, kind in mapping}
    if lenient:
        produced[UNREADABLE] = F.array_compact(
            F.array(
                *[
                    F.when(F.col(source).isNotNull() & produced[name].isNull(), F.lit(source))
                    for name, source, _ in mapping
                ]
            )
        )
    now = F.current_timestamp()
    produced["telemetry_timestamp"] = now if telemetry_time is None else telemetry_time
    produced["silver_processing_timestamp"] = now
    codes = [source for _, source, _ in mapping if source not in produced]
    return df.withColumns(produced).drop(*codes, RESCUED_COLUMN)


def stamp(df: DataFrame, *names: str) -> DataFrame:
    """Add the processing time under each of ``names``."""
    return df.withColumns({name: F.current_timestamp() for name in names})


def unpivot_sensors(
    df: DataFrame,
    ids: Sequence[str | Column],
    sensors: Sequence[str] = ALERT_SENSORS,
) -> DataFrame:
    """One (sensor_name, sensor_value) row per sensor column; NULL values stay."""
    narrow = df.select(*ids, *sensors)
    keep = [name for name in narrow.columns if name not in sensors]
    return narrow.unpivot(keep, list(sensors), "sensor_name", "sensor_value")
