"""Data that drives the operators: column names, rules, cleaning specs, table names."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. Results depend on these names, texts and limits.
# ---------------------------------------------------------------------------

# Clean column name, payload column, type.
SENSOR_COLUMNS = (
    ("engine_id", "engine_id", "int"),
    ("cycle", "cycle", "int"),
    ("altitude_ft", "setting1", "double"),
    ("mach_number", "setting2", "double"),
    ("throttle_angle", "setting3", "double"),
    ("temp_fan_inlet", "s1", "double"),
    ("temp_lpc_out", "s2", "double"),
    ("temp_hpc_out", "s3", "double"),
    ("temp_lpt_out", "s4", "double"),
    ("press_fan_inlet", "s5", "double"),
    ("press_bypass", "s6", "double"),
    ("press_hpc_out", "s7", "double"),
    ("physical_fan_speed", "s8", "double"),
    ("physical_core_speed", "s9", "double"),
    ("engine_pressure_ratio", "s10", "double"),
)

ALERT_SENSORS = (
    "temp_hpc_out",
    "temp_lpt_out",
    "press_hpc_out",
    "physical_core_speed",
    "engine_pressure_ratio",
)

VALID_REASON = "Valid"
RESCUED_COLUMN = "_rescued_data"
CORRUPT_COLUMN = "_corrupt_record"

# Storage names a downstream user reads by.
SCHEMAS = ("bronze", "silver", "gold")
BRONZE_TELEMETRY = "brz_fact_telemetry"
SILVER_TELEMETRY = "slv_fact_telemetry"
SILVER_QUARANTINE = "slv_quarantine_telemetry"
GOLD_WIDE = "gld_obt_telemetry"
GOLD_SUMMARY = "gld_fleet_daily_summary"
GOLD_ALERTS = "gld_critical_alerts"


@dataclass(frozen=True)
class Rule:
    """A row that satisfies ``predicate`` (SQL text) is bad for ``reason``."""

    predicate: str
    reason: str


QUARANTINE_RULES = (
    Rule("engine_id IS NULL", "CRITICAL: Missing Engine ID"),
    Rule("temp_hpc_out < -50", "ERROR: Impossible negative temperature"),
    Rule("physical_core_speed < 0", "ERROR: Negative RPM detected"),
)


@dataclass(frozen=True)
class DimensionSpec:
    """How one reference snapshot is cleaned before it becomes a dimension."""

    name: str
    key: str
    defaults: dict = field(default_factory=dict)
    title: tuple = ()
    lower: tuple = ()
    trim: tuple = ()
    casts: dict = field(default_factory=dict)
    # Dates in any of the listed formats; text in none of them becomes NULL.
    lenient_dates: dict = field(default_factory=dict)
    # Dates in one format; other text is an error.
    strict_dates: dict = field(default_factory=dict)


DIMENSIONS = (
    DimensionSpec(
        "dim_locations",
        key="location_id",
        defaults={"climate": "unknown"},
        title=("city", "airport", "region"),
        lower=("climate",),
    ),
    DimensionSpec(
        "dim_aircraft",
        key="tail_number",
        title=("airline_owner",),
        lower=("fleet_status",),
        casts={"total_flight_hours": "int"},
    ),
    DimensionSpec(
        "dim_engines",
        key="engine_id",
        title=("aircraft_type_supported",),
        trim=("model",),
        casts={"engine_id": "int"},
        lenient_dates={"manufacture_date": ("yyyy-MM-dd", "MM/dd/yyyy")},
    ),
    DimensionSpec(
        "dim_parts_bom",
        key="part_id",
        title=("component_name", "supplier_name"),
        casts={"engine_id": "int"},
        strict_dates={"last_replaced_date": "yyyy-MM-dd"},
    ),
    DimensionSpec(
        "dim_thresholds",
        key="sensor_name",
        title=("alert_description",),
        lower=("sensor_name",),
        casts={"critical_limit": "double"},
    ),
)

# ---------------------------------------------------------------------------
# End of fixed values. Below: our own defaults, free to change.
# ---------------------------------------------------------------------------

PAYLOAD_COLUMNS = tuple(source for _, source, _ in SENSOR_COLUMNS)
CLEAN_COLUMNS = tuple(name for name, _, _ in SENSOR_COLUMNS)
PAYLOAD_SCHEMA = ", ".join(f"{name} double" for name in PAYLOAD_COLUMNS)

# Names of columns that ingestion adds; message keys of these names are rescued.
PATH_COLUMN = "source_file_path"
INGESTED_COLUMN = "ingestion_timestamp"

# Identifies the micro-batch that wrote a row; the partition column of batch-written tables.
BATCH_COLUMN = "_batch_id"
RESERVED_COLUMNS = (RESCUED_COLUMN, CORRUPT_COLUMN, PATH_COLUMN, INGESTED_COLUMN, BATCH_COLUMN)

# A dimension is broadcast only when its measured size is at most this.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# A key with more rows is spread over several tasks when a join has to be salted.
JOIN_TASK_ROWS = 5_000_000
# Size of a data file after compaction or clustering.
TARGET_FILE_BYTES = 256 * 1024 * 1024
# Batches of a table after which they are folded into runs.
FOLD_AFTER = 100
# Upper size of one micro-batch, so that a long backlog is drained in bounded steps.
MAX_BATCH_BYTES = 512 * 1024 * 1024 * 1024


def dimension(name: str) -> DimensionSpec:
    for spec in DIMENSIONS:
        if spec.name == name:
            return spec
    raise KeyError(name)
