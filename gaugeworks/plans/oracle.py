"""SQL for the checking database, one text per checked query, written apart from the operators."""

from __future__ import annotations

from gaugeworks.plans.bindings import BINDINGS, plain_sql
from gaugeworks.settings import SENSOR_COLUMNS

_CLEAN = [name for name, _, _ in SENSOR_COLUMNS]
_PAYLOAD = [source for _, source, _ in SENSOR_COLUMNS]
_SENSORS = (
    "temp_hpc_out",
    "temp_lpt_out",
    "press_hpc_out",
    "physical_core_speed",
    "engine_pressure_ratio",
)


def _title(column: str) -> str:
    words = f"string_split(lower(trim({column})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _columns(names) -> str:
    return ", ".join(names)


_WITH: dict[str, str] = {name: plain_sql(sql) for name, sql in BINDINGS.items()}

_WITH["silver"] = (
    "SELECT "
    + _columns(
        f"CAST({source} AS {'INTEGER' if kind == 'int' else 'DOUBLE'}) AS {name}"
        for name, source, kind in SENSOR_COLUMNS
    )
    + ", telemetry_timestamp FROM raw_telemetry"
)

_WITH["judged"] = """
SELECT *, (engine_id IS NULL OR temp_hpc_out < -50 OR physical_core_speed < 0) AS is_quarantined,
       CASE WHEN engine_id IS NULL THEN 'CRITICAL: Missing Engine ID'
            WHEN temp_hpc_out < -50 THEN 'ERROR: Impossible negative temperature'
            WHEN physical_core_speed < 0 THEN 'ERROR: Negative RPM detected'
            ELSE 'Valid' END AS quarantine_reason
FROM silver"""

_WITH["valid"] = (
    f"SELECT {_columns(_CLEAN)}, telemetry_timestamp FROM judged WHERE NOT is_quarantined"
)


def _first_row(cleaned: str, key: str, others: list[str]) -> str:
    order = _columns(f"{name} NULLS FIRST" for name in others)
    return (
        f"SELECT {_columns([key, *others])} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM ({cleaned}) c "
        f"WHERE {key} IS NOT NULL) r WHERE rn = 1"
    )


_WITH["dim_locations"] = _first_row(
    f"""SELECT location_id, {_title('airport')} AS airport, {_title('city')} AS city,
               lower(trim(coalesce(climate, 'unknown'))) AS climate, {_title('region')} AS region
        FROM raw_dim_locations""",
    "location_id",
    ["airport", "city", "climate", "region"],
)
_WITH["dim_aircraft"] = _first_row(
    f"""SELECT tail_number, {_title('airline_owner')} AS airline_owner,
               lower(trim(fleet_status)) AS fleet_status,
               CAST(total_flight_hours AS INTEGER) AS total_flight_hours
        FROM raw_dim_aircraft""",
    "tail_number",
    ["airline_owner", "fleet_status", "total_flight_hours"],
)
_WITH["dim_engines"] = _first_row(
    f"""SELECT CAST(engine_id AS INTEGER) AS engine_id, tail_number, home_location_id,
               trim(model) AS model,
               {_title('aircraft_type_supported')} AS aircraft_type_supported,
               coalesce(CAST(try_strptime(manufacture_date, '%Y-%m-%d') AS DATE),
                        CAST(try_strptime(manufacture_date, '%m/%d/%Y') AS DATE))
                 AS manufacture_date
        FROM raw_dim_engines""",
    "engine_id",
    ["tail_number", "home_location_id", "model", "aircraft_type_supported", "manufacture_date"],
)
_WITH["dim_parts_bom"] = _first_row(
    f"""SELECT part_id, CAST(engine_id AS INTEGER) AS engine_id,
               {_title('component_name')} AS component_name,
               {_title('supplier_name')} AS supplier_name,
               CAST(strptime(last_replaced_date, '%Y-%m-%d') AS DATE) AS last_replaced_date
        FROM raw_dim_parts_bom""",
    "part_id",
    ["engine_id", "component_name", "supplier_name", "last_replaced_date"],
)
_WITH["dim_thresholds"] = _first_row(
    f"""SELECT lower(trim(sensor_name)) AS sensor_name, critical_limit,
               {_title('alert_description')} AS alert_description
        FROM raw_dim_thresholds""",
    "sensor_name",
    ["critical_limit", "alert_description"],
)

_WITH["wide"] = f"""
SELECT {_columns('f.' + name for name in _CLEAN)}, f.telemetry_timestamp,
       CAST(f.telemetry_timestamp AS DATE) AS telemetry_date,
       e.tail_number, e.home_location_id, e.model, e.aircraft_type_supported, e.manufacture_date,
       a.airline_owner, a.fleet_status, a.total_flight_hours,
       l.airport, l.city, l.climate, l.region
FROM valid f
LEFT JOIN dim_engines e ON f.engine_id = e.engine_id
LEFT JOIN dim_aircraft a ON e.tail_number = a.tail_number
LEFT JOIN dim_locations l ON e.home_location_id = l.location_id"""

_WITH["summary"] = """
SELECT telemetry_date, airline_owner, region, count(engine_id) AS total_sensor_pings,
       -- The mean of values at six decimal places, rounded half up, in whole numbers.
       CASE WHEN count(temp_hpc_out) > 0 THEN
         ((200 * sum(CAST(temp_hpc_out * 1000000 AS HUGEINT)) + count(temp_hpc_out) * 1000000)
          // (2 * count(temp_hpc_out) * 1000000)) / 100.0 END
         AS avg_high_pressure_compressor_temp,
       round(max(physical_core_speed), 2) AS max_core_speed_rpm
FROM wide WHERE airline_owner IS NOT NULL AND region IS NOT NULL
GROUP BY telemetry_date, airline_owner, region"""

_WITH["readings"] = " UNION ALL ".join(
    f"SELECT engine_id, cycle, telemetry_timestamp AS event_time, '{name}' AS sensor_name, "
    f"{name} AS sensor_value FROM valid"
    for name in _SENSORS
)

_WITH["alerts"] = """
SELECT r.engine_id, r.cycle, r.event_time, r.sensor_name, r.sensor_value, t.critical_limit,
       t.alert_description
FROM readings r JOIN dim_thresholds t ON r.sensor_name = t.sensor_name
WHERE r.sensor_value > t.critical_limit"""

_NEEDS = {
    "silver": ["raw_telemetry"],
    "judged": ["silver"],
    "valid": ["judged"],
    "dim_locations": ["raw_dim_locations"],
    "dim_aircraft": ["raw_dim_aircraft"],
    "dim_engines": ["raw_dim_engines"],
    "dim_parts_bom": ["raw_dim_parts_bom"],
    "dim_thresholds": ["raw_dim_thresholds"],
    "wide": ["valid", "dim_engines", "dim_aircraft", "dim_locations"],
    "summary": ["wide"],
    "readings": ["valid"],
    "alerts": ["readings", "dim_thresholds"],
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for needed in [*_closure(_NEEDS.get(name, [])), name]:
            if needed not in ordered:
                ordered.append(needed)
    return ordered


def _using(body: str, *names: str) -> str:
    parts = ",\n".join(f"{name} AS ({_WITH[name]})" for name in _closure(list(names)))
    return f"WITH {parts}\n{body}" if parts else body


def _describe() -> str:
    numbers = {
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax",
    }
    rows = []
    for name in [*sorted(numbers), "l_returnflag", "l_linestatus"]:
        if name in numbers:
            stats = (
                f"round(avg(CAST({name} AS DOUBLE)), 4) AS mean, "
                f"round(stddev_samp(CAST({name} AS DOUBLE)), 4) AS stddev, "
                f"CAST(min({name}) AS DOUBLE) AS min_number, "
                f"CAST(max({name}) AS DOUBLE) AS max_number, "
                "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
            )
        else:
            stats = (
                "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, "
                "CAST(NULL AS DOUBLE) AS min_number, CAST(NULL AS DOUBLE) AS max_number, "
                f"min({name}) AS min_text, max({name}) AS max_text"
            )
        rows.append(
            f"SELECT '{name}' AS column_name, count({name}) AS \"count\", {stats} FROM lineitem"
        )
    return " UNION ALL ".join(rows)


def _merged_profile() -> str:
    kinds = {
        "l_orderkey": True, "l_partkey": True, "l_suppkey": True, "l_linenumber": True,
        "l_quantity": True, "l_extendedprice": True, "l_discount": True, "l_tax": True,
        "l_returnflag": False, "l_linestatus": False, "l_shipdate": False,
    }
    rows = []
    for name, number in kinds.items():
        low, high = (
            (f"CAST(min({name}) AS DOUBLE)", f"CAST(max({name}) AS DOUBLE)") if number
            else ("CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)")
        )
        text = "CAST({name} AS VARCHAR)" if name != "l_shipdate" else "strftime({name}, '%Y-%m-%d %H:%M:%S')"
        first, last = (
            ("CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)") if number
            else tuple(f"{end}({text.format(name=name)})" for end in ("min", "max"))
        )
        rows.append(
            f"SELECT '{name}' AS column_name, count(*) AS row_count, count(*) - count({name}) AS "
            f"null_count, {low} AS min_number, {high} AS max_number, {first} AS min_text, {last} AS "
            f"max_text, true AS distinct_within, {'true' if number else 'CAST(NULL AS BOOLEAN)'} AS "
            "median_within FROM lineitem"
        )
    return " UNION ALL ".join(rows)


_DISTINCT = " UNION ALL ".join(
    f"SELECT DISTINCT '{source}' AS table_name, '{name}' AS column_name, "
    f"CAST({name} AS VARCHAR) AS value FROM {source}"
    for source, name in (
        ("silver", "engine_id"),
        ("silver", "cycle"),
        ("raw_dim_engines", "model"),
        ("raw_dim_engines", "aircraft_type_supported"),
        ("raw_dim_engines", "home_location_id"),
        ("raw_dim_aircraft", "airline_owner"),
        ("raw_dim_aircraft", "fleet_status"),
        ("raw_dim_locations", "city"),
        ("raw_dim_locations", "climate"),
        ("raw_dim_locations", "region"),
        ("raw_dim_parts_bom", "component_name"),
        ("raw_dim_parts_bom", "supplier_name"),
        ("raw_dim_thresholds", "sensor_name"),
        ("raw_dim_thresholds", "alert_description"),
    )
)

_RAW = ("raw_dim_engines", "raw_dim_aircraft", "raw_dim_locations", "raw_dim_parts_bom", "raw_dim_thresholds")
_SNAPSHOTS = (
    "SELECT * REPLACE (CAST(total_flight_hours AS DOUBLE) AS total_flight_hours) FROM ("
    + " UNION ALL BY NAME ".join(f"SELECT '{name}' AS snapshot, * FROM {name}" for name in _RAW)
    + ") s"
)

_AIRCRAFT = ("tail_number", "airline_owner", "fleet_status", "total_flight_hours")
_PROFILE_PARTS = " UNION ALL ".join(
    [
        *(
            f"SELECT 'schema' AS part, '{name}' AS column_name, "
            f"'{place} {'bigint' if name == 'total_flight_hours' else 'string'}' AS value"
            for place, name in enumerate(_AIRCRAFT)
        ),
        "SELECT 'sample', NULL, CAST(least(20, count(*)) AS VARCHAR) FROM raw_dim_aircraft",
        "SELECT 'rows', NULL, CAST(count(*) AS VARCHAR) FROM raw_dim_aircraft",
        *(
            f"SELECT 'nulls', '{name}', CAST(count(*) - count({name}) AS VARCHAR) FROM raw_dim_aircraft"
            for name in _AIRCRAFT
        ),
        *(
            f"SELECT DISTINCT 'distinct', '{name}', {name} FROM raw_dim_aircraft"
            for name in ("airline_owner", "fleet_status")
        ),
    ]
)

_SAMPLE_KEY = "md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR))"
_SAMPLE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_returnflag"
_SAMPLES = (
    f"SELECT part, {_SAMPLE_COLUMNS} FROM (SELECT 'all' AS part, {_SAMPLE_COLUMNS}, row_number() OVER "
    f"(ORDER BY {_SAMPLE_KEY}, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS rn FROM lineitem) a "
    f"WHERE rn <= 50 UNION ALL SELECT part, {_SAMPLE_COLUMNS} FROM (SELECT 'flag' AS part, "
    f"{_SAMPLE_COLUMNS}, row_number() OVER (PARTITION BY l_returnflag "
    f"ORDER BY {_SAMPLE_KEY}, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS rn FROM lineitem) f "
    "WHERE rn <= 5"
)

_DIMENSIONS = ("dim_locations", "dim_aircraft", "dim_engines", "dim_parts_bom", "dim_thresholds")

_COUNTERS = " UNION ALL ".join(
    f"SELECT '{name}' AS dimension, (SELECT count(*) FROM raw_{name}) AS rows_read, "
    f"(SELECT count(*) FROM raw_{name}) - (SELECT count(*) FROM {name}) AS rows_dropped"
    for name in _DIMENSIONS
)

_TEXT_FIELDS = (
    "l_suppkey", "l_orderkey", "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey",
    "l_extendedprice", "l_quantity * 2", "l_tax + 1", "l_discount + 2", "l_partkey + 1",
    "l_orderkey + 1", "l_suppkey + 1", "l_linenumber + 1",
)

_LINEITEM_OTHERS = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]

_Y, _M, _D = "year(l_shipdate)", "month(l_shipdate)", "day(l_shipdate)"
_YEAR = f"CAST({_Y} AS VARCHAR)"
_MONTH = f"lpad(CAST({_M} AS VARCHAR), 2, '0')"
_DAY = f"lpad(CAST({_D} AS VARCHAR), 2, '0')"


def oracle_sql() -> dict[str, str]:
    silver = _columns([*_CLEAN, "telemetry_timestamp"])
    wide = _using("SELECT * FROM wide", "wide")
    alerts = _using("SELECT * FROM alerts", "alerts")
    valid = _using("SELECT * FROM valid", "valid")
    quarantined = _using("SELECT * FROM judged WHERE is_quarantined", "judged")
    summary = _using("SELECT * FROM summary", "summary")
    snapshots = _using(_SNAPSHOTS, *_RAW)
    counters = _using(_COUNTERS, *_DIMENSIONS)
    texts = " UNION ALL ".join(
        [
            "SELECT ' ' || p_name AS text FROM part",
            "SELECT c_name || '  ' AS text FROM customer",
            "SELECT c_mktsegment AS text FROM customer",
        ]
    )
    sql = {
        "fleet_daily_summary": summary,
        "telemetry_run_summary": summary,
        # One engine moves to another aircraft, for all its readings.
        "gold_incremental": summary.replace(
            _WITH["raw_dim_engines"],
            "SELECT * REPLACE (CASE WHEN engine_id = 3 THEN 'REG-41' ELSE tail_number END "
            f"AS tail_number) FROM ({_WITH['raw_dim_engines']}) e",
        ),
        "tenant_view": _using("SELECT * FROM summary WHERE airline_owner = 'Nation 3'", "summary"),
        "obt_left_joins": wide,
        "obt_shuffle_join": wide,
        "obt_salted_join": wide,
        "obt_bucketed_join": wide,
        "key_lookup": _using("SELECT * FROM wide WHERE cycle IN (7, 1000, 4999)", "wide"),
        "profile_merge": _merged_profile(),
        "zorder_layout": wide,
        "sensor_rename_cast": _using(f"SELECT {silver} FROM silver", "silver"),
        "quarantine_flag_counts": _using(
            "SELECT is_quarantined, count(*) AS row_count FROM judged GROUP BY is_quarantined",
            "judged",
        ),
        "quarantine_reason_counts": _using(
            "SELECT quarantine_reason, count(*) AS row_count FROM judged "
            "GROUP BY quarantine_reason",
            "judged",
        ),
        "split_valid": valid,
        "stream_silver_valid": valid,
        "fold_batches": valid,
        "split_quarantine": quarantined,
        "stream_silver_quarantine": quarantined,
        "split_unknown": _using("SELECT * FROM judged WHERE is_quarantined IS NULL", "judged"),
        "merge_schema_append": _using(
            f"SELECT {silver}, CAST(NULL AS BOOLEAN) AS is_quarantined, "
            "CAST(NULL AS VARCHAR) AS quarantine_reason FROM valid "
            f"UNION ALL SELECT {silver}, is_quarantined, quarantine_reason FROM judged "
            "WHERE is_quarantined",
            "valid",
        ),
        "unpivot_sensors": _using("SELECT * FROM readings", "readings"),
        "threshold_alerts": alerts,
        "threshold_alerts_shuffle": alerts,
        "stream_alerts": alerts,
        "alert_latency": _using(
            "SELECT sensor_name, count(*) AS alerts, "
            "CAST(sum(CASE WHEN (cycle % 60) * 10 <= 300 THEN 1 ELSE 0 END) AS BIGINT) "
            "AS within_target, "
            "round(avg(CAST((cycle % 60) * 10 AS DOUBLE)), 4) AS mean_seconds, "
            "CAST(max((cycle % 60) * 10) AS DOUBLE) AS max_seconds, "
            "round(quantile_cont(CAST((cycle % 60) * 10 AS DOUBLE), 0.5), 4) AS p50_seconds, "
            "round(quantile_cont(CAST((cycle % 60) * 10 AS DOUBLE), 0.95), 4) AS p95_seconds "
            "FROM alerts GROUP BY sensor_name",
            "alerts",
        ),
        "clean_text": f"SELECT text, {_title('text')} AS titled, lower(trim(text)) AS lowered, "
        f"trim(text) AS trimmed FROM ({texts}) t",
        "multi_format_date": f"""
SELECT l_orderkey, l_linenumber, date_text,
       coalesce(CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE),
                CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE)) AS parsed
FROM (SELECT l_orderkey, l_linenumber,
             CASE l_linenumber % 3 WHEN 0 THEN concat({_MONTH}, '/', {_DAY}, '/', {_YEAR})
                  WHEN 1 THEN concat({_YEAR}, '-', {_MONTH}, '-', {_DAY})
                  ELSE 'not known' END AS date_text
      FROM lineitem) t""",
        "dedupe_by_key": "SELECT l_orderkey, l_linenumber, "
        + _columns(_LINEITEM_OTHERS)
        + " FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
        + _columns(_LINEITEM_OTHERS)
        + ") AS rn FROM lineitem) r WHERE rn = 1",
        "dim_dq_counters": counters,
        "dimension_sync": _using(
            f"SELECT dimension, 'written' AS status, rows_read, rows_dropped FROM ({_COUNTERS}) c",
            *_DIMENSIONS,
        ),
        "null_counts": _using(
            "SELECT "
            + _columns(
                f"CAST(sum(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {name}"
                for name in [*_CLEAN, "telemetry_timestamp"]
            )
            + " FROM silver",
            "silver",
        ),
        "describe_profile": _describe(),
        "distinct_values": _using(_DISTINCT, "silver", *_RAW),
        "whole_profile": _using(_PROFILE_PARTS, "raw_dim_aircraft"),
        "sample_bottom_k": _SAMPLES,
        "sample_limit": _using(
            "SELECT * FROM raw_telemetry ORDER BY "
            + _columns(f"{name} NULLS FIRST" for name in [*_PAYLOAD, "telemetry_timestamp"])
            + " LIMIT 25",
            "raw_telemetry",
        ),
        "schema_profile": _using(
            " UNION ALL ".join(
                f"SELECT {place} AS position, '{name}' AS column_name, '{kind}' AS data_type, "
                f"{name not in ('s1', 's5', 's6')} AS nullable, count(*) AS row_count, "
                f"count(*) - count({name}) AS null_count FROM raw_telemetry"
                for place, (name, kind) in enumerate(
                    [*((name, "double") for name in _PAYLOAD), ("telemetry_timestamp", "timestamp_ntz")]
                )
            ),
            "raw_telemetry",
        ),
        "decode_json_messages": "SELECT event_id, CAST(user_id AS VARCHAR) AS key, "
        "CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 7 = 0 THEN NULL "
        "ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS k, "
        "CASE WHEN event_id % 11 = 0 THEN '{\"_corrupt_record\":\"oops\"}' "
        "WHEN event_id % 13 = 0 THEN NULL "
        "WHEN event_id % 7 = 0 THEN '{\"k\":\"x\",\"z\":\"2\"}' END AS _rescued_data FROM events",
        "encode_keyed_json": _using(
            "SELECT CAST(CAST(engine_id AS INTEGER) AS VARCHAR) AS key, 15 AS field_count, "
            + _columns(_PAYLOAD)
            + " FROM raw_telemetry",
            "raw_telemetry",
        ),
        "rescued_fields": "SELECT event_id, event_type, "
        "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS DOUBLE) END AS user_id, "
        "value AS rescued_value, "
        "CASE WHEN event_type = 'error' THEN 'n/a' ELSE NULL END AS rescued_user_id FROM events",
        "explode_sensor_array": _using(
            " UNION ALL ".join(
                f"SELECT cycle, '{name}' AS sensor, {name} AS reading, "
                "CAST(NULL AS VARCHAR) AS _rescued_data FROM raw_telemetry "
                "WHERE cycle % 13 <> 0 AND cycle % 17 <> 0 AND cycle % 19 <> 0"
                for name in _PAYLOAD[5:]
            )
            + " UNION ALL SELECT cycle, NULL, NULL, CASE WHEN cycle % 13 = 0 THEN '[{oops' END "
            "FROM raw_telemetry WHERE cycle % 13 = 0 OR cycle % 17 = 0 OR cycle % 19 = 0",
            "raw_telemetry",
        ),
        "archive_latest_per_key": "SELECT CAST(user_id AS DOUBLE) AS engine_id, "
        "CAST(hour(ts) AS DOUBLE) AS cycle, max(event_id) AS event_id, "
        "arg_max(value, event_id) AS reading FROM events GROUP BY user_id, hour(ts)",
        "archive_levels": "SELECT CAST(user_id AS DOUBLE) AS engine_id, "
        "CAST(hour(ts) AS DOUBLE) AS cycle, max(event_id) AS event_id, "
        "arg_max(value, event_id) + 9 AS reading FROM events GROUP BY user_id, hour(ts)",
        "stream_archive_ingest": "SELECT CAST(user_id AS DOUBLE) AS engine_id, "
        "CAST(hour(ts) AS DOUBLE) AS cycle, max(event_id) AS event_id, "
        "arg_max(value, event_id) AS reading, CAST(NULL AS VARCHAR) AS _rescued_data "
        "FROM events GROUP BY user_id, hour(ts)",
        "schema_evolution": "SELECT event_id, event_type, CAST(NULL AS DOUBLE) AS value, "
        "CAST(NULL AS VARCHAR) AS _rescued_data FROM events UNION ALL "
        "SELECT event_id, CAST(NULL AS VARCHAR), value, CAST(NULL AS VARCHAR) FROM events",
        "type_widening": " UNION ALL ".join(
            f"SELECT event_id, {reading} AS reading, {code} AS code, "
            "CAST(NULL AS VARCHAR) AS _rescued_data FROM events"
            for reading, code in (
                ("CAST(user_id AS DOUBLE)", "CAST(user_id AS VARCHAR)"),
                ("value", "event_type"),
                ("CAST(user_id AS DOUBLE)", "CAST(user_id AS VARCHAR)"),
            )
        ),
        "hostile_fields": "SELECT event_id, "
        "CASE WHEN event_id % 2 = 0 THEN event_type END AS version, "
        "CASE WHEN event_id % 2 = 1 THEN CAST(user_id AS BIGINT) END AS odd_key, "
        "CASE WHEN event_id % 2 = 1 THEN 'elsewhere' END AS rescued_path, "
        "CASE WHEN event_id % 2 = 1 THEN 'never' END AS rescued_time FROM events",
        "table_profile": _describe(),
        "whitespace_text_scan": "SELECT "
        + _columns(
            f"CAST({field} AS DOUBLE) AS {name}"
            for field, name in zip(_TEXT_FIELDS, _PAYLOAD, strict=True)
        )
        + " FROM lineitem",
        "dim_json_roundtrip": snapshots,
        "dim_csv_roundtrip": snapshots,
        "dim_parquet_roundtrip": snapshots,
        "compact_table": "SELECT * FROM events",
        "stream_bronze_ingest": _using(
            f"SELECT {_columns(_PAYLOAD)}, telemetry_timestamp, "
            "CAST(NULL AS VARCHAR) AS _rescued_data FROM raw_telemetry",
            "raw_telemetry",
        ),
    }
    for name in _DIMENSIONS:
        sql[f"clean_{name}"] = _using(f"SELECT * FROM {name}", name)
    return sql
