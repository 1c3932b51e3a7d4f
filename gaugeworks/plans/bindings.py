"""The test tables read as raw telemetry and raw dimension snapshots.

Each binding is SQL that means the same in Spark and in the checking database, so that both
start from the same dirty input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_DATE_TEXT = (
    "concat(CAST(year(d) AS STRING), '-', lpad(CAST(month(d) AS STRING), 2, '0'), '-', "
    "lpad(CAST(day(d) AS STRING), 2, '0'))"
)
_US_DATE_TEXT = (
    "concat(lpad(CAST(month(d) AS STRING), 2, '0'), '/', lpad(CAST(day(d) AS STRING), 2, '0'), "
    "'/', CAST(year(d) AS STRING))"
)

BINDINGS = {
    # lineitem plays the telemetry, with missing ids, unknown and impossible readings.
    "raw_telemetry": """
SELECT CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE CAST(l_suppkey AS DOUBLE) END AS engine_id,
       CAST(l_orderkey AS DOUBLE) AS cycle,
       l_quantity * CAST(1000 AS DOUBLE) AS setting1,
       l_discount AS setting2,
       l_tax * CAST(1000 AS DOUBLE) AS setting3,
       CAST(518.67 AS DOUBLE) AS s1,
       CAST(640 AS DOUBLE) + l_tax * CAST(10 AS DOUBLE) AS s2,
       CASE WHEN l_linenumber = 7 AND l_quantity = 1 THEN CAST(-60 AS DOUBLE)
            WHEN l_partkey % 103 = 0 THEN NULL
            ELSE CAST(1400 AS DOUBLE) + l_extendedprice / CAST(500 AS DOUBLE) END AS s3,
       CAST(1400 AS DOUBLE) + l_extendedprice / CAST(1000 AS DOUBLE) AS s4,
       CAST(14.62 AS DOUBLE) AS s5,
       CAST(21.61 AS DOUBLE) AS s6,
       CAST(550 AS DOUBLE) + l_discount * CAST(50 AS DOUBLE) AS s7,
       CAST(2388 AS DOUBLE) + l_tax AS s8,
       CASE WHEN l_partkey % 101 = 0 THEN CAST(-1 AS DOUBLE)
            ELSE CAST(8900 AS DOUBLE) + l_quantity * CAST(4 AS DOUBLE) END AS s9,
       CAST(1.2 AS DOUBLE) + l_discount * CAST(4 AS DOUBLE) AS s10,
       l_shipdate AS telemetry_timestamp
FROM {lineitem}""",
    "raw_dim_engines": f"""
SELECT CAST(s_suppkey AS DOUBLE) AS engine_id,
       concat('REG-', CAST(40 + s_nationkey AS STRING)) AS tail_number,
       concat('L-', CAST(s_nationkey % 5 AS STRING)) AS home_location_id,
       CASE s_suppkey % 4 WHEN 0 THEN ' TF-12' WHEN 1 THEN 'TF-20b ' WHEN 2 THEN 'Rho 7'
            ELSE 'Sigma-4' END AS model,
       CASE s_suppkey % 4 WHEN 0 THEN 'heron 200' WHEN 1 THEN 'Heron 300'
            WHEN 2 THEN 'KESTREL K9' ELSE ' Osprey Long Range ' END AS aircraft_type_supported,
       CASE WHEN s_suppkey % 37 = 5 THEN 'unknown'
            WHEN s_suppkey % 10 = 3 THEN {_US_DATE_TEXT}
            ELSE {_DATE_TEXT} END AS manufacture_date
FROM (SELECT *, DATE '2011-05-20' + CAST(s_suppkey * 37 % 2500 AS INT) AS d FROM {{supplier}}
      UNION ALL
      SELECT *, DATE '2011-05-20' + CAST(s_suppkey * 37 % 2500 AS INT) AS d FROM {{supplier}}
      WHERE s_suppkey % 20 = 0) t""",
    "raw_dim_aircraft": """
SELECT concat('REG-', CAST(40 + n_nationkey AS STRING)) AS tail_number,
       CASE WHEN n_nationkey = 24 THEN NULL
            ELSE concat(' ', lower(replace(n_name, '_', ' ')), ' ') END AS airline_owner,
       CASE WHEN n_nationkey % 10 = 0 THEN ' In Maintenance' ELSE 'Active ' END AS fleet_status,
       CAST(5000 + n_nationkey * 1600 AS BIGINT) AS total_flight_hours
FROM (SELECT * FROM {nation} UNION ALL SELECT * FROM {nation} WHERE n_nationkey = 0) t""",
    "raw_dim_locations": """
SELECT CASE WHEN pass = 1 THEN NULL ELSE concat('L-', CAST(r_regionkey AS STRING)) END
         AS location_id,
       concat(lower(r_name), ' INTERNATIONAL') AS airport,
       concat(r_name, ' ') AS city,
       CASE WHEN r_regionkey = 2 THEN NULL ELSE concat(' ', r_name, '/Hot') END AS climate,
       lower(r_name) AS region
FROM (SELECT *, 0 AS pass FROM {region}
      UNION ALL SELECT *, 1 AS pass FROM {region} WHERE r_regionkey = 0) t""",
    "raw_dim_parts_bom": f"""
SELECT concat('P-', CAST(p_partkey AS STRING)) AS part_id,
       p_partkey % 100 AS engine_id,
       concat(' ', p_name) AS component_name,
       upper(p_brand) AS supplier_name,
       {_DATE_TEXT} AS last_replaced_date
FROM (SELECT *, DATE '2022-01-01' + CAST(p_partkey % 900 AS INT) AS d FROM {{part}}
      UNION ALL SELECT *, DATE '2022-01-01' + CAST(p_partkey % 900 AS INT) AS d FROM {{part}}
      WHERE p_partkey % 50 = 0) t""",
    # Every supplier repeats one of the limits, spelled in its own way.
    "raw_dim_thresholds": """
SELECT CASE s_suppkey % 5 WHEN 0 THEN ' TEMP_HPC_OUT ' WHEN 1 THEN 'temp_hpc_out'
            WHEN 2 THEN 'physical_core_speed' WHEN 3 THEN 'Engine_Pressure_Ratio'
            ELSE NULL END AS sensor_name,
       CASE s_suppkey % 5 WHEN 0 THEN CAST(1480 AS DOUBLE) WHEN 1 THEN CAST(1480 AS DOUBLE)
            WHEN 2 THEN CAST(8990 AS DOUBLE) WHEN 3 THEN CAST(1.45 AS DOUBLE)
            ELSE CAST(1 AS DOUBLE) END AS critical_limit,
       CASE s_suppkey % 5 WHEN 0 THEN 'hot stage AHEAD'
            WHEN 1 THEN 'Hot Stage Ahead' WHEN 2 THEN 'rotor above its band'
            WHEN 3 THEN ' ratio out of BAND' ELSE 'no sensor' END AS alert_description
FROM {supplier}""",
}

RAW_DIMENSIONS = tuple(name for name in BINDINGS if name.startswith("raw_dim_"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL text whose ``{name}`` marks stand for test tables."""
    frames = {name: table(spark, sf_dir, name) for name in TABLES if f"{{{name}}}" in sql}
    return spark.sql(sql, **frames)


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bind_sql(spark, sf_dir, BINDINGS[name])


def plain_sql(sql: str) -> str:
    """The same text for a database in which the tables have their own names."""
    return sql.format(**{name: name for name in TABLES})
