"""The checked queries: each runs one operator over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions import first_date, lowered, titled, trimmed
from gaugeworks.functions.messages import (
    decode_messages,
    encode_keyed,
    explode_readings,
    parse_json_lines,
)
from gaugeworks.functions.widening import read_widest
from gaugeworks.operators.alerts import alert_latency, threshold_alerts
from gaugeworks.operators.columns import rename_cast, unpivot_sensors
from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.dimensions import clean_dimension, quality_counts
from gaugeworks.operators.joins import salted_join
from gaugeworks.operators.profile import (
    bottom_k,
    column_overview,
    describe_columns,
    distinct_values,
    null_counts,
    profile_table,
)
from gaugeworks.operators.rules import evaluate_rules, split_by_rules
from gaugeworks.operators.sketches import (
    DISTINCT_ERROR,
    RANK_ERROR,
    read_sketches,
    stored_profile,
    update_profile,
)
from gaugeworks.operators.wide import (
    build_wide,
    dated_facts,
    engine_profile,
    fleet_daily_summary,
)
from gaugeworks.plans.bindings import RAW_DIMENSIONS, bind, bind_sql, table
from gaugeworks.plans.gold import PERIOD_COLUMN
from gaugeworks.plans.medallion import process_telemetry, sync_dimensions
from gaugeworks.session import scratch_dir
from gaugeworks.settings import (
    BRONZE_TELEMETRY,
    DIMENSIONS,
    GOLD_ALERTS,
    GOLD_SUMMARY,
    GOLD_WIDE,
    PAYLOAD_COLUMNS,
    PAYLOAD_SCHEMA,
    SILVER_QUARANTINE,
    SILVER_TELEMETRY,
    dimension,
)
from gaugeworks.sinks.archive import archive_batch, fold_archive, read_archive
from gaugeworks.sinks.buckets import buckets_for, join_stored, store_facts, store_reference
from gaugeworks.sinks.folds import fold_batches
from gaugeworks.sinks.layout import cluster_table, compact
from gaugeworks.sinks.tables import (
    Namespace,
    append_merging,
    create_namespaces,
    create_tenant_view,
    read_batches,
    write_batch,
)
from gaugeworks.sinks.versions import overwrite
from gaugeworks.sources.files import read_fields, read_snapshot, stream_archive, stream_lines
from gaugeworks.sources.schema_store import SchemaStore
from gaugeworks.streaming.flows import (
    archive_stream,
    batch_name,
    drain,
    ingest_stream,
    routing,
    run_alerts,
    run_silver,
    widening,
)

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

TIMED_SCHEMA = f"{PAYLOAD_SCHEMA}, telemetry_timestamp timestamp_ntz"
TENANT = "Nation 3"

# The columns whose values a look at the six tables lists.
CATEGORICAL = (
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


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        _QUERIES[name] = build
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- shared inputs ----------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bind(spark, sf_dir, "raw_telemetry")
    typed = rename_cast(raw, telemetry_time=F.col("telemetry_timestamp"))
    return typed.drop("silver_processing_timestamp")


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_by_rules(_silver(spark, sf_dir)).valid


def _dim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return clean_dimension(bind(spark, sf_dir, f"raw_{name}"), dimension(name))


def _profile_dims(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [_dim(spark, sf_dir, f"dim_{name}") for name in ("engines", "aircraft", "locations")]


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_wide(_valid(spark, sf_dir), *_profile_dims(spark, sf_dir))


def _land(messages: DataFrame, folder: str) -> None:
    """Messages as packed JSON files of some thousand each, as an archive holds them.

    A packed file is read by one task, so its messages are bounded.
    """
    writer = messages.write.option("ignoreNullFields", "false").option("compression", "lz4")
    writer.option("maxRecordsPerFile", 50_000).json(folder)


def _land_files(rows: DataFrame, folder: str) -> None:
    """A Parquet file per partition, for streams that take files one by one.

    Tasks share a file by its row groups, so those are far smaller than a micro-batch.
    """
    rows.write.option("parquet.block.size", 4 << 20).parquet(folder)


class _Area:
    """A fresh scratch folder with schemas of its own for queries that store tables."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = scratch_dir(spark, label)
        prefix = f"gw_{uuid.uuid4().hex[:12]}_"
        self.names = create_namespaces(spark, Namespace(prefix), self.path)

    def land_telemetry(self, sf_dir: str) -> str:
        folder = f"{self.path}/landing"
        _land(bind(self.spark, sf_dir, "raw_telemetry"), folder)
        return folder

    def land_dimensions(self, sf_dir: str) -> str:
        folder = f"{self.path}/export"
        for raw in RAW_DIMENSIONS:
            bind(self.spark, sf_dir, raw).write.json(f"{folder}/{raw.removeprefix('raw_')}")
        return folder

    def drain_bronze(self, sf_dir: str) -> str:
        source = self.land_telemetry(sf_dir)
        target = self.names.bronze(BRONZE_TELEMETRY)
        schema = T.StructType.fromDDL(TIMED_SCHEMA)
        # Steps that keep every core at work; a file is one task.
        files = max(8, 4 * self.spark.sparkContext.defaultParallelism)
        lines = stream_lines(self.spark, source, max_files=files)
        ingest_stream(lines, target, f"{self.path}/state/bronze", schema)
        return target

    def drain_silver(self, sf_dir: str) -> tuple[str, str]:
        targets = self.names.silver(SILVER_TELEMETRY), self.names.silver(SILVER_QUARANTINE)
        run_silver(
            self.spark,
            self.drain_bronze(sf_dir),
            *targets,
            f"{self.path}/state/silver",
            telemetry_time=F.col("telemetry_timestamp"),
        )
        return targets


_AUDIT = (
    "ingestion_timestamp",
    "source_file_path",
    "silver_processing_timestamp",
    "alert_generated_at",
    "gold_obt_updated_at",
)


# -- summary and joins ------------------------------------------------------


@query("fleet_daily_summary")
def _fleet_summary_by_day(spark, sf_dir):
    return fleet_daily_summary(_wide(spark, sf_dir))


@query("obt_left_joins")
def _obt_left_joins(spark, sf_dir):
    return _wide(spark, sf_dir)


@query("obt_shuffle_join")
def _obt_shuffle_join(spark, sf_dir):
    """The wide table by the way taken when the dimensions are too large to broadcast."""
    return build_wide(
        _valid(spark, sf_dir), *_profile_dims(spark, sf_dir), max_broadcast_bytes=0
    )


@query("obt_salted_join")
def _obt_salted_join(spark, sf_dir):
    """The wide table with the hot engines spread over salts."""
    facts = dated_facts(_valid(spark, sf_dir))
    profile = engine_profile(*_profile_dims(spark, sf_dir))
    return salted_join(facts, profile, ["engine_id"], "left", task_rows=200)


@query("obt_bucketed_join")
def _obt_bucketed_join(spark, sf_dir):
    """The wide table from facts and profile stored by engine; the busiest engines are apart."""
    area = _Area(spark, "buckets")
    facts, profile = area.names.silver("facts_by_engine"), area.names.silver("profile_by_engine")
    dated = dated_facts(_valid(spark, sf_dir))
    rows = dated.count()
    buckets = buckets_for(rows, least=8)
    store_facts(dated, facts, ["engine_id"], buckets, task_rows=max(1, rows // 100))
    store_reference(engine_profile(*_profile_dims(spark, sf_dir)), profile, ["engine_id"], buckets)
    return join_stored(spark, facts, profile, ["engine_id"])


@query("key_lookup")
def _key_lookup(spark, sf_dir):
    """All readings of three cycles, from a table clustered by date and engine."""
    area = _Area(spark, "lookup")
    target = area.names.gold(GOLD_WIDE)
    overwrite(_wide(spark, sf_dir), target)
    columns = ["telemetry_date", "engine_id"]
    cluster_table(spark, target, columns, target_bytes=1 << 18, lookups={"cycle": 20_000})
    return spark.table(target).where(F.col("cycle").isin(7, 1000, 4999))


@query("tenant_view")
def _tenant_view(spark, sf_dir):
    area = _Area(spark, "tenant")
    summary = area.names.gold(GOLD_SUMMARY)
    overwrite(fleet_daily_summary(_wide(spark, sf_dir)), summary)
    view = area.names.gold("vw_tenant_dashboard")
    return create_tenant_view(spark, view, summary, "airline_owner", TENANT)


# -- telemetry cleaning -----------------------------------------------------


@query("sensor_rename_cast")
def _sensor_rename_cast(spark, sf_dir):
    return _silver(spark, sf_dir)


@query("quarantine_flag_counts")
def _quarantine_flag_counts(spark, sf_dir):
    evaluated = evaluate_rules(_silver(spark, sf_dir))
    return evaluated.groupBy("is_quarantined").agg(F.count("*").alias("row_count"))


@query("quarantine_reason_counts")
def _quarantine_reason_counts(spark, sf_dir):
    evaluated = evaluate_rules(_silver(spark, sf_dir))
    return evaluated.groupBy("quarantine_reason").agg(F.count("*").alias("row_count"))


@query("split_valid")
def _split_valid(spark, sf_dir):
    return _valid(spark, sf_dir)


@query("split_quarantine")
def _split_quarantine(spark, sf_dir):
    return split_by_rules(_silver(spark, sf_dir)).quarantined


@query("split_unknown")
def _split_unknown(spark, sf_dir):
    return split_by_rules(_silver(spark, sf_dir)).unknown


# -- alerts -----------------------------------------------------------------


@query("unpivot_sensors")
def _unpivot_sensor_columns(spark, sf_dir):
    ids = ["engine_id", "cycle", F.col("telemetry_timestamp").alias("event_time")]
    return unpivot_sensors(_valid(spark, sf_dir), ids)


def _alerts(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return threshold_alerts(_valid(spark, sf_dir), _dim(spark, sf_dir, "dim_thresholds"), **options)


@query("threshold_alerts")
def _alerts_over_limit(spark, sf_dir):
    return _alerts(spark, sf_dir)


@query("threshold_alerts_shuffle")
def _threshold_alerts_shuffle(spark, sf_dir):
    """The alerts by the way taken when the limits are too large to broadcast."""
    return _alerts(spark, sf_dir, max_broadcast_bytes=0)


@query("alert_latency")
def _alert_delay(spark, sf_dir):
    """Delays of alerts raised ten seconds per linear step of the cycle after the reading."""
    seconds = F.make_dt_interval(secs=(F.col("cycle") % 60) * 10)
    raised = _alerts(spark, sf_dir).withColumn(
        "alert_generated_at", F.col("event_time") + seconds
    )
    return alert_latency(raised, exact=True).select(
        "sensor_name",
        "alerts",
        "within_target",
        F.round("mean_seconds", 4).alias("mean_seconds"),
        "max_seconds",
        F.round("p50_seconds", 4).alias("p50_seconds"),
        F.round("p95_seconds", 4).alias("p95_seconds"),
    )


# -- dimensions -------------------------------------------------------------


def _register_dimension(name: str) -> None:
    def build(spark, sf_dir):
        return _dim(spark, sf_dir, name)

    _QUERIES[f"clean_{name}"] = build


for _spec in DIMENSIONS:
    _register_dimension(_spec.name)


@query("clean_text")
def _clean_text(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.concat(F.lit(" "), "p_name").alias("text"))
    people = table(spark, sf_dir, "customer").select(F.concat("c_name", F.lit("  ")).alias("text"))
    segments = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("text"))
    texts = part.unionByName(people).unionByName(segments)
    return texts.select(
        "text",
        titled("text").alias("titled"),
        lowered("text").alias("lowered"),
        trimmed("text").alias("trimmed"),
    )


@query("multi_format_date")
def _multi_format_date(spark, sf_dir):
    dates = bind_sql(
        spark,
        sf_dir,
        """SELECT l_orderkey, l_linenumber, concat(y, '-', m, '-', d) AS iso,
                  CASE l_linenumber % 3 WHEN 0 THEN concat(m, '/', d, '/', y)
                       WHEN 1 THEN concat(y, '-', m, '-', d) ELSE 'not known' END AS date_text
           FROM (SELECT l_orderkey, l_linenumber,
                        CAST(year(l_shipdate) AS STRING) AS y,
                        lpad(CAST(month(l_shipdate) AS STRING), 2, '0') AS m,
                        lpad(CAST(day(l_shipdate) AS STRING), 2, '0') AS d
                 FROM {lineitem}) t""",
    )
    return dates.select(
        "l_orderkey",
        "l_linenumber",
        "date_text",
        first_date("date_text", ("yyyy-MM-dd", "MM/dd/yyyy")).alias("parsed"),
    )


@query("dedupe_by_key")
def _dedupe_by_key(spark, sf_dir):
    return first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dim_dq_counters")
def _dim_dq_counters(spark, sf_dir):
    counts = [
        quality_counts(
            bind(spark, sf_dir, f"raw_{spec.name}"), _dim(spark, sf_dir, spec.name), spec.name
        )
        for spec in DIMENSIONS
    ]
    merged = counts[0]
    for part in counts[1:]:
        merged = merged.unionByName(part)
    return merged


@query("dimension_sync")
def _dimension_sync(spark, sf_dir):
    """Snapshots through bronze to silver as stored tables, with what happened to each."""
    area = _Area(spark, "sync")
    status = sync_dimensions(spark, area.land_dimensions(sf_dir), area.names)
    return status.select("dimension", "status", "rows_read", "rows_dropped")


# -- profile ----------------------------------------------------------------


@query("null_counts")
def _null_count_per_column(spark, sf_dir):
    return null_counts(_silver(spark, sf_dir))


@query("describe_profile")
def _describe_profile(spark, sf_dir):
    return _described(describe_columns(table(spark, sf_dir, "lineitem")))


@query("table_profile")
def _table_profile(spark, sf_dir):
    """The summary part of a whole profile."""
    summary = profile_table(table(spark, sf_dir, "lineitem")).summary
    parts = ("count", "mean", "stddev", "min", "max")
    long = summary.unpivot(["summary"], summary.columns[1:], "column_name", "figure")
    turned = long.groupBy("column_name").pivot("summary", list(parts)).agg(F.first("figure"))
    return _described(
        turned.withColumns(
            {
                "count": F.col("count").cast("long"),
                "mean": F.col("mean").try_cast("double"),
                "stddev": F.col("stddev").try_cast("double"),
            }
        )
    )


def _described(described: DataFrame) -> DataFrame:
    return described.select(
        "column_name",
        "count",
        F.round("mean", 4).alias("mean"),
        F.round("stddev", 4).alias("stddev"),
        F.col("min").try_cast("double").alias("min_number"),
        F.col("max").try_cast("double").alias("max_number"),
        F.when(F.col("mean").isNull(), F.col("min")).alias("min_text"),
        F.when(F.col("mean").isNull(), F.col("max")).alias("max_text"),
    )


@query("distinct_values")
def _distinct_column_values(spark, sf_dir):
    """The values of every categorical column of all six tables."""
    frames = {"silver": _silver(spark, sf_dir)}
    merged = None
    for source, name in CATEGORICAL:
        if source not in frames:
            frames[source] = bind(spark, sf_dir, source)
        values = distinct_values(frames[source], name).select(
            F.lit(source).alias("table_name"),
            F.lit(name).alias("column_name"),
            F.col(name).cast("string").alias("value"),
        )
        merged = values if merged is None else merged.unionByName(values)
    return merged


@query("sample_limit")
def _sample_limit(spark, sf_dir):
    """A sample of 25 rows, ordered first so that it is always the same one."""
    raw = bind(spark, sf_dir, "raw_telemetry")
    return raw.orderBy(*raw.columns).limit(25)


@query("sample_bottom_k")
def _sample_bottom_k(spark, sf_dir):
    """The same 50 order lines whatever their order or partitioning, and 5 of each return flag."""
    lines = table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    parts = {"all": bottom_k(lines, 50, key), "flag": bottom_k(lines, 5, key, by=["l_returnflag"])}
    columns = [*key, "l_partkey", "l_returnflag"]
    found = [part.select(F.lit(name).alias("part"), *columns) for name, part in parts.items()]
    return found[0].unionByName(found[1])


@query("schema_profile")
def _schema_profile(spark, sf_dir):
    overview = column_overview(bind(spark, sf_dir, "raw_telemetry"))
    return overview.select(
        "position", "column_name", "data_type", "nullable", "row_count", "null_count"
    )


@query("whole_profile")
def _whole_profile(spark, sf_dir):
    """All parts of a profile but the summary, which ``table_profile`` has: schema, sample, row
    count, NULL counts and the values of the categorical columns."""
    raw = bind(spark, sf_dir, "raw_dim_aircraft")
    found = profile_table(raw, ("airline_owner", "fleet_status"), sample_rows=20)

    def part(frame: DataFrame, name: str, column, value) -> DataFrame:
        text = value.cast("string").alias("value")
        return frame.select(F.lit(name).alias("part"), column.alias("column_name"), text)

    counts = found.null_counts.unpivot([], found.null_counts.columns, "column_name", "nulls")
    no_column = F.lit(None).cast("string")
    parts = [
        part(found.schema, "schema", F.col("column_name"), F.concat_ws(" ", "position", "data_type")),
        part(found.sample.agg(F.count("*").alias("n")), "sample", no_column, F.col("n")),
        part(found.row_count, "rows", no_column, F.col("row_count")),
        part(counts, "nulls", F.col("column_name"), F.col("nulls")),
        *(
            part(values, "distinct", F.lit(name), F.col(name))
            for name, values in found.distinct.items()
        ),
    ]
    merged = parts[0]
    for frame in parts[1:]:
        merged = merged.unionByName(frame)
    return merged


@query("profile_merge")
def _profile_merge(spark, sf_dir):
    """Order lines that come in four batches, profiled after two and after four of them.

    Exact figures as they are; of the estimates, whether they are within their stated errors.
    """
    area = _Area(spark, "profile")
    lines = table(spark, sf_dir, "lineitem")
    target = area.names.silver("lines")
    for batch in range(4):
        write_batch(lines.where(F.col("l_orderkey") % 4 == batch), target, f"lines-{batch}")
        if batch in (1, 3):
            update_profile(spark, target)
    figures = read_sketches(stored_profile(spark, target), (0.5,))
    numbers = [f.name for f in lines.schema if isinstance(f.dataType, T.NumericType)]
    exact = lines.agg(
        F.array(
            *(
                F.struct(F.lit(name).alias("column_name"), F.count_distinct(name).alias("exact"))
                for name in lines.columns
            )
        ).alias("_exact")
    ).select(F.inline("_exact"))
    medians = figures.where(F.col("quantiles").isNotNull()).select(
        "column_name", F.col("quantiles")[0].alias("median")
    )
    long = lines.select(
        F.explode(
            F.array(*(F.struct(F.lit(n).alias("column_name"), F.col(n).cast("double").alias("v")) for n in numbers))
        ).alias("_one")
    ).select("_one.*")
    ranks = (
        long.join(F.broadcast(medians), "column_name")
        .groupBy("column_name")
        .agg(
            F.avg((F.col("v") < F.col("median")).cast("double")).alias("below"),
            F.avg((F.col("v") <= F.col("median")).cast("double")).alias("up_to"),
        )
    )
    off = F.abs(F.col("distinct_values") - F.col("exact")) / F.col("exact")
    return (
        figures.join(exact, "column_name")
        .join(ranks, "column_name", "left")
        .select(
            "column_name",
            "row_count",
            "null_count",
            "min_number",
            "max_number",
            "min_text",
            "max_text",
            (off <= DISTINCT_ERROR).alias("distinct_within"),
            F.when(
                F.col("below").isNotNull(),
                (F.col("below") <= 0.5 + RANK_ERROR) & (F.col("up_to") >= 0.5 - RANK_ERROR),
            ).alias("median_within"),
        )
    )


# -- messages ---------------------------------------------------------------


@query("decode_json_messages")
def _decode_json_messages(spark, sf_dir):
    """Event properties as messages, some of them broken, missing or of other fields."""
    text = (
        F.when(F.col("event_id") % 11 == 0, F.lit("oops"))
        .when(F.col("event_id") % 13 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 7 == 0, F.lit('{"k":"x","z":2}'))
        .otherwise(F.col("props"))
    )
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("key"),
        F.encode(text, "utf-8").alias("value"),
    )
    return decode_messages(events, "k int", rescued="_rescued_data")


@query("encode_keyed_json")
def _encode_keyed_json(spark, sf_dir):
    raw = bind(spark, sf_dir, "raw_telemetry")
    keyed = encode_keyed(raw, "engine_id", list(PAYLOAD_COLUMNS)).withColumn(
        "field_count", F.size(F.json_object_keys("value"))
    )
    return decode_messages(keyed, PAYLOAD_SCHEMA)


@query("rescued_fields")
def _rescued_fields(spark, sf_dir):
    """Events whose messages carry a field the schema lacks and a value of the wrong type."""
    events = table(spark, sf_dir, "events")
    wrong = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(
        F.col("user_id").cast("string")
    )
    messages = events.select(
        F.to_json(F.struct("event_id", "event_type", "value", wrong.alias("user_id"))).alias(
            "value"
        )
    )
    schema = T.StructType.fromDDL("event_id long, event_type string, user_id double")
    quoted = F.regexp_replace("value", r'"user_id":"(\d+)"', '"user_id":$1')
    parsed = parse_json_lines(messages.select(quoted.alias("value")), schema)
    rescued = F.col("_rescued_data")
    return parsed.select(
        "event_id",
        "event_type",
        "user_id",
        F.get_json_object(rescued, "$.value").cast("double").alias("rescued_value"),
        F.get_json_object(rescued, "$.user_id").alias("rescued_user_id"),
    )


@query("explode_sensor_array")
def _explode_sensor_array(spark, sf_dir):
    raw = bind(spark, sf_dir, "raw_telemetry")
    readings = F.array(
        *[
            F.struct(F.lit(name).alias("sensor"), F.col(name).alias("reading"))
            for name in PAYLOAD_COLUMNS[5:]
        ]
    )
    # Some messages are broken, empty or missing; none may vanish.
    damaged = (
        F.when(F.col("cycle") % 13 == 0, F.lit("[{oops"))
        .when(F.col("cycle") % 17 == 0, F.lit("[]"))
        .when(F.col("cycle") % 19 != 0, F.to_json(readings))
    )
    return explode_readings(raw.select("cycle", damaged.alias("value")), "value")


@query("archive_latest_per_key")
def _archive_latest_per_key(spark, sf_dir):
    """Events archived as readings of an engine per hour: a batch, its replay, and a resend."""
    archive = _Area(spark, "archive").names.bronze("raw_messages")
    events = _event_messages(table(spark, sf_dir, "events"))
    for batch in ("first", "first", "second"):
        archive_batch(events, archive, batch)
    schema = "engine_id double, cycle double, event_id long, reading double"
    latest = read_archive(spark, archive).select("value")
    return decode_messages(latest, schema)


# -- sources and layout -----------------------------------------------------


@query("whitespace_text_scan")
def _whitespace_text_scan(spark, sf_dir):
    folder = f"{scratch_dir(spark, 'text')}/readings"
    raw = bind_sql(
        spark,
        sf_dir,
        """SELECT l_suppkey, l_orderkey, l_quantity, l_discount, l_tax, l_linenumber, l_partkey,
                  l_extendedprice, l_quantity * 2 AS q2, l_tax + 1 AS t1, l_discount + 2 AS d2,
                  l_partkey + 1 AS p1, l_orderkey + 1 AS o1, l_suppkey + 1 AS s1,
                  l_linenumber + 1 AS n1, l_returnflag, l_linestatus FROM {lineitem}""",
    )
    gaps = [F.lit(" "), F.lit("   "), F.lit("\t")]
    parts = [F.lit("  ")]
    for place, name in enumerate(raw.columns):
        parts += [F.col(name).cast("string"), gaps[place % 3]]
    raw.select(F.concat(*parts).alias("value")).write.text(folder)
    return read_fields(spark, folder)


def _round_trip(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """All five snapshots, written and read with the types that the reader infers."""
    folder = scratch_dir(spark, fmt)
    merged = None
    for name in RAW_DIMENSIONS:
        raw = bind(spark, sf_dir, name)
        writer = raw.write.format(fmt)
        if fmt == "csv":
            # Blanks at either end are part of a text; they have to survive both ways.
            writer = writer.options(
                header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
            )
        writer.save(f"{folder}/{name}")
        read = read_snapshot(spark, f"{folder}/{name}", fmt)
        kinds = {f.name: f.dataType.simpleString() for f in read.schema}
        # What is compared: numbers as numbers, dates that were inferred as the text they came from.
        values = read.select(
            F.lit(name).alias("snapshot"),
            *(
                F.col(column).cast("double" if kinds[column] in _NUMBERS else "string").alias(column)
                for column in raw.columns
            ),
        )
        merged = values if merged is None else merged.unionByName(values, allowMissingColumns=True)
    return merged


_NUMBERS = ("int", "bigint", "double")


@query("dim_json_roundtrip")
def _dim_json_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "json")


@query("dim_csv_roundtrip")
def _dim_csv_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "csv")


@query("dim_parquet_roundtrip")
def _dim_parquet_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "parquet")


@query("merge_schema_append")
def _merge_schema_append(spark, sf_dir):
    """Valid rows, then quarantined rows whose two extra columns widen the table."""
    area = _Area(spark, "merge")
    target = area.names.silver(SILVER_QUARANTINE)
    branches = split_by_rules(_silver(spark, sf_dir))
    append_merging(branches.valid, target)
    append_merging(branches.quarantined, target)
    return spark.table(target)


@query("compact_table")
def _compact_table(spark, sf_dir):
    area = _Area(spark, "compact")
    target = area.names.silver("events")
    events = table(spark, sf_dir, "events")
    overwrite(events.repartition(16, "event_id"), target)
    compact(spark, target)
    return spark.table(target)


@query("zorder_layout")
def _zorder_layout(spark, sf_dir):
    area = _Area(spark, "cluster")
    target = area.names.gold(GOLD_WIDE)
    overwrite(_wide(spark, sf_dir), target)
    cluster_table(spark, target, ["telemetry_date", "engine_id"], target_bytes=4 * 1024 * 1024)
    return spark.table(target)


# -- streams ----------------------------------------------------------------


def _event_messages(events: DataFrame) -> DataFrame:
    """Events as broker messages: readings of an engine (user) per cycle (hour)."""
    body = F.struct(
        F.col("user_id").cast("double").alias("engine_id"),
        F.hour("ts").cast("double").alias("cycle"),
        "event_id",
        F.col("value").alias("reading"),
    )
    return events.select(F.col("event_id").alias("offset"), F.to_json(body).alias("value"))


@query("stream_archive_ingest")
def _stream_archive_ingest(spark, sf_dir):
    """A message stream archived, and the archive streamed on into bronze."""
    area = _Area(spark, "archived")
    messages = _event_messages(table(spark, sf_dir, "events"))
    messages.write.parquet(f"{area.path}/topic")
    topic = spark.readStream.schema(messages.schema).parquet(f"{area.path}/topic")
    archive, bronze = area.names.bronze("raw_messages"), area.names.bronze(BRONZE_TELEMETRY)
    archive_stream(topic, archive, f"{area.path}/state/archive")
    schema = T.StructType.fromDDL("engine_id double, cycle double, event_id long, reading double")
    ingest_stream(stream_archive(spark, archive), bronze, f"{area.path}/state/bronze", schema)
    return spark.table(bronze).drop(*_AUDIT)


@query("schema_evolution")
def _schema_evolution(spark, sf_dir):
    """Events ingested before and after their messages gain a field."""
    area = _Area(spark, "evolving")
    landing, bronze = f"{area.path}/landing", area.names.bronze(BRONZE_TELEMETRY)
    store = SchemaStore(spark, f"{area.path}/state/schema")
    events = table(spark, sf_dir, "events")
    for wave, columns in (("1", ["event_id", "event_type"]), ("2", ["event_id", "value"])):
        events.select(*columns).write.json(f"{landing}/{wave}")
        schema = store.evolve(landing)
        ingest_stream(stream_lines(spark, landing), bronze, f"{area.path}/state/bronze", schema)
    return spark.table(bronze).drop(*_AUDIT)


@query("type_widening")
def _type_widening(spark, sf_dir):
    """Events whose readings are whole numbers at first and fractions later, and whose codes are
    numbers at first and text later; no value is rescued."""
    area = _Area(spark, "widening")
    landing, bronze = f"{area.path}/landing", area.names.bronze(BRONZE_TELEMETRY)
    store = SchemaStore(spark, f"{area.path}/state/schema")
    events = table(spark, sf_dir, "events")
    whole = F.col("user_id").cast("long")
    waves = {"1": (whole, whole), "2": (F.col("value"), F.col("event_type")), "3": (whole, whole)}
    for wave, (reading, code) in waves.items():
        rows = events.select("event_id", reading.alias("reading"), code.alias("code"))
        rows.write.json(f"{landing}/{wave}")
        schema = store.evolve(landing, widen=widening(spark, bronze))
        ingest_stream(stream_lines(spark, landing), bronze, f"{area.path}/state/bronze", schema)
    return read_widest(spark.table(bronze)).drop(*_AUDIT)


@query("hostile_fields")
def _hostile_fields(spark, sf_dir):
    """Two waves of events with keys that need quoting, are nested, or clash with our own."""
    area = _Area(spark, "hostile")
    landing, bronze = f"{area.path}/landing", area.names.bronze(BRONZE_TELEMETRY)
    store = SchemaStore(spark, f"{area.path}/state/schema")
    events = table(spark, sf_dir, "events")
    nested = F.struct(F.struct(F.col("event_type").alias("fw-version`x")).alias("in-ner"))
    waves = {
        "0": [nested.alias("me-ta")],
        "1": [
            F.col("user_id").alias("odd`key"),
            F.lit("elsewhere").alias("source_file_path"),
            F.lit("never").alias("Ingestion_Timestamp"),
        ],
    }
    for wave, columns in waves.items():
        rows = events.where(F.col("event_id") % 2 == int(wave)).select("event_id", *columns)
        rows.write.json(f"{landing}/{wave}")
        for _ in range(2):  # the second time there is nothing new
            schema = store.evolve(landing, widen=widening(spark, bronze))
            ingest_stream(stream_lines(spark, landing), bronze, f"{area.path}/state/bronze", schema)
    rescued = F.col("_rescued_data")
    return spark.table(bronze).select(
        "event_id",
        F.col("me-ta")["in-ner"]["fw-version`x"].alias("version"),
        F.col("`odd``key`").alias("odd_key"),
        F.get_json_object(rescued, "$.source_file_path").alias("rescued_path"),
        F.get_json_object(rescued, "$.Ingestion_Timestamp").alias("rescued_time"),
    )


@query("stream_bronze_ingest")
def _stream_bronze_ingest(spark, sf_dir):
    area = _Area(spark, "bronze")
    return spark.table(area.drain_bronze(sf_dir)).drop(*_AUDIT)


@query("stream_silver_valid")
def _stream_silver_valid(spark, sf_dir):
    valid, _ = _Area(spark, "valid").drain_silver(sf_dir)
    return read_batches(spark, valid).drop(*_AUDIT)


@query("stream_silver_quarantine")
def _stream_silver_quarantine(spark, sf_dir):
    _, quarantine = _Area(spark, "quarantine").drain_silver(sf_dir)
    return read_batches(spark, quarantine).drop(*_AUDIT)


@query("stream_alerts")
def _stream_alerts(spark, sf_dir):
    area = _Area(spark, "alerts")
    valid, _ = area.drain_silver(sf_dir)
    limits = area.names.silver("slv_dim_thresholds")
    overwrite(_dim(spark, sf_dir, "dim_thresholds"), limits)
    target = area.names.gold(GOLD_ALERTS)
    run_alerts(spark, valid, limits, target, f"{area.path}/state/alerts")
    return read_batches(spark, target).drop(*_AUDIT)


@query("telemetry_run_summary")
def _telemetry_run_summary(spark, sf_dir):
    """All stages in order on stored tables; returns the gold summary."""
    area = _Area(spark, "run")
    sync_dimensions(spark, area.land_dimensions(sf_dir), area.names)
    process_telemetry(
        spark,
        area.land_telemetry(sf_dir),
        area.names,
        f"{area.path}/state",
        telemetry_time=F.col("telemetry_timestamp"),
        extra_schema="telemetry_timestamp timestamp_ntz",
    )
    return spark.table(area.names.gold(GOLD_SUMMARY))


@query("gold_incremental")
def _gold_incremental(spark, sf_dir):
    """Two landings, and one engine that moves to another aircraft between them.

    The second run replaces the months of the new readings and of that engine's readings only.
    """
    area = _Area(spark, "incremental")
    raw = bind(spark, sf_dir, "raw_telemetry")
    late = F.col("telemetry_timestamp") >= F.lit("1998-06-01").cast("timestamp_ntz")
    export = area.land_dimensions(sf_dir)
    for wave, rows in (("1", raw.where(~late)), ("2", raw.where(late))):
        if wave == "2":
            moved = F.when(F.col("engine_id") == 3, F.lit("REG-41")).otherwise(F.col("tail_number"))
            engines = bind(spark, sf_dir, "raw_dim_engines").withColumn("tail_number", moved)
            engines.write.mode("overwrite").json(f"{export}/dim_engines")
        sync_dimensions(spark, export, area.names)
        _land(rows, f"{area.path}/landing/{wave}")
        process_telemetry(
            spark,
            f"{area.path}/landing",
            area.names,
            f"{area.path}/state",
            telemetry_time=F.col("telemetry_timestamp"),
            extra_schema="telemetry_timestamp timestamp_ntz",
            gold_period="month",
        )
    return spark.table(area.names.gold(GOLD_SUMMARY)).drop(PERIOD_COLUMN)


@query("fold_batches")
def _fold_batches(spark, sf_dir):
    """Twenty micro-batches: folded by month twice on the way, one replayed after it was folded."""
    area = _Area(spark, "fold")
    landing, checkpoint = f"{area.path}/readings", f"{area.path}/state/silver"
    valid, quarantine = area.names.silver(SILVER_TELEMETRY), area.names.silver(SILVER_QUARANTINE)
    silver = _silver(spark, sf_dir)
    _land_files(silver.repartition(20, F.xxhash64("cycle", "telemetry_timestamp")), landing)
    batches = []

    def route(batch: DataFrame, batch_id: int) -> None:
        batches.append(batch_name(batch, batch_id))
        routing(valid, quarantine)(batch, batch_id)
        if batch_id in (6, 13):
            fold_batches(spark, valid, "trunc(telemetry_timestamp, 'month')", batches[:-1])

    stream = (
        spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    )
    drain(stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint))
    # The replay of a folded batch, with rows that would be seen.
    write_batch(_valid(spark, sf_dir), valid, batches[3])
    return read_batches(spark, valid)


@query("archive_levels")
def _archive_levels(spark, sf_dir):
    """Events sent ten times, the last time with other readings, folded after each sending."""
    archive = _Area(spark, "levels").names.bronze("raw_messages")
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0] + 1
    for sending in range(10):
        changed = events.withColumn("value", F.col("value") + sending)
        messages = _event_messages(changed).withColumn("offset", F.col("offset") + sending * last)
        archive_batch(messages, archive, f"sending-{sending}")
        fold_archive(spark, archive)
    schema = "engine_id double, cycle double, event_id long, reading double"
    return decode_messages(read_archive(spark, archive).select("value"), schema)
