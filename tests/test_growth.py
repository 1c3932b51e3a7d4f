"""Steps whose cost per row, task or file must not grow with the tables."""

from __future__ import annotations

import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions import messages
from gaugeworks.functions.curve import curve_position, curve_range, interleave, with_position
from gaugeworks.functions.messages import parse_json_lines
from gaugeworks.plans import gold, queries
from gaugeworks.settings import SILVER_TELEMETRY
from gaugeworks.sinks import layout
from gaugeworks.sinks.buckets import buckets_for
from gaugeworks.sinks.layout import cluster, files_for_all
from gaugeworks.sources.files import read_lines

SCHEMA = T.StructType().add("a", T.DoubleType()).add("b", T.StringType())


def test_only_suspect_texts_have_their_keys_listed(spark):
    texts = {
        '{"a":1.0,"b":"x"}': False,
        '{"a":1.0,"b":"at 10:30"}': False,
        '{"a":1.0,"b":"x","c":1}': True,
        '{"a":1.0,"b":"x","c" :1}': True,
        '{"a":1.0,"b":"x","c"\t:1}': True,
        "{\"a\":1.0,\"b\":\"x\",'c':1}": True,
        '{"a":1.0,"b":"\\":"}': True,
        '{"a":1.0,"a":2.0,"b":"x"}': True,
    }
    frame = spark.createDataFrame([(text,) for text in texts], "value string")
    found = frame.select("value", messages._has_more_keys(F.col("value"), 2).alias("more"))
    assert {row.value: row.more for row in found.collect()} == texts
    rescued = {
        row.value: row._rescued_data and json.loads(row._rescued_data)
        for row in parse_json_lines(frame.withColumn("text", F.col("value")), SCHEMA)
        .withColumnRenamed("text", "value")
        .collect()
    }
    kept = {text for text, found in rescued.items() if found}
    assert kept == {text for text in texts if "c" in text} and len(kept) == 4
    assert all(rescued[text] == {"c": "1"} for text in kept)


def test_positions_of_arrays_are_those_of_expressions(spark):
    values = [None, float("nan"), -1.0, 0.0, 0.5, 3.0, 5.0, 7.25, 10.0, 99.0]
    rows = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(rows, "a double, b double")
    bounds = [[0.0, 5.0, 10.0], [0.0, 1.0, 2.0, 8.0]]
    placed = with_position(df, "pa", F.col("a"), bounds[0], 9)
    placed = with_position(placed, "pb", F.col("b"), bounds[1], 9)
    want = interleave([F.col("pa"), F.col("pb")], 9).alias("want")
    got = curve_position([F.col("a"), F.col("b")], bounds, 9).alias("got")
    found = placed.select(want, got).collect()
    assert [row.got for row in found] == [row.want for row in found]


def test_a_position_that_fills_ranges_is_dealt_out(spark):
    df = spark.range(100, numPartitions=1).withColumn("v", F.lit(4.0))
    place = curve_range([F.col("v")], [[0.0, 8.0]], 3, F.col("id"), [0, 2, 2, 2, 7])
    parts = df.select(place.alias("p")).groupBy("p.part", "p.curve").count().collect()
    # Half the way through one step of two bounds is a quarter of all places.
    assert {row.curve for row in parts} == {2}
    assert sorted((row.part, row["count"]) for row in parts) == [(1, 34), (2, 33), (3, 33)]


def test_clustering_reads_whole_rows_once(spark):
    rows = spark.range(4000).select((F.col("id") % 97).cast("int").alias("v"), "id")
    plan = cluster(rows, ["v"], files=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "rangepartitioning" not in plan
    assert "_range" in plan


def test_a_rewrite_has_tasks_for_all_cores(spark, names, monkeypatch):
    table = names.silver(SILVER_TELEMETRY)
    spark.range(50_000).write.saveAsTable(table)
    assert files_for_all(spark, table) == 1
    monkeypatch.setattr(layout, "_LEAST_FILE_BYTES", 1000)
    assert files_for_all(spark, table) == 3 * spark.sparkContext.defaultParallelism
    assert files_for_all(spark, table, target_bytes=1000) == layout.files_needed(spark, table, 1000)


def test_facts_are_shuffled_before_the_profile_widens_them(spark):
    times = F.timestamp_seconds(F.col("id") * 100_000).alias("telemetry_timestamp")
    facts = spark.range(50).select(F.col("id").cast("int").alias("engine_id"), times)
    engines = spark.createDataFrame(
        [(k, "T", "L", "m") for k in range(40)],
        "engine_id int, tail_number string, home_location_id string, model string",
    )
    aircraft = spark.createDataFrame([("T", "Owner")], "tail_number string, airline_owner string")
    locations = spark.createDataFrame([("L", "North")], "location_id string, region string")
    wide = gold._wide(facts, [engines, aircraft, locations], "month")
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("RebalancePartitions")
    shown = wide.select("engine_id", "airline_owner", gold.PERIOD_COLUMN)
    assert shown.count() == 50 and shown.where("airline_owner IS NULL").count() == 10


def test_buckets_follow_the_rows():
    assert buckets_for(0, least=8) == buckets_for(8_000_000, least=8) == 8
    assert buckets_for(216_000_000, least=8) == 216


def test_landed_messages_are_packed_and_bounded(spark, tmp_path):
    rows = spark.range(120_000, numPartitions=1).select("id", F.lit(None).cast("int").alias("n"))
    queries._land(rows, str(tmp_path / "landing"))
    files = [path.name for path in (tmp_path / "landing").glob("part-*")]
    assert len(files) == 3 and all(name.endswith(".json.lz4") for name in files)
    lines = read_lines(spark, str(tmp_path / "landing"))
    assert lines.count() == 120_000 and lines.where("value LIKE '%\"n\":null}'").count() == 120_000


def test_tasks_can_share_a_landed_file(spark, tmp_path):
    rows = spark.range(400_000, numPartitions=1).select("id", *[F.rand(k).alias(f"v{k}") for k in range(5)])
    queries._land_files(rows, str(tmp_path / "files"))
    (path,) = (tmp_path / "files").glob("part-*")
    assert pq.ParquetFile(path).num_row_groups >= 4
