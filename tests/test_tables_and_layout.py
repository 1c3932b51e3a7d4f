from __future__ import annotations

import pytest
from conftest import as_list, as_set
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gaugeworks.functions.curve import interleave, with_position
from gaugeworks.sinks.layout import cluster, cluster_table, compact, files_needed
from gaugeworks.sinks.tables import (
    SchemaMismatch,
    append_merging,
    append_strict,
    create_tenant_view,
    drop_batch,
    read_batches,
    write_batch,
)
from gaugeworks.sinks.versions import overwrite


def test_strict_append_refuses_new_columns(spark, names):
    table = names.silver("t")
    df = spark.range(3)
    append_strict(df, table)
    append_strict(df, table)
    assert spark.table(table).count() == 6
    with pytest.raises(AnalysisException):
        append_strict(df.withColumn("extra", F.lit(1)), table)


def test_merging_append_adds_columns(spark, names):
    table = names.silver("t")
    append_merging(spark.range(2), table)
    append_merging(spark.createDataFrame([("x",)], "extra string"), table)
    append_merging(spark.createDataFrame([("y", 9)], "extra string, id long"), table)
    assert as_set(spark.table(table), "id", "extra") == {
        (0, None), (1, None), (None, "x"), (9, "y"),
    }


def test_overwrite_replaces_the_schema(spark, names):
    table = names.gold("t")
    overwrite(spark.range(5), table)
    overwrite(spark.createDataFrame([("a", 1)], "k string, v int"), table)
    assert as_list(spark.table(table)) == [("a", 1)]


def test_overwrite_may_read_the_table(spark, names):
    table = names.gold("t")
    overwrite(spark.range(5), table)
    overwrite(spark.table(table).where("id > 2"), table)
    assert as_set(spark.table(table)) == {(3,), (4,)}


def test_the_same_batch_again_replaces_it(spark, names):
    table = names.silver("t")
    for batch in ("q-0", "q-1", "q-0", "q-1"):
        write_batch(spark.range(4), table, batch)
    assert read_batches(spark, table).count() == 8
    write_batch(spark.range(1), table, "q-0")
    assert read_batches(spark, table).count() == 5
    drop_batch(spark, table, "q-1")
    assert read_batches(spark, table).count() == 1
    assert read_batches(spark, table).columns == ["id"]
    drop_batch(spark, names.silver("absent"), "q-1")


def test_batches_are_strict_unless_merging(spark, names):
    table = names.silver("t")
    write_batch(spark.range(1), table, "0")
    wider = spark.range(1).withColumn("extra", F.lit("e"))
    with pytest.raises(SchemaMismatch, match="extra"):
        write_batch(wider, table, "1")
    with pytest.raises(SchemaMismatch, match="changed"):
        write_batch(spark.range(1).select(F.col("id").cast("string")), table, "1")
    write_batch(wider, table, "1", merge_schema=True)
    write_batch(spark.range(1), table, "2", merge_schema=True)
    assert as_list(read_batches(spark, table), "extra") == [("e",), (None,), (None,)]


def test_batch_tables_are_not_swapped(spark, names):
    table = names.silver("t")
    write_batch(spark.range(20).repartition(5), table, "a")
    with pytest.raises(ValueError, match="partitioned"):
        compact(spark, table)
    assert spark.table(table).count() == 20


def test_few_rows_leave_few_files(spark, names):
    table = names.silver("t")
    write_batch(spark.range(100, numPartitions=10), table, "a", few_rows=True)
    assert len(spark.table(table).inputFiles()) == 1


def test_tenant_view_quotes_its_value(spark, names):
    table = names.gold("t")
    overwrite(spark.createDataFrame([("O'Hare\\", 1), ("x", 2)], "owner string, v int"), table)
    view = create_tenant_view(spark, names.gold("v"), table, "owner", "O'Hare\\")
    assert as_list(view) == [("O'Hare\\", 1)]
    create_tenant_view(spark, names.gold("v"), table, "owner", "' OR '1' = '1")
    assert spark.table(names.gold("v")).count() == 0


def test_compaction_keeps_rows_and_cuts_files(spark, names):
    table = names.silver("t")
    overwrite(spark.range(1000).repartition(12), table)
    assert len(spark.table(table).inputFiles()) == 12
    assert compact(spark, table)
    assert len(spark.table(table).inputFiles()) == files_needed(spark, table) == 1
    assert spark.table(table).agg(F.sum("id"), F.count("*")).first()[:] == (499500, 1000)
    assert not compact(spark, table)


def test_compaction_respects_the_target_size(spark, names):
    table = names.silver("t")
    overwrite(spark.range(200_000).select("id", F.xxhash64("id").alias("h")).repartition(40), table)
    compact(spark, table, target_bytes=600_000)
    assert 3 <= len(spark.table(table).inputFiles()) <= 8
    assert spark.table(table).distinct().count() == 200_000


def test_positions_follow_the_bounds_and_the_way_between_them(spark):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 4, 5, 9, 10, 99, None)], "v int")
    number = F.col("v").cast("double")
    got = [r["b"] for r in with_position(df, "b", number, [0, 5, 10], 4).collect()]
    assert got == [0, 0, 4, 5, 9, 10, 10, 0]
    fine = spark.range(1000).withColumn("b", F.lit(0))
    found = with_position(fine, "b", F.col("id").cast("double"), [0, 500, 1000], 20)
    places = [r["b"] for r in found.orderBy("id").collect()]
    assert places == sorted(places) and len(set(places)) == 1000
    one = with_position(fine, "b", F.col("id").cast("double"), [7], 3)
    assert {r["b"] for r in one.collect()} == {0}


def test_interleave_takes_bits_in_turn(spark):
    df = spark.createDataFrame([(0b101, 0b011)], "a int, b int")
    assert df.select(interleave([F.col("a"), F.col("b")], 3)).first()[0] == 0b011011


def test_clustering_keeps_rows_and_lets_filters_skip_files(spark, names):
    table = names.gold("t")
    days = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int"))
    rows = spark.range(20_000).select(
        days.alias("day"), ((F.col("id") * 7919) % 97).cast("int").alias("engine"), "id"
    )
    overwrite(rows.repartition(8, "id"), table)
    before = as_list(spark.table(table).agg(F.sum(F.hash("day", "engine", "id")), F.count("*")))
    cluster_table(spark, table, ["day", "engine"], target_bytes=20_000)
    stored = spark.table(table)
    assert as_list(stored.agg(F.sum(F.hash("day", "engine", "id")), F.count("*"))) == before
    files = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.min("day").alias("d0"), F.max("day").alias("d1"),
        F.min("engine").alias("e0"), F.max("engine").alias("e1"),
    )
    total = files.count()
    assert total >= 4
    by_day = files.where("d0 <= DATE'2024-01-03' AND d1 >= DATE'2024-01-03'").count()
    by_engine = files.where("e0 <= 50 AND e1 >= 50").count()
    assert by_day <= total * 0.75 and by_engine <= total * 0.75


def test_clustering_spreads_a_hot_position_of_one_input_partition(spark):
    rows = spark.range(9000, numPartitions=1).select(
        F.when(F.col("id") < 3000, 5).otherwise(F.col("id") % 50).cast("int").alias("a"),
        F.lit(1.0).alias("b"),
    )
    parts = cluster(rows, ["a", "b"], files=8).select(F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 9000 / 8


def test_many_columns_share_the_bits_of_a_position(spark):
    columns = [f"c{k}" for k in range(20)]
    df = spark.range(500).select(*[(F.hash("id", F.lit(k)) % 100).alias(c) for k, c in enumerate(columns)])
    assert cluster(df, columns, files=3).count() == 500


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint", "double"])
def test_clustering_by_each_ordered_type(spark, kind):
    moment = F.timestamp_seconds(F.col("id") * 100_000)
    value = moment.cast(kind) if "stamp" in kind or kind == "date" else F.col("id").cast(kind)
    df = spark.range(1000).select(value.alias("v"), (F.col("id") % 10).alias("w"))
    placed = cluster(df, ["v"], files=4).withColumn("p", F.spark_partition_id())
    ranges = placed.groupBy("p").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    edges = [(row.low, row.high) for row in ranges.orderBy("low").collect()]
    assert len(edges) == 4 and placed.count() == 1000
    assert all(edges[n][1] <= edges[n + 1][0] for n in range(3))


def test_clustering_an_empty_or_null_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a int, b double")
    assert cluster(df, ["a", "b"], files=2).count() == 2
    assert cluster(df.where("false"), ["a"], files=2).count() == 0
