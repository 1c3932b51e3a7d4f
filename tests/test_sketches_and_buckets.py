from __future__ import annotations

import pytest
from conftest import as_list, as_set
from pyspark.sql import functions as F

from gaugeworks.operators.joins import join_reference
from gaugeworks.operators.profile import bottom_k
from gaugeworks.operators.sketches import (
    DISTINCT_ERROR,
    RANK_ERROR,
    column_sketches,
    merge_sketches,
    read_sketches,
    stored_profile,
    update_profile,
)
from gaugeworks.sinks.buckets import hot_table, join_stored, store_facts, store_reference
from gaugeworks.sinks.layout import cluster, lookup_options
from gaugeworks.sinks.tables import write_batch
from gaugeworks.sinks.versions import overwrite


def values(spark, start, end):
    return spark.range(start, end).select(
        "id",
        F.when(F.col("id") % 10 != 0, F.xxhash64("id") % 5000).alias("code"),
        (F.col("id") * 0.5).alias("half"),
        F.when(F.col("id") % 4 == 0, "often").otherwise(F.concat(F.lit("t"), "id")).alias("name"),
        F.to_date(F.timestamp_seconds(F.col("id") * 1000)).alias("day"),
    )


def check_figures(spark, figures, rows):
    for f in figures:
        name = f.column_name
        assert f.row_count == rows.count()
        assert f.null_count == rows.where(F.col(name).isNull()).count()
        exact = rows.select(name).distinct().where(F.col(name).isNotNull()).count()
        assert abs(f.distinct_values - exact) <= DISTINCT_ERROR * exact
        if f.quantiles is not None:
            total = f.row_count - f.null_count
            for share, value in zip((0.25, 0.5, 0.75), f.quantiles):
                below = rows.where(F.col(name) < value).count() / total
                upto = rows.where(F.col(name) <= value).count() / total
                assert below <= share + RANK_ERROR and upto >= share - RANK_ERROR
            low, high = rows.agg(F.min(name), F.max(name)).first()
            assert (f.min_number, f.max_number, f.min_text) == (low, high, None)


def test_merged_sketches_are_within_their_errors(spark):
    parts = [values(spark, 0, 9000), values(spark, 5000, 30_000), values(spark, 0, 0)]
    sketches = [column_sketches(part) for part in parts]
    merged = merge_sketches(sketches[0].union(sketches[1]).union(sketches[2]))
    rows = parts[0].union(parts[1])
    figures = read_sketches(merge_sketches(merged)).collect()
    check_figures(spark, figures, rows)
    name = next(f for f in figures if f.column_name == "name")
    top = name.commonest[0]
    assert top["item"] == "often" and top["count"] == rows.where("name = 'often'").count()


def test_a_profile_of_a_grown_table_reads_new_batches_only(spark, names):
    table = names.silver("t")
    write_batch(values(spark, 0, 500), table, "q-0")
    write_batch(values(spark, 500, 900), table, "q-1")
    assert update_profile(spark, table) == ["q-0", "q-1"]
    assert update_profile(spark, table) == []
    write_batch(values(spark, 900, 2000), table, "q-2")
    assert update_profile(spark, table) == ["q-2"]
    figures = read_sketches(stored_profile(spark, table)).collect()
    check_figures(spark, figures, values(spark, 0, 2000))


def test_sketches_of_nothing(spark):
    figures = read_sketches(merge_sketches(column_sketches(values(spark, 0, 0)))).collect()
    assert {(f.row_count, f.null_count, f.distinct_values, f.quantiles) for f in figures} == {(0, 0, 0, None)}


def test_bottom_k_depends_on_the_rows_alone(spark):
    rows = values(spark, 0, 3000)
    one = as_list(bottom_k(rows, 40, ["id"]))
    assert as_list(bottom_k(rows.repartition(7).orderBy(F.desc("half")), 40, ["id"])) == one
    halves = [bottom_k(rows.where(F.col("id") % 2 == k), 40, ["id"]) for k in (0, 1)]
    assert as_list(bottom_k(halves[0].union(halves[1]), 40, ["id"])) == one
    plan = bottom_k(rows, 40, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Sort [" not in plan


def test_bottom_k_of_groups_hands_on_few_rows(spark):
    rows = spark.range(0, 20_000, numPartitions=4).select(
        "id", F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(99).alias("g")
    )
    got = bottom_k(rows, 5, ["id"], by=["g"])
    assert as_set(got.groupBy("g").count()) == {(g, 5) for g in [*range(7), 99]}
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_stored_join_shuffles_no_facts(spark, names, how):
    facts = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 7 == 0, F.lit(None).cast("int"))
        .otherwise((F.col("id") % 400).cast("int"))
        .alias("engine"),
        "id",
    )
    profile = spark.range(300).select(F.col("id").cast("int").alias("engine"), F.hex("id").alias("model"))
    store_facts(facts, names.silver("f"), ["engine"], buckets=6, task_rows=500)
    store_reference(profile, names.silver("p"), ["engine"], buckets=6)
    assert as_set(spark.table(hot_table(names.silver("f"))), "engine") == {(1,), (None,)}
    joined = join_stored(spark, names.silver("f"), names.silver("p"), ["engine"], how)
    want = join_reference(facts, profile, ["engine"], how)
    assert as_list(joined, "engine", "id", "model") == as_list(want, "engine", "id", "model")
    cold = spark.table(names.silver("f")).join(spark.table(names.silver("p")).hint("merge"), ["engine"], how)
    plan = cold._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "SelectedBucketsCount" in plan or "Bucketed: true" in plan


def test_a_look_up_reads_the_row_groups_that_have_the_value(spark, names):
    rows = spark.range(200_000).select(
        (F.col("id") % 500).alias("day"),
        (F.xxhash64("id") % 400).alias("engine"),
        F.pmod(F.xxhash64("id", F.lit(7)), F.lit(150_000)).alias("cycle"),
    )
    placed = cluster(rows, ["day", "engine"], files=32)

    def read_rows(table):
        found = spark.table(table).where(F.col("cycle") == 4711)
        scanned = found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        leaf = plan.collectLeaves().head()
        return scanned, leaf.metrics().apply("numOutputRows").value()

    overwrite(placed, names.gold("plain"))
    overwrite(placed, names.gold("filtered"), **lookup_options({"cycle": 10_000}))
    want, before = read_rows(names.gold("plain"))
    got, after = read_rows(names.gold("filtered"))
    assert sorted(got) == sorted(want) and before == 200_000
    assert after * 5 <= before


def test_a_profile_of_figures_is_typed_like_the_table(spark):
    rows = values(spark, 0, 10)
    kinds = {f.column_name: f.data_type for f in column_sketches(rows).collect()}
    assert kinds == dict(rows.dtypes)
