from __future__ import annotations

import pytest
from conftest import as_list, as_set
from pyspark.sql import functions as F

from gaugeworks.sinks import archive, folds
from gaugeworks.sinks.folds import (
    BATCH_COLUMN,
    PLACE_COLUMN,
    Folds,
    _merged,
    fold_batches,
    folds_of,
    list_batches,
    runs_table,
)
from gaugeworks.sinks.tables import read_batches, write_batch

DAY = "to_date(at)"


def readings(spark, start, count=10):
    at = F.timestamp_seconds(F.col("id") * 20_000)
    return spark.range(start, start + count).select("id", at.alias("at"))


def ids(spark, table):
    return sorted(row.id for row in read_batches(spark, table).select("id").collect())


def test_folded_rows_are_read_once_and_batches_go(spark, names):
    table = names.silver("t")
    for n in range(6):
        write_batch(readings(spark, 10 * n), table, f"query-1-{n}")
    state = fold_batches(spark, table, DAY, [f"query-1-{n}" for n in range(4)])
    assert state.applied == {"query-1": 3} and sum(state.runs.values()) == 40
    assert list_batches(spark, table) == ["query-1-4", "query-1-5"]
    assert ids(spark, table) == list(range(60))
    # A replay of a folded batch adds nothing, one of a batch that is left replaces it.
    assert write_batch(readings(spark, 500), table, "query-1-2") is False
    assert write_batch(readings(spark, 900), table, "query-1-5") is True
    assert ids(spark, table) == [*range(50), *range(900, 910)]
    fold_batches(spark, table, DAY)
    assert list_batches(spark, table) == [] and len(ids(spark, table)) == 60
    assert fold_batches(spark, table, DAY) == folds_of(spark, table)


def test_other_queries_and_unnumbered_batches_are_told_apart(spark, names):
    table = names.silver("t")
    for n, name in enumerate(["a-0", "a-1", "a-b-0", "b-7", "first", "it's", "a-x"]):
        write_batch(readings(spark, 10 * n), table, name)
    state = fold_batches(spark, table, DAY, ["a-1", "first", "it's"])
    assert state.applied == {"a": 1} and state.named == ("first", "it's")
    assert list_batches(spark, table) == ["a-b-0", "a-x", "b-7"]
    assert ids(spark, table) == list(range(70))
    assert write_batch(readings(spark, 900), table, "it's") is False
    assert write_batch(readings(spark, 20), table, "a-b-0") is True


def test_partitions_are_bounded_by_places(spark, names):
    table = names.silver("t")
    for n in range(12):
        write_batch(readings(spark, 0, 8), table, f"q-{n}")
        if n % 3 == 2:
            fold_batches(spark, table, DAY)
    stored = spark.sql(f"SHOW PARTITIONS {runs_table(table)}").collect()
    days = as_set(read_batches(spark, table).select(F.to_date("at")))
    assert len(stored) <= len(days) * len(folds_of(spark, table).runs)
    assert read_batches(spark, table).count() == 96
    pruned = spark.table(folds.whole_view(table)).where(F.col(PLACE_COLUMN) == F.lit("1970-01-01").cast("date"))
    assert pruned.count() == 12 * 5
    files = {path for path in pruned.inputFiles() if "__runs" in path}
    assert files and all("_place=1970-01-01" in path for path in files)


def test_null_places_and_new_columns_stay(spark, names):
    table = names.silver("t")
    rows = spark.createDataFrame([(1, None), (2, "2024-01-01 00:00:00")], "id long, at string")
    write_batch(rows.withColumn("at", F.col("at").cast("timestamp")), table, "q-0")
    fold_batches(spark, table, DAY)
    more = readings(spark, 5, 1).withColumn("extra", F.lit("x"))
    write_batch(more, table, "q-1", merge_schema=True)
    assert as_set(read_batches(spark, table), "id", "extra") == {(1, None), (2, None), (5, "x")}
    fold_batches(spark, table, DAY)
    assert as_set(read_batches(spark, table), "id", "extra") == {(1, None), (2, None), (5, "x")}
    with pytest.raises(ValueError, match="folded by"):
        fold_batches(spark, table, "month(at)")


class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("stop", range(4))
def test_a_fold_killed_at_any_step_neither_loses_nor_doubles(spark, names, monkeypatch, stop):
    table = names.silver("t")
    for n in range(3):
        write_batch(readings(spark, 10 * n), table, f"q-{n}")
    fold_batches(spark, table, DAY)
    for n in range(3, 8):
        write_batch(readings(spark, 10 * n), table, f"q-{n}")
    seen, real = [], type(spark).sql

    def sql(self, text, *args, **kwargs):
        if text.split()[0] in ("CREATE", "ALTER", "INSERT"):
            if len(seen) == stop:
                raise Killed
            seen.append(text)
        return real(self, text, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", sql)
        with pytest.raises(Killed):
            fold_batches(spark, table, DAY)
    assert ids(spark, table) == list(range(80))
    write_batch(readings(spark, 80), table, "q-8")
    assert ids(spark, table) == list(range(90))
    state = fold_batches(spark, table, DAY)
    assert ids(spark, table) == list(range(90)) and list_batches(spark, table) == []
    stored = spark.table(runs_table(table)).select("_run").distinct().count()
    assert stored == len(state.runs) and sum(state.runs.values()) == 90


def test_runs_stay_larger_than_all_smaller_ones():
    runs, rewritten = {}, 0
    for step, fresh in enumerate([5, 5, 1, 1, 9, 2, 2, 40, 1, 1, 1, 7] * 8):
        gone = _merged(runs, fresh)
        size = fresh + sum(runs.pop(name) for name in gone)
        rewritten += size
        runs[str(step)] = size
        ordered = sorted(runs.values())
        assert all(size > sum(ordered[:k]) for k, size in enumerate(ordered) if k)
    assert len(runs) <= 10 and rewritten <= 10 * sum(runs.values())


def test_condition_on_batches_equals_the_check(spark):
    state = Folds(DAY, applied={"q": 2, "q-1": 0}, named=("n", "o'k"))
    names = ["q-0", "q-2", "q-3", "q-1-0", "q-1-1", "q-x", "n", "o'k", "p-0", "q", "q-99999999999999999999"]
    rows = spark.createDataFrame([(name,) for name in names], f"{BATCH_COLUMN} string")
    kept = {row[0] for row in rows.where(state.unfolded()).collect()}
    assert kept == {name for name in names if not state.holds(name)}


def messages(spark, sending, engines=40, cycles=5):
    body = F.to_json(F.struct((F.col("id") % engines).alias("engine_id"), (F.col("id") % cycles).alias("cycle"), F.lit(sending).alias("v")))
    return spark.range(engines * cycles).select((F.col("id") + sending * 10_000).alias("offset"), body.alias("value"))


def test_archive_levels_shed_what_was_sent_again(spark, names):
    table = names.bronze("raw")
    keys = 40
    for sending in range(10):
        archive.archive_batch(messages(spark, sending), table, f"s-{sending}")
        archive.fold_archive(spark, table, buckets=8)
    stored = spark.table(runs_table(table))
    assert stored.count() <= 2 * keys
    latest = archive.read_archive(spark, table)
    assert latest.count() == keys
    assert as_set(latest.select(F.get_json_object("value", "$.v"))) == {("9",)}
    one = archive.read_archive(spark, table, "7")
    assert as_list(one, "engine", "cycle") == [("7", "2")]
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "_place" in plan
    read = spark.table(folds.whole_view(table)).where("engine = '7'")
    bucket = spark.sql("SELECT pmod(xxhash64('7'), 8)").first()[0]
    touched = {p for p in read.where(F.col(PLACE_COLUMN) == bucket).inputFiles() if "__runs" in p}
    assert touched and all(f"_place={bucket}" in path for path in touched)


def test_archive_reads_batches_and_levels_together(spark, names):
    table = names.bronze("raw")
    archive.archive_batch(messages(spark, 0), table, "s-0")
    archive.fold_archive(spark, table, buckets=4)
    archive.archive_batch(messages(spark, 1).limit(3), table, "s-1")
    broken = spark.createDataFrame([(5, "no json"), (6, "{}")], "offset long, value string")
    archive.archive_batch(broken, table, "s-2")
    assert archive.read_archive(spark, table).count() == 42
    archive.fold_archive(spark, table)
    assert archive.read_archive(spark, table).count() == 42
    assert archive.read_archive(spark, table, "0").count() == 1
