from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from gaugeworks.sinks import versions
from gaugeworks.sinks.tables import write_batch
from gaugeworks.sinks.versions import overwrite, recover, shown_version, stored_name


def rows(spark, table):
    return sorted(row.id for row in spark.table(table).select("id").collect())


def marked(spark, n, mark):
    return spark.range(n).withColumn("mark", F.lit(mark))


class Killed(RuntimeError):
    pass


def statements(monkeypatch, spark, stop_before=None):
    """Counts the catalog steps of a swap; with ``stop_before`` the run dies there."""
    seen, real_sql = [], type(spark).sql

    def step(name):
        if stop_before is not None and len(seen) == stop_before:
            raise Killed(name)
        seen.append(name)

    def sql(self, text, *args, **kwargs):
        if text.split()[0] in ("CREATE", "ALTER", "DROP"):
            step(text.split()[0])
        return real_sql(self, text, *args, **kwargs)

    real_version = versions.new_version

    def new_version(table):
        step("WRITE")
        return real_version(table)

    monkeypatch.setattr(type(spark), "sql", sql)
    monkeypatch.setattr(versions, "new_version", new_version)
    return seen


@pytest.mark.parametrize("plain", [False, True])
def test_a_run_killed_at_any_step_leaves_old_or_new_rows(spark, names, monkeypatch, plain):
    for stop in range(8):
        table = names.gold(f"t{stop}_{int(plain)}")
        if plain:
            marked(spark, 3, "old").write.saveAsTable(table)
        else:
            overwrite(marked(spark, 2, "older"), table)
            overwrite(marked(spark, 3, "old"), table)
        with monkeypatch.context() as patch:
            seen = statements(patch, spark, stop)
            try:
                overwrite(marked(spark, 9, "new"), table)
                whole = True
            except Killed:
                whole = False
        recover(spark, table)
        assert len(rows(spark, table)) in ((9,) if whole else (3, 9))
        assert spark.table(table).select("mark").distinct().count() == 1
        overwrite(marked(spark, 4, "last"), table)
        assert rows(spark, table) == [0, 1, 2, 3]
        assert len(versions.versions(spark, table)) <= 1 + versions.KEEP
        if whole:
            assert {"WRITE", "CREATE"} <= set(seen)
            return
    raise AssertionError("the swap never ended")


def test_a_reader_sees_old_or_new_rows_at_any_moment(spark, names):
    table = names.gold("t")
    overwrite(marked(spark, 1, "0"), table)
    stop, faults, looks = threading.Event(), [], []

    def look():
        reader = spark.newSession()
        while not stop.is_set():
            try:
                found = reader.table(table).collect()
                looks.append(len(found))
                if {row.mark for row in found} != {str(len(found) - 1)}:
                    faults.append(found)
            except Exception as error:  # noqa: BLE001
                faults.append(error)

    thread = threading.Thread(target=look)
    thread.start()
    for n in range(1, 8):
        overwrite(marked(spark, n + 1, str(n)), table, keep=7)
    stop.set()
    thread.join()
    assert not faults, faults
    assert looks and looks == sorted(looks)


def test_a_frame_resolved_before_a_swap_still_reads(spark, names):
    table = names.gold("t")
    overwrite(spark.range(5), table)
    before = spark.table(table)
    overwrite(spark.range(2), table)
    assert before.count() == 5 and spark.table(table).count() == 2


def test_old_versions_go_and_newer_ones_stay(spark, names):
    table = names.gold("t")
    for n in range(4):
        overwrite(spark.range(n), table)
    found = versions.versions(spark, table)
    assert len(found) == 2 and found[-1] == shown_version(spark, table) == stored_name(spark, table)
    # Another run has written its version and is about to publish it.
    other = versions.new_version(table)
    spark.range(50).write.saveAsTable(other)
    versions.remove_versions(spark, table, keep=0)
    assert versions.versions(spark, table) == sorted([shown_version(spark, table), other])


def test_names_that_begin_alike_are_apart(spark, names):
    overwrite(spark.range(1), names.gold("t"))
    overwrite(spark.range(2), names.gold("t_2"))
    assert len(versions.versions(spark, names.gold("t"))) == 1
    assert recover(spark, names.gold("missing")) is False


def test_a_batch_table_is_not_overwritten(spark, names):
    write_batch(spark.range(3), names.silver("t"), "q-0")
    with pytest.raises(ValueError, match="partitioned"):
        overwrite(spark.range(1), names.silver("t"))
