from __future__ import annotations

import pytest
from conftest import as_list
from pyspark.sql import functions as F

from gaugeworks.operators.wide import build_wide, fleet_daily_summary
from gaugeworks.plans import gold
from gaugeworks.plans.gold import FACT_PLACE, PERIOD_COLUMN, Refreshed, refresh_gold
from gaugeworks.plans.medallion import build_gold_summary, build_gold_wide
from gaugeworks.settings import GOLD_SUMMARY, GOLD_WIDE, SENSOR_COLUMNS, SILVER_TELEMETRY
from gaugeworks.sinks.folds import fold_batches
from gaugeworks.sinks.tables import read_batches, write_batch
from gaugeworks.sinks.versions import overwrite

SENSORS = [(name, kind) for name, _, kind in SENSOR_COLUMNS]


def facts(spark, rows):
    """Facts from (engine, cycle, time as text)."""
    base = spark.createDataFrame(rows, "engine_id int, cycle int, at string")
    others = [F.lit(1.5).cast(kind).alias(name) for name, kind in SENSORS[2:]]
    return base.select(
        "engine_id", "cycle", *others, F.col("at").cast("timestamp").alias("telemetry_timestamp")
    )


def dimensions(spark, names, engines):
    rows = [(k, f"T{k}", f"L{k % 2}", model) for k, model in engines.items()]
    overwrite(
        spark.createDataFrame(rows, "engine_id int, tail_number string, home_location_id string, model string"),
        names.silver("slv_dim_engines"),
    )
    crafts = [(f"T{k}", f"Owner {k % 3}") for k in range(9)]
    overwrite(
        spark.createDataFrame(crafts, "tail_number string, airline_owner string"),
        names.silver("slv_dim_aircraft"),
    )
    overwrite(
        spark.createDataFrame([("L0", "North"), ("L1", "South")], "location_id string, region string"),
        names.silver("slv_dim_locations"),
    )


def files(spark, names):
    """The data files of each period."""
    rows = spark.table(names.gold(GOLD_WIDE)).select(F.input_file_name().alias("f"), PERIOD_COLUMN)
    found = {}
    for row in rows.distinct().collect():
        found.setdefault(str(row[PERIOD_COLUMN]), set()).add(row.f)
    return found


def check(spark, names):
    """Both gold tables equal a full computation."""
    dims = [spark.table(names.silver(f"slv_dim_{n}")) for n in ("engines", "aircraft", "locations")]
    wide = build_wide(read_batches(spark, names.silver(SILVER_TELEMETRY)), *dims)
    stored = spark.table(names.gold(GOLD_WIDE))
    assert as_list(stored, *wide.columns) == as_list(wide)
    summary = fleet_daily_summary(wide)
    assert as_list(spark.table(names.gold(GOLD_SUMMARY)), *summary.columns) == as_list(summary)


DAYS = ["2024-01-01 05:00:00", "2024-01-02 06:00:00", "2024-01-03 07:00:00", None]


@pytest.fixture
def started(spark, names):
    dimensions(spark, names, {1: "a", 2: "b", 3: "c"})
    rows = [(1, 1, DAYS[0]), (2, 2, DAYS[1]), (3, 3, DAYS[2]), (1, 4, DAYS[2]), (7, 5, DAYS[1]), (2, 6, None)]
    write_batch(facts(spark, rows), names.silver(SILVER_TELEMETRY), "q-0")
    assert refresh_gold(spark, names) == Refreshed(True)
    check(spark, names)
    return names


def days(result):
    return [None if day is None else day.day for day in result.periods]


def test_only_touched_dates_are_replaced(spark, started):
    before = files(spark, started)
    assert refresh_gold(spark, started) == Refreshed(False, ())
    assert files(spark, started) == before
    write_batch(facts(spark, [(2, 9, DAYS[1])]), started.silver(SILVER_TELEMETRY), "q-1")
    result = refresh_gold(spark, started)
    assert not result.full and days(result) == [2]
    after = files(spark, started)
    assert {day for day in after if after[day] != before.get(day)} == {"2024-01-02"}
    check(spark, started)


def test_a_changed_engine_reaches_its_dates(spark, started):
    before = files(spark, started)
    dimensions(spark, started, {1: "a", 2: "b", 3: "new model"})
    result = refresh_gold(spark, started)
    assert days(result) == [3]
    after = files(spark, started)
    assert {day for day in after if after[day] != before[day]} == {"2024-01-03"}
    check(spark, started)


def test_engines_that_come_and_go(spark, started):
    dimensions(spark, started, {1: "a", 3: "c", 7: "late"})
    assert days(refresh_gold(spark, started)) == [2, None]
    check(spark, started)


def test_facts_without_a_time_and_new_dates(spark, started):
    rows = [(3, 1, None), (3, 2, "2024-02-05 00:00:00")]
    write_batch(facts(spark, rows), started.silver(SILVER_TELEMETRY), "q-1")
    assert days(refresh_gold(spark, started)) == [5, None]
    check(spark, started)


def test_folded_facts_are_read_by_date(spark, started):
    silver = started.silver(SILVER_TELEMETRY)
    fold_batches(spark, silver, FACT_PLACE)
    assert refresh_gold(spark, started) == Refreshed(False, ())
    write_batch(facts(spark, [(1, 8, DAYS[0])]), silver, "q-1")
    assert days(refresh_gold(spark, started)) == [1]
    check(spark, started)
    # Folded before gold saw it: nobody knows its dates any more.
    write_batch(facts(spark, [(1, 9, DAYS[1])]), silver, "q-2")
    fold_batches(spark, silver, FACT_PLACE)
    assert refresh_gold(spark, started).full
    check(spark, started)
    read = gold._facts(spark, silver, "day", (gold.date(2024, 1, 1),))
    assert all("_place=2024-01-01" in path for path in read.inputFiles())


def test_a_refresh_that_broke_off_is_done_again(spark, started, monkeypatch):
    write_batch(facts(spark, [(2, 9, DAYS[1])]), started.silver(SILVER_TELEMETRY), "q-1")

    def fail(*_):
        raise RuntimeError("lost the driver here")

    with monkeypatch.context() as patch:
        patch.setattr(gold, "_store", fail)
        with pytest.raises(RuntimeError, match="lost the driver"):
            refresh_gold(spark, started)
    assert days(refresh_gold(spark, started)) == [2]
    check(spark, started)
    assert refresh_gold(spark, started) == Refreshed(False, ())


def test_another_period_or_a_full_rebuild_starts_afresh(spark, started):
    assert refresh_gold(spark, started, "month").full
    assert len(files(spark, started)) == 2
    check(spark, started)
    write_batch(facts(spark, [(2, 9, "2024-01-31 23:59:59")]), started.silver(SILVER_TELEMETRY), "q-1")
    assert days(refresh_gold(spark, started, "month")) == [1]
    check(spark, started)
    build_gold_wide(spark, started)
    build_gold_summary(spark, started)
    assert refresh_gold(spark, started, "month").full
    check(spark, started)
