from __future__ import annotations

from conftest import as_list, as_set

from gaugeworks.operators.profile import (
    column_overview,
    describe_columns,
    null_counts,
    profile_table,
    schema_rows,
)


def frame(spark):
    return spark.createDataFrame(
        [(1, "x", 1.5, True), (2, None, None, False), (3, "10", 4.5, None)],
        "a int, t string, d double, f boolean",
    )


def test_null_counts(spark):
    assert tuple(null_counts(frame(spark)).first()) == (0, 1, 1, 1)
    assert tuple(null_counts(frame(spark).where("false")).first()) == (None,) * 4


def test_describe_columns_agrees_with_describe(spark):
    df = frame(spark)
    ours = {row.column_name: row for row in describe_columns(df).collect()}
    theirs = {row.summary: row.asDict() for row in df.describe().collect()}
    assert set(ours) == {"a", "t", "d"}
    for name, row in ours.items():
        assert str(row["count"]) == theirs["count"][name]
        for stat in ("mean", "stddev"):
            got, want = row[stat], theirs[stat][name]
            assert (got is None) == (want is None)
            assert got is None or abs(got - float(want)) < 1e-12
        assert (row["min"], row["max"]) == (theirs["min"][name], theirs["max"][name])


def test_schema_and_overview(spark):
    df = frame(spark)
    assert as_list(schema_rows(df), "position", "column_name", "data_type") == [
        (0, "a", "int"), (1, "t", "string"), (2, "d", "double"), (3, "f", "boolean"),
    ]
    assert as_set(column_overview(df), "column_name", "row_count", "null_count") == {
        ("a", 3, 0), ("t", 3, 1), ("d", 3, 1), ("f", 3, 1),
    }


def test_profile_table(spark):
    profile = profile_table(frame(spark), ["t"], sample_rows=2)
    assert profile.sample.count() == 2
    assert profile.row_count.first()[0] == 3
    assert as_set(profile.distinct["t"]) == {("x",), (None,), ("10",)}
    stats = {row.summary for row in profile.summary.collect()}
    assert stats == {"count", "mean", "stddev", "min", "max"}


def test_describe_without_number_or_text_column_is_empty(spark):
    dates = spark.sql("SELECT DATE'2024-01-01' AS day")
    got = describe_columns(dates)
    assert got.count() == 0
    assert got.columns == ["column_name", "count", "mean", "stddev", "min", "max"]
