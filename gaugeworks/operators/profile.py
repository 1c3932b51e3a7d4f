"""Exploratory profile of a table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Profile(NamedTuple):
    schema: DataFrame
    sample: DataFrame
    summary: DataFrame
    row_count: DataFrame
    null_counts: DataFrame
    distinct: dict[str, DataFrame]


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs of each column; all NULL for an empty table."""
    return df.agg(*[F.sum(F.col(name).isNull().cast("int")).alias(name) for name in df.columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows (position, column_name, data_type, nullable)."""
    fields = [
        (place, f.name, f.dataType.simpleString(), f.nullable)
        for place, f in enumerate(df.schema.fields)
    ]
    shape = "position int, column_name string, data_type string, nullable boolean"
    return df.sparkSession.createDataFrame(fields, shape)


def column_overview(df: DataFrame) -> DataFrame:
    """The schema with row and NULL counts per column, in one pass over the table."""
    facts = [
        F.struct(
            F.lit(place).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"),
            F.count("*").alias("row_count"),
            F.count_if(F.col(f.name).isNull()).alias("null_count"),
        )
        for place, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*facts).alias("_facts")).select(F.inline("_facts"))


def _number(f: T.StructField) -> Column:
    """The column as a number; text that cannot be one skips the costly failing cast."""
    number = F.col(f.name).try_cast("double")
    if isinstance(f.dataType, T.StringType):
        return F.when(F.col(f.name).rlike(r"(?i)^\s*[-+]?(\d|\.\d|inf|nan)"), number)
    return number


def describe_columns(df: DataFrame) -> DataFrame:
    """``describe`` turned around: one row per column with count, mean, stddev, min and max.

    Covers numeric and text columns, as ``describe`` does; min and max are text. Mean and
    stddev of text that is no number are NULL. Numbers and text are aggregated apart: each
    column is still read once, and text does not keep the numbers from hash aggregation.
    """
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [f for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    parts = [_described(df, fields) for fields in (numeric, text) if fields]
    if not parts:
        shape = "column_name string, count long, mean double, stddev double, min string, max string"
        return df.sparkSession.createDataFrame([], shape)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _described(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    stats = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.count(f.name).alias("count"),
            F.avg(_number(f)).alias("mean"),
            F.stddev(_number(f)).alias("stddev"),
            F.min(f.name).cast("string").alias("min"),
            F.max(f.name).cast("string").alias("max"),
        )
        for f in fields
    ]
    return df.agg(F.array(*stats).alias("_stats")).select(F.inline("_stats"))


def bottom_k(
    df: DataFrame, rows: int, key: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """A sample that depends on the rows alone: those with the smallest digests of ``key``.

    Of equal digests the smallest rows are taken, so neither order nor partitioning matters, and the
    sample of a union is the sample of the parts' samples. With ``by`` so many rows of each group.
    No sort of the table: every task keeps its own smallest rows, and only those meet; a group that
    holds most rows hands on no more of them than any other.
    """
    order = [F.md5(F.concat_ws("|", *(F.col(name).cast("string") for name in key)).cast("binary"))]
    order += [F.col(name) for name in df.columns]
    if not by:
        return df.orderBy(*order).limit(rows)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= rows).drop("_place")


def profile_table(df: DataFrame, categorical: Sequence[str] = (), sample_rows: int = 20) -> Profile:
    """Schema, sample, summary, row count, NULL counts and the values of ``categorical``.

    Each part is a frame of its own and runs only when it is looked at.
    """
    return Profile(
        schema=schema_rows(df),
        sample=df.limit(sample_rows),
        summary=df.describe(),
        row_count=df.agg(F.count("*").alias("row_count")),
        null_counts=null_counts(df),
        distinct={name: distinct_values(df, name) for name in categorical},
    )
