"""Catalog tables: namespaces, appends, batches, views.

Tables are stored as Parquet unless another ``fmt`` is given. One table has one kind of
writer: either a streaming file sink or batch writes, never both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeworks.settings import BATCH_COLUMN, SCHEMAS
from gaugeworks.sinks.folds import PLACE_COLUMN, is_folded, read_whole, refresh
from gaugeworks.sinks.quoting import quoted_name, quoted_text, sql_type


class SchemaMismatch(ValueError):
    """The columns of a frame do not fit a strict table."""


@dataclass(frozen=True)
class Namespace:
    """The three schemas of one installation; ``prefix`` keeps installations apart."""

    prefix: str = ""

    def schema(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def bronze(self, table: str) -> str:
        return f"{self.schema('bronze')}.{table}"

    def silver(self, table: str) -> str:
        return f"{self.schema('silver')}.{table}"

    def gold(self, table: str) -> str:
        return f"{self.schema('gold')}.{table}"


def create_namespaces(
    spark: SparkSession, namespace: Namespace = Namespace(), location: str | None = None
) -> Namespace:
    """Create the bronze, silver and gold schemas where missing."""
    for layer in SCHEMAS:
        place = f" LOCATION {quoted_text(f'{location}/{layer}')}" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace.schema(layer)}{place}")
    return namespace


def add_missing_columns(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Add the columns of ``schema`` that ``table`` lacks; older rows read as NULL there."""
    present = {name.lower() for name in spark.table(table).columns}
    missing = [f for f in schema.fields if f.name.lower() not in present]
    if missing:
        columns = ", ".join(f"{quoted_name(f.name)} {sql_type(f.dataType)}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in missing]


def append_strict(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append; a column the table lacks, or one that does not fit its type, is an error."""
    df.write.format(fmt).mode("append").saveAsTable(table)


def append_merging(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append; new columns are added to the table and absent ones are NULL."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        add_missing_columns(spark, table, df.schema)
        df = _aligned(df, spark.table(table).schema)
    df.write.format(fmt).mode("append").saveAsTable(table)


def write_batch(
    df: DataFrame,
    table: str,
    batch: str,
    merge_schema: bool = False,
    few_rows: bool = False,
    fmt: str = "parquet",
) -> bool:
    """Write the rows of one micro-batch into its own partition.

    Writing the same ``batch`` again replaces the partition, so a retry adds nothing; a batch that
    was folded already (see ``sinks.folds``) is left out, and the answer is False. The
    schema is strict unless ``merge_schema``. ``few_rows`` is for results much smaller than
    the batch: they are rebalanced first, else each task of the batch leaves a tiny file.
    """
    spark = df.sparkSession
    if is_folded(spark, table, batch):
        return False
    if not spark.catalog.tableExists(table):
        # Made from the schema alone: an observation on ``df`` counts the first query that ends.
        shape = T.StructType([*df.schema.fields, T.StructField(BATCH_COLUMN, T.StringType())])
        empty = spark.createDataFrame([], shape)
        empty.write.format(fmt).partitionBy(BATCH_COLUMN).saveAsTable(table)
    elif merge_schema and add_missing_columns(spark, table, df.schema):
        refresh(spark, table)
    stored = T.StructType([f for f in spark.table(table).schema if f.name != BATCH_COLUMN])
    if not merge_schema:
        _require_same(df.schema, stored, table)
    rows = _aligned(df, stored)
    if few_rows:
        rows = rows.hint("rebalance")
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH_COLUMN} = {quoted_text(batch)}) "
        "SELECT * FROM {rows}",
        rows=rows,
    )
    return True


def drop_batch(spark: SparkSession, table: str, batch: str) -> None:
    """Remove what an earlier attempt of ``batch`` may have written."""
    if spark.catalog.tableExists(table):
        partition = f"{BATCH_COLUMN} = {quoted_text(batch)}"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition})")


def read_batches(spark: SparkSession, table: str) -> DataFrame:
    """A batch-written table, folded or not, without the batch column."""
    return read_whole(spark, table).drop(PLACE_COLUMN)


def create_tenant_view(
    spark: SparkSession, view: str, table: str, column: str, value: str
) -> DataFrame:
    """A view on the rows of ``table`` that belong to one tenant."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table} "
        f"WHERE {quoted_name(column)} = {quoted_text(value)}"
    )
    return spark.table(view)


def read_if_present(spark: SparkSession, table: str) -> DataFrame | None:
    try:
        return spark.table(table)
    except AnalysisException:
        return None


def _require_same(given: T.StructType, stored: T.StructType, table: str) -> None:
    have = {f.name: f.dataType.simpleString() for f in given}
    want = {f.name: f.dataType.simpleString() for f in stored}
    if have != want:
        raise SchemaMismatch(
            f"{table}: unexpected {sorted(set(have) - set(want))}, "
            f"missing {sorted(set(want) - set(have))}, "
            f"changed {sorted(n for n in have if n in want and have[n] != want[n])}"
        )


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order; absent ones are NULL."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            quoted_name(f.name) if f.name in present
            else f"CAST(NULL AS {sql_type(f.dataType)}) AS {quoted_name(f.name)}"
            for f in schema.fields
        ]
    )

