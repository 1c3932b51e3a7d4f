"""A profile made of sketches: parts of a table are profiled once, and their profiles merged.

Row and NULL counts and the smallest and largest values are exact. Distinct values come from a
HyperLogLog sketch, quantiles from a KLL sketch, the commonest values from a frequent-items sketch; all
three are of fixed size and merge without the rows. So a profile of a table that grew reads the
new part only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.settings import BATCH_COLUMN
from gaugeworks.sinks.folds import list_batches
from gaugeworks.sinks.tables import read_batches, write_batch

# Size of the sketches. Relative standard error of the distinct count: 1.04 / sqrt(2^14) = 0.8 %;
# error of a quantile's rank: about 0.4 % of the rows; frequent values: those above 1/1000 of the rows.
DISTINCT_BITS = 14
QUANTILE_K = 800
TOP_ITEMS = 4000

DISTINCT_ERROR = 0.03  # nearly four standard errors
RANK_ERROR = 0.01

_NUMBERS = (T.NumericType,)


def column_sketches(df: DataFrame) -> DataFrame:
    """One row per column with its exact counts and its sketches, from one pass over the rows."""
    facts = [_facts(place, f) for place, f in enumerate(df.schema.fields)]
    return df.agg(F.array(*facts).alias("_facts")).select(F.inline("_facts"))


def _facts(place: int, f: T.StructField) -> Column:
    value = F.col(f"`{f.name}`")
    text = value.cast("string")
    if isinstance(f.dataType, _NUMBERS):
        number = value.cast("double")
        quantiles = F.kll_sketch_agg_double(number, F.lit(QUANTILE_K))
    else:
        number = F.lit(None).cast("double")
        quantiles = F.lit(None).cast("binary")
    # NULL stands for the smallest text of a number and the smallest number of a text.
    words = F.lit(None).cast("string") if isinstance(f.dataType, _NUMBERS) else text
    return F.struct(
        F.lit(place).alias("position"),
        F.lit(f.name).alias("column_name"),
        F.lit(f.dataType.simpleString()).alias("data_type"),
        F.count("*").alias("row_count"),
        F.count_if(value.isNull()).alias("null_count"),
        F.min(number).alias("min_number"),
        F.max(number).alias("max_number"),
        F.min(words).alias("min_text"),
        F.max(words).alias("max_text"),
        F.hll_sketch_agg(text, F.lit(DISTINCT_BITS)).alias("distinct_sketch"),
        quantiles.alias("quantile_sketch"),
        F.call_function("approx_top_k_accumulate", text, F.lit(TOP_ITEMS)).alias("top_sketch"),
    )


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column from the rows of all parts; a merged row merges on like any other."""
    return sketches.groupBy("position", "column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.min("min_number").alias("min_number"),
        F.max("max_number").alias("max_number"),
        F.min("min_text").alias("min_text"),
        F.max("max_text").alias("max_text"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.call_function("approx_top_k_combine", "top_sketch", F.lit(TOP_ITEMS)).alias("top_sketch"),
    )


def read_sketches(
    merged: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), top: int = 10
) -> DataFrame:
    """The figures of a profile: counts, distinct values, quantiles (NULL for text), commonest values."""
    numeric = F.col("data_type").isin("tinyint", "smallint", "int", "bigint", "float", "double")
    numeric = numeric | F.col("data_type").startswith("decimal")
    filled = F.col("row_count") > F.col("null_count")
    shares = F.array(*map(F.lit, quantiles))
    found = F.kll_sketch_get_quantile_double("quantile_sketch", shares)
    return merged.select(
        "position",
        "column_name",
        "data_type",
        "row_count",
        "null_count",
        "min_number",
        "max_number",
        "min_text",
        "max_text",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        F.when(numeric & filled, found).alias("quantiles"),
        F.call_function("approx_top_k_estimate", "top_sketch", F.lit(top)).alias("commonest"),
    )


def profile_store(table: str) -> str:
    return f"{table}__profile"


def update_profile(spark: SparkSession, table: str) -> list[str]:
    """Sketch the batches of a batch-written table that have no sketches yet; returns their names.

    The store holds the sketches of a batch under the batch's own name, so a run that broke off is
    done again without counting a batch twice. Batches may be folded once they are sketched.
    """
    store = profile_store(table)
    fresh = [batch for batch in list_batches(spark, table) if batch not in list_batches(spark, store)]
    for batch in fresh:
        rows = spark.table(table).where(F.col(BATCH_COLUMN) == batch).drop(BATCH_COLUMN)
        write_batch(column_sketches(rows), store, batch)
    return fresh


def stored_profile(spark: SparkSession, table: str) -> DataFrame:
    """The merged sketches of all batches; ``read_sketches`` gives the figures."""
    return merge_sketches(read_batches(spark, profile_store(table)))
