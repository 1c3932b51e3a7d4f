"""Cleaning of reference snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import first_date, lowered, strict_date, titled, trimmed
from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.settings import DimensionSpec


def clean_dimension(df: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Fill, normalise, type and de-duplicate one snapshot.

    Rows without a key go before the de-duplication, so they are not shuffled. Columns read
    by several date formats move to the end.
    """
    filled = df.fillna(spec.defaults) if spec.defaults else df
    changes = {
        **{name: titled(name) for name in spec.title},
        **{name: lowered(name) for name in spec.lower},
        **{name: trimmed(name) for name in spec.trim},
        **{name: F.col(name).cast(kind) for name, kind in spec.casts.items()},
        **{name: strict_date(name, pattern) for name, pattern in spec.strict_dates.items()},
        **{name: first_date(name, patterns) for name, patterns in spec.lenient_dates.items()},
    }
    leading = [name for name in df.columns if name not in spec.lenient_dates]
    cleaned = filled.withColumns(changes).select(*leading, *spec.lenient_dates)
    return first_per_key(cleaned.where(F.col(spec.key).isNotNull()), [spec.key])


def quality_counts(raw: DataFrame, cleaned: DataFrame, name: str) -> DataFrame:
    """One row: rows read and rows dropped on the way from ``raw`` to ``cleaned``."""
    read = raw.agg(F.count("*").alias("rows_read"), F.lit(0).cast("long").alias("rows_kept"))
    kept = cleaned.agg(F.lit(0).cast("long").alias("rows_read"), F.count("*").alias("rows_kept"))
    both = read.unionByName(kept).agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_kept").alias("rows_kept")
    )
    return both.select(
        F.lit(name).alias("dimension"),
        "rows_read",
        (F.col("rows_read") - F.col("rows_kept")).alias("rows_dropped"),
    )
