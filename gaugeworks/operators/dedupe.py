"""One row per key, as aggregations that combine on the map side.

A window or ``dropDuplicates`` by a key that holds a third of the rows would sort or shuffle
all of them into one task. An aggregation sends at most one row per key and map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The smallest row of each key, compared column by column; any rerun keeps the same row.

    NULLs compare lowest. The NULL key is a group like any other.
    """
    keys = list(keys)
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)
