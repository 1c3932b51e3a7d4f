"""Columns whose type grew: values of all types a column ever had, read as the widest one.

Parquet files keep the type they were written with. When a column needs a wider type, values go on
into a second stored column, named after the first and the type, and no file is rewritten. Readers see
one column: every stored value, cast up.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.sinks.quoting import quoted_name

_STORED = re.compile(r"(.+)__as_(bigint|decimal|double|string)")

# Each number type holds the values of those before it; text holds all.
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType)
_STEPS = ("bigint", "decimal", "double", "string")


def widest(known: T.DataType, found: T.DataType) -> T.DataType | None:
    """The smallest type for the values of both; None if ``known`` is nested and cannot grow.

    As in Spark's own inference a whole number beside a fraction becomes a double.
    """
    if known == found or isinstance(found, T.NullType):
        return known
    if isinstance(known, T.NullType):
        return found
    if isinstance(known, _NUMBERS) and isinstance(found, _NUMBERS):
        kind = _NUMBERS[max(_NUMBERS.index(type(known)), _NUMBERS.index(type(found)))]
        if kind in (T.FloatType, T.DoubleType):
            return T.DoubleType()
        if kind is T.DecimalType:
            return _decimal(known, found)
        return kind() if kind is T.LongType else T.LongType()
    # Objects and arrays beside plain values are read as their JSON text; stored ones stay as they are.
    return None if isinstance(known, (T.StructType, T.ArrayType, T.MapType)) else T.StringType()


def _decimal(known: T.DataType, found: T.DataType) -> T.DecimalType | T.DoubleType:
    """One decimal type for all mixtures, as a column is stored under the name of its type."""
    sizes = [
        (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else (20, 0)
        for kind in (known, found)
    ]
    fits = all(whole <= 20 and scale <= 18 for whole, scale in sizes)
    return T.DecimalType(38, 18) if fits else T.DoubleType()


def step_of(kind: T.DataType) -> str | None:
    """The name of a type that a column can grow to."""
    name = kind.simpleString().split("(")[0]
    return name if name in _STEPS else None


def stored_column(name: str, kind: T.DataType) -> str:
    """Where values of a wider type than the first are stored."""
    return f"{name}__as_{step_of(kind)}"


def is_stored_name(name: str) -> bool:
    """Whether a name is of the form that stored columns have; message keys of it are rescued."""
    return _STORED.fullmatch(name) is not None


def stored_as(rows: DataFrame, stored: T.StructType) -> DataFrame:
    """Parsed rows with each column under the stored name of its type.

    ``stored`` is the schema of the table: a column that it has with another type goes beside it.
    """
    kinds = {f.name.lower(): f.dataType for f in stored.fields}
    columns = []
    for f in rows.schema.fields:
        first = kinds.get(f.name.lower())
        name = f.name if first is None or first == f.dataType else stored_column(f.name, f.dataType)
        columns.append(F.col(quoted_name(f.name)).alias(name))
    return rows.select(*columns)


def read_widest(rows: DataFrame) -> DataFrame:
    """Stored rows with one column for all types it had."""
    names = {name.lower(): name for name in rows.columns}
    grown: dict[str, list[tuple[int, str]]] = {}
    for name in rows.columns:
        match = _STORED.fullmatch(name)
        if match and match[1].lower() in names:
            grown.setdefault(match[1].lower(), []).append((_STEPS.index(match[2]), name))
    if not grown:
        return rows
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    gone = {name for parts in grown.values() for _, name in parts}
    columns = []
    for name in rows.columns:
        if name in gone:
            continue
        parts = [other for _, other in sorted(grown.get(name.lower(), ()), reverse=True)]
        value = F.col(quoted_name(name))
        if parts:
            kind = kinds[parts[0]]
            value = F.coalesce(*(F.col(quoted_name(p)).cast(kind) for p in [*parts, name])).alias(name)
        columns.append(value)
    return rows.select(*columns)
