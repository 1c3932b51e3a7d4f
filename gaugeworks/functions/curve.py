"""Position of a row on a bit-interleaved curve, for multi-column clustering."""

from __future__ import annotations

import json
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def as_number(kind: T.DataType, name: str) -> Column:
    """A numeric, date or time column as a double that keeps its order."""
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name).cast("timestamp").cast("double")
    return F.col(name).cast("double")


def with_position(
    df: DataFrame, place: str, number: Column, bounds: Sequence[float], bits: int
) -> DataFrame:
    """``df`` plus ``place``: the number's share of the way through the bounds, in 2 ** bits steps.

    Between two ascending bounds the way is linear, so equal counts of rows take equal steps as
    far as the bounds tell. A binary search over one array literal, one projection per step, keeps
    the generated code small. NULL and numbers below the bounds take 0.
    """
    # One literal instead of one per bound.
    values = F.from_json(F.lit(json.dumps([float(bound) for bound in bounds])), "array<double>")
    found = df.withColumn(place, F.lit(0)).withColumn(f"{place}_n", number)
    for step in (1 << bit for bit in reversed(range(len(bounds).bit_length()))):
        above = F.get(values, F.col(place) + F.lit(step - 1)) <= F.col(f"{place}_n")
        moved = F.col(place) + F.when(above, F.lit(step)).otherwise(F.lit(0))
        found = found.withColumn(place, moved)
    low = F.get(values, F.col(place) - 1)
    high = F.get(values, F.col(place))
    within = F.coalesce(
        F.try_divide(F.col(f"{place}_n") - low, high - low), F.lit(0.0)
    )
    share = (F.greatest(F.col(place) - 1, F.lit(0)) + within) / F.lit(float(len(bounds)))
    top = (1 << bits) - 1
    position = F.least(F.floor(share * F.lit(float(1 << bits))), F.lit(top)).cast("long")
    return found.withColumn(place, F.coalesce(position, F.lit(0).cast("long"))).drop(f"{place}_n")


def interleave(buckets: Sequence[Column], bits: int) -> Column:
    """One number from several bucket numbers, taking a bit of each in turn."""
    width = len(buckets)
    spread = [
        F.shiftleft(F.shiftright(bucket, bit).bitwiseAND(F.lit(1)), bit * width + place)
        for bit in range(bits)
        for place, bucket in enumerate(buckets)
    ]
    merged = spread[0]
    for part in spread[1:]:
        merged = merged.bitwiseOR(part)
    return merged


def place_numbers(numbers: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """The places of ``with_position`` for a whole array of numbers; NULL is for the caller."""
    place = np.searchsorted(bounds, numbers, side="right")
    low, high = bounds[np.maximum(place - 1, 0)], bounds[np.minimum(place, len(bounds) - 1)]
    inside = (place > 0) & (place < len(bounds))
    with np.errstate(all="ignore"):
        within = np.where(inside, (numbers - low) / (high - low), 0.0)
        within = np.nan_to_num(within, nan=0.0, posinf=1.0, neginf=0.0)
    share = (np.maximum(place - 1, 0) + within) / len(bounds)
    return np.minimum(np.floor(share * float(1 << bits)).astype(np.int64), (1 << bits) - 1)


def interleave_numbers(places: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """``interleave`` for whole arrays."""
    merged = np.zeros(len(places[0]), dtype=np.int64)
    for bit in range(bits):
        for place, numbers in enumerate(places):
            merged |= ((numbers >> bit) & 1) << (bit * len(places) + place)
    return merged


def _curve_numbers(
    columns: Sequence[pa.Array], bounds: Sequence[np.ndarray], bits: int
) -> np.ndarray:
    places = []
    for column, limits in zip(columns, bounds, strict=True):
        known = column.is_valid().to_numpy(zero_copy_only=False)
        place = place_numbers(column.to_numpy(zero_copy_only=False), limits, bits)
        places.append(np.where(known, place, 0))
    return interleave_numbers(places, bits)


def curve_position(numbers: Sequence[Column], bounds: Sequence[Sequence[float]], bits: int) -> Column:
    """Curve position of a row from doubles and the bounds of each (see ``with_position``).

    The searches run over whole batches of rows; as expressions, of which each row would take a few
    dozen, they cost more than the scan, the shuffle and the write together.
    """
    limits = [np.array(found, dtype=np.float64) for found in bounds]

    @F.arrow_udf(T.LongType())
    def position(*columns: pa.Array) -> pa.Array:
        return pa.array(_curve_numbers(columns, limits, bits))

    return position(*numbers)


def curve_range(
    numbers: Sequence[Column],
    bounds: Sequence[Sequence[float]],
    bits: int,
    tie: Column,
    splits: Sequence[int],
) -> Column:
    """Struct of the curve position and of the range it falls into (``curve``, ``part``).

    ``splits`` are the highest positions of the ranges, ascending; without any there is one range. A
    position that fills several ranges is dealt out over them by ``tie``, a whole number.
    """
    limits = [np.array(found, dtype=np.float64) for found in bounds]
    highest = np.array(splits, dtype=np.int64)

    @F.arrow_udf("struct<curve:long,part:int>")
    def ranged(tie: pa.Array, *columns: pa.Array) -> pa.Array:
        curve = _curve_numbers(columns, limits, bits)
        first = np.searchsorted(highest, curve, side="left")
        after = np.searchsorted(highest, curve, side="right")
        part = first + tie.to_numpy(zero_copy_only=False) % np.maximum(after - first, 1)
        part = np.minimum(part, max(len(highest) - 1, 0))
        return pa.StructArray.from_arrays(
            [pa.array(curve), pa.array(part.astype(np.int32))], ["curve", "part"]
        )

    return ranged(tie, *numbers)
