"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is cut at its own quantiles into 2^bits steps; the cell a row falls into has a place on
the Hilbert curve, rows are ordered by it, and the order is cut into shards of equal counts. Neighbours
on the curve are near in every dimension, so each shard spans a small range of all of them and files
are pruned by any.

A row's place is counted, not sorted globally: rows per cell, then rows per bucket of a cell (buckets
by a hash, as many as the cell's rows ask for), and a row number only inside a bucket. A cell that
holds a third of all rows is thus spread like any other.

DataFrame functions throughout.

Edge cases: NULL in a dimension is the lowest step; NULL text has size 0 and no checksum bytes;
equal rows get places of their own, spread over buckets by their place in the input; very long texts
count by their size alone; an empty table gives an empty result. Other columns are kept, one named like
a new one as ``<name>_in``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import OWN, set_aside, small, written

# Steps per dimension (2^BITS) and rows per bucket, about.
BITS = 4
BUCKET_ROWS = 50_000


def with_rank(rows: DataFrame, column: str, rank: str) -> DataFrame:
    """Adds the number of rows whose value of a string column is smaller, NULL for NULL.

    Whole strings are ranked: the distinct ones are counted and split by ranges; the counts of the
    ranges before, and a running sum within each, make the rank. The table of ranks is broadcast
    only where it is small.
    """
    value, part = f"{OWN}value", f"{OWN}part"
    counts = written(
        rows.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(value))
        .agg(F.count("*").alias("n"))
        .repartitionByRange(value)
        .withColumn(part, F.spark_partition_id()),
        "hilbert-values",
    )
    sums = {row[part]: row["n"] for row in counts.groupBy(part).agg(F.sum("n").alias("n")).collect()}
    before, total = [], 0
    for number in sorted(sums):
        before += [F.lit(number), F.lit(total).cast("long")]
        total += sums[number]
    inside = Window.partitionBy(part).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.create_map(*before)[F.col(part)] if before else F.lit(0).cast("long")
    ranks = written(
        counts.select(
            value, (offset + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias(rank)
        ),
        "hilbert-ranks",
    )
    return rows.join(
        small(ranks, ranks.count()), F.col(column) == F.col(value), "left"
    ).drop(value)


def hilbert_index(cell: Column, dimensions: int, bits: int) -> Column:
    """The place on the curve of a cell whose steps are packed ``bits`` at a time, first
    dimension highest.

    The usual transformation by coordinate exchanges, on an array of coordinates: from the highest bit
    down the lower bits are inverted or swapped, then the array is Gray-decoded and interleaved.
    """
    coordinates = F.array(
        *(
            F.shiftright(cell, bits * (dimensions - 1 - d)).bitwiseAND((1 << bits) - 1).cast("long")
            for d in range(dimensions)
        )
    )
    state = coordinates

    def bound(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]

    def exchange(d: int, bit: int):
        low = F.lit((1 << bit) - 1).cast("long")

        def step(x: Column) -> Column:
            swap = x[0].bitwiseXOR(x[d]).bitwiseAND(low)
            inverted = F.transform(
                x, lambda v, k: F.when(k == 0, v.bitwiseXOR(low)).otherwise(v)
            )
            swapped = F.transform(
                x, lambda v, k: F.when((k == 0) | (k == d), v.bitwiseXOR(swap)).otherwise(v)
            )
            return F.when(F.shiftright(x[d], bit).bitwiseAND(1) == 1, inverted).otherwise(
                swapped if d else x
            )

        return step

    for bit in range(bits - 1, 0, -1):
        for d in range(dimensions):
            state = bound(state, exchange(d, bit))
    gray = bound(
        state,
        lambda x: F.array(
            *(
                _xor([x[k] for k in range(d + 1)])
                for d in range(dimensions)
            )
        ),
    )

    def untwisted(x: Column) -> Column:
        last = x[dimensions - 1]
        twist = F.lit(0).cast("long")
        for bit in range(bits - 1, 0, -1):
            twist = twist.bitwiseXOR(
                F.when(F.shiftright(last, bit).bitwiseAND(1) == 1, F.lit((1 << bit) - 1)).otherwise(0)
            )
        return F.transform(x, lambda v: v.bitwiseXOR(twist))

    final = bound(gray, untwisted)

    def interleaved(x: Column) -> Column:
        total = F.lit(0).cast("long")
        for bit in range(bits - 1, -1, -1):
            for d in range(dimensions):
                total = total * 2 + F.shiftright(x[d], bit).bitwiseAND(1)
        return total

    return bound(final, interleaved)


def _xor(values: list[Column]) -> Column:
    total = values[0]
    for value in values[1:]:
        total = total.bitwiseXOR(value)
    return total


def assign_shards(
    rows: DataFrame,
    dimensions: dict[str, Column],
    shards: int = 24,
    bits: int = BITS,
    tie: list[str] | None = None,
    shard_column: str = "shard",
    slot_column: str = "slot",
) -> DataFrame:
    """Adds the shard (0 to ``shards`` - 1; counts at most one apart) and the gapless place in it.

    ``dimensions`` are numeric columns by name; ``tie`` names the columns that order rows of a cell.
    """
    steps, own = 1 << bits, [f"{OWN}d{k}" for k in range(len(dimensions))]
    if bits * len(dimensions) > 14:
        raise ValueError("at most 2^14 cells: fewer bits or dimensions")
    tie = tie or rows.columns
    rows = set_aside(rows, shard_column, slot_column)
    base = written(
        rows.withColumns(dict(zip(own, dimensions.values(), strict=True))).withColumn(
            f"{OWN}place", F.monotonically_increasing_id()
        ),
        "hilbert-rows",
    )
    tie = [*tie, f"{OWN}place"]
    places = [k / steps for k in range(1, steps)]
    cuts = base.agg(*(F.percentile_approx(name, places, 10_000).alias(name) for name in own)).first()
    cell = F.lit(0)
    for name in own:
        below = sum(
            # Repeated cuts count as often as they are there: few values still take all steps.
            ((F.col(name) > cut).cast("int") for cut in cuts[name] or ()), F.lit(0)
        )
        cell = cell * steps + F.coalesce(below, F.lit(0))
    celled = base.withColumn(f"{OWN}cell", cell).withColumn(
        f"{OWN}hash", F.xxhash64(*tie)
    )
    # At most 2^14 rows: one per cell that is in use.
    cells = written(
        celled.groupBy(f"{OWN}cell")
        .agg(F.count("*").alias("n"))
        .withColumn("curve", hilbert_index(F.col(f"{OWN}cell"), len(own), bits))
        .withColumn("before", F.sum("n").over(Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)))
        .select(
            f"{OWN}cell",
            F.coalesce("before", F.lit(0)).alias(f"{OWN}cell_before"),
            F.ceil(F.col("n") / BUCKET_ROWS).alias(f"{OWN}buckets"),
        ),
        "hilbert-cells",
    )
    total = base.count()
    placed = celled.join(F.broadcast(cells), f"{OWN}cell").withColumn(
        f"{OWN}bucket", F.pmod(f"{OWN}hash", f"{OWN}buckets")
    )
    bucket = [f"{OWN}cell", f"{OWN}bucket"]
    in_cell = Window.partitionBy(f"{OWN}cell").orderBy(f"{OWN}bucket")
    buckets = written(
        placed.groupBy(*bucket)
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(in_cell.rowsBetween(Window.unboundedPreceding, -1)))
        .select(*bucket, F.coalesce("before", F.lit(0)).alias(f"{OWN}bucket_before")),
        "hilbert-buckets",
    )
    inside = Window.partitionBy(*bucket).orderBy(*tie)
    ranked = (
        placed.join(buckets, bucket)
        .withColumn(f"{OWN}in", F.row_number().over(inside))
        .withColumn(
            f"{OWN}rank",
            (F.col(f"{OWN}cell_before") + F.col(f"{OWN}bucket_before") + F.col(f"{OWN}in") - 1).cast(
                "long"
            ),
        )
    )
    # Shard s holds the ranks from ceil(s * total / shards) on.
    shard = F.expr(f"CAST(({OWN}rank * {shards}) DIV {max(total, 1)} AS INT)")
    start = F.expr(f"({shard_column} * CAST({total} AS BIGINT) + {shards - 1}) DIV {shards}")
    return (
        ranked.withColumn(shard_column, shard)
        .withColumn(slot_column, F.col(f"{OWN}rank") - start)
        .drop(*own, *bucket, f"{OWN}place", f"{OWN}hash", f"{OWN}cell_before", f"{OWN}buckets")
        .drop(f"{OWN}bucket_before", f"{OWN}in", f"{OWN}rank")
    )
