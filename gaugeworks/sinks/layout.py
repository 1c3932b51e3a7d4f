"""Physical layout of stored tables: compaction and multi-column clustering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.curve import as_number, curve_position, curve_range
from gaugeworks.settings import TARGET_FILE_BYTES
from gaugeworks.sinks.versions import overwrite, stored_name

# Bounds are quantiles within 1/accuracy of the exact rank; they only place rows.
_ACCURACY = 10_000
_STEPS = 256
_SPARE_BITS = 5
# Files a core should have to write in a rewrite, and the size that is worth a file of its own.
_TASKS_PER_CORE = 3
_LEAST_FILE_BYTES = 16 * 1024 * 1024
# Bits of a curve position, and of one column's share in it (what a double tells apart).
_CURVE_BITS = 63
_MOST_BITS = 31


def compact(spark: SparkSession, table: str, target_bytes: int = TARGET_FILE_BYTES) -> bool:
    """Rewrite a table into files of about ``target_bytes`` without a shuffle.

    The scan already packs small files into one task up to a size; with that size set to the
    target and one output file per task, reading and writing back is the compaction. Returns
    False, with nothing rewritten, when the table has no more files than that would give.
    """
    path = F.col("_metadata.file_path")
    stored = spark.table(stored_name(spark, table))
    files = stored.select(path.alias("path")).distinct().count()
    if files <= files_needed(spark, table, target_bytes):
        return False
    packing = spark.newSession()
    packing.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    packing.conf.set("spark.sql.files.openCostInBytes", str(64 * 1024))
    packing.conf.set("spark.sql.files.minPartitionNum", "1")
    overwrite(packing.table(table), table)
    return True


def files_needed(spark: SparkSession, table: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    return max(1, -(-stored_bytes(spark, table) // target_bytes))


def files_for_all(spark: SparkSession, table: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Files for a rewrite in which a task writes one: ``files_needed``, and more where those would
    leave cores idle, unless they would fall below ``_LEAST_FILE_BYTES``."""
    busy = _TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    most = min(busy, files_needed(spark, table, _LEAST_FILE_BYTES))
    return max(files_needed(spark, table, target_bytes), most)


def stored_bytes(spark: SparkSession, table: str) -> int:
    """Size of the table's files, from a listing; no rows are read."""
    table = stored_name(spark, table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'")
    return int(detail.first()["data_type"].split()[0])


def lookup_options(distinct: Mapping[str, int]) -> dict[str, str]:
    """Options for writing a table in which single values of some columns are looked up.

    The curve of ``cluster`` orders a few columns; a value of any other is in every file's range. A Bloom
    filter per row group says where it cannot be, so a look-up reads the row groups that have it.
    ``distinct`` gives the distinct values of a row group by column, about; they size the filters.
    """
    options = {}
    for name, values in distinct.items():
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(values)
    return options


def cluster(
    df: DataFrame,
    columns: Sequence[str],
    files: int | None = None,
    bits: int | None = None,
) -> DataFrame:
    """Order ``df`` along a bit-interleaved curve over numeric, date or time ``columns``.

    Rows close in all columns land in the same files, so the min/max statistics of a file let
    a filter on any of them skip it. One aggregation over ``columns`` finds quantiles; a row's
    place between two of them refines its position, so the resolution is not bound to the quantiles.
    A second aggregation, over the same columns alone, finds the positions that split the rows into
    equal ranges, so the whole rows are read once. Rows at one position are told apart by their
    place in the input (which a scan reproduces), so a position that fills several files is spread
    over them.

    ``bits`` per column set the resolution; by default they follow the number of files, with
    ``_SPARE_BITS`` to spare for each column, as finer positions would not part the files better.
    """
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if bits is None and columns:
        bits = -(-files.bit_length() // len(columns)) + _SPARE_BITS
        bits = max(1, min(bits, _MOST_BITS, _CURVE_BITS // len(columns)))
    numbers, bounds = _quantiles(df, columns)
    if not numbers:
        # Without a value to go by, rows are dealt out by their place in the input.
        return df.repartition(files).sortWithinPartitions(*columns) if columns else df.repartition(files)
    bits = bits or max(1, min(_MOST_BITS, _CURVE_BITS // len(numbers)))
    splits = _splits(df.select(curve_position(numbers, bounds, bits).alias("_curve")), files)
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.withColumn("_range", curve_range(numbers, bounds, bits, F.col("_tie"), splits))
    return (
        ranged.drop("_tie")
        .repartitionById(files, F.col("_range.part"))
        .sortWithinPartitions("_range.curve", *columns)
        .select(*df.columns)
    )


def _quantiles(df: DataFrame, columns: Sequence[str]) -> tuple[list[Column], list[list[float]]]:
    """The columns that have any value, as numbers, and ascending bounds of each."""
    if not columns:
        return [], []
    shares = [step / _STEPS for step in range(_STEPS + 1)]
    numbers = {name: as_number(df.schema[name].dataType, name) for name in columns}
    found = df.agg(
        *[F.percentile_approx(numbers[name], shares, _ACCURACY).alias(name) for name in columns]
    ).first()
    used = [name for name in columns if found[name]][:_CURVE_BITS]
    return [numbers[name] for name in used], [sorted(set(found[name])) for name in used]


def _splits(positions: DataFrame, files: int) -> list[int]:
    """The highest position of each of ``files`` ranges of about equal rows."""
    if files == 1:
        return []
    shares = [number / files for number in range(1, files + 1)]
    accuracy = max(_ACCURACY, 10 * files)
    return positions.agg(F.percentile_approx("_curve", shares, accuracy)).first()[0] or []


def cluster_table(
    spark: SparkSession,
    table: str,
    columns: Sequence[str],
    target_bytes: int = TARGET_FILE_BYTES,
    lookups: Mapping[str, int] | None = None,
) -> None:
    """Rewrite ``table`` clustered by ``columns`` in files of about ``target_bytes``.

    ``lookups`` names further columns for ``lookup_options``.
    """
    files = files_needed(spark, table, target_bytes)
    overwrite(cluster(spark.table(table), columns, files), table, **lookup_options(lookups or {}))
