"""File sources: incremental JSON, snapshots, whitespace-delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.settings import MAX_BATCH_BYTES, PAYLOAD_COLUMNS


def stream_lines(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int = MAX_BATCH_BYTES,
    **options: str,
) -> DataFrame:
    """Lines of the files below ``path`` as a stream (value, source_file_path).

    The checkpoint of the query that reads it remembers the files already taken. Where files
    pile up, pass ``cleanSource="archive"`` and ``sourceArchiveDir`` to move those that are
    done out of the folder, so that listing it stays cheap.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true").options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return _lines(reader.text(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same lines from all files at once."""
    return _lines(spark.read.option("recursiveFileLookup", "true").text(path))


def stream_archive(
    spark: SparkSession, table: str, max_bytes: int = MAX_BATCH_BYTES
) -> DataFrame:
    """Archived messages as a stream of lines, for the same ingestion as files."""
    return _lines(spark.readStream.option("maxBytesPerTrigger", max_bytes).table(table))


def _lines(frame: DataFrame) -> DataFrame:
    return frame.select("value", F.col("_metadata.file_path").alias("source_file_path"))


def read_snapshot(
    spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | str | None = None
) -> DataFrame:
    """One exported snapshot: JSON lines, CSV with header, or Parquet."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", str(schema is None))
    return reader.load(path)


def read_fields(
    spark: SparkSession, path: str, columns: Sequence[str] = PAYLOAD_COLUMNS
) -> DataFrame:
    """Numbers separated by white space, no header; fields beyond ``columns`` are ignored."""
    bare = F.regexp_replace("value", r"^\s+|\s+$", "")
    lines = spark.read.text(path).select(bare.alias("_line")).where(F.length("_line") > 0)
    return lines.select(F.split("_line", r"\s+").alias("_fields")).select(
        *[
            F.get("_fields", F.lit(place)).cast("double").alias(name)
            for place, name in enumerate(columns)
        ]
    )
