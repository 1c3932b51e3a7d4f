"""Inferred schemas that are kept between runs and grow by new columns."""

from __future__ import annotations

import json
from collections.abc import Callable, Collection
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.widening import is_stored_name, step_of, widest
from gaugeworks.settings import RESERVED_COLUMNS

# Files are compared by their modification time; the overlap allows for clock differences.
_OVERLAP = timedelta(hours=1)


class SchemaStore:
    """One schema below ``path``: numbered versions, none overwritten, and the time seen so far."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.versions = f"{path.rstrip('/')}/schemas"
        self.progress = f"{path.rstrip('/')}/progress"

    def _stored(self, path: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).text(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _latest(self) -> tuple[int, T.StructType | None]:
        stored = self._stored(self.versions, "value string, version int")
        newest = stored and stored.orderBy("version", ascending=False).first()
        if not newest:
            return 0, None
        return newest["version"], T.StructType.fromJson(json.loads(newest["value"]))

    def _seen_until(self) -> str | None:
        stored = self._stored(self.progress, "value string")
        newest = stored and stored.first()
        return newest["value"] if newest else None

    def _write(self, text: str, path: str) -> None:
        line = self.spark.range(1).select(F.lit(text).alias("value")).coalesce(1)
        line.write.mode("overwrite").text(path)

    def load(self) -> T.StructType | None:
        return self._latest()[1]

    def save(self, schema: T.StructType) -> None:
        version = self._latest()[0] + 1
        self._write(json.dumps(schema.jsonValue()), f"{self.versions}/version={version}")

    def evolve(
        self,
        source: str,
        base: T.StructType | None = None,
        sampling_ratio: float = 1.0,
        widen: Callable[[T.StructType], object] | None = None,
    ) -> T.StructType:
        """The schema for the next read of ``source``; new keys are appended and remembered.

        Only files that came since the last call are looked at. A known column whose new values need
        a wider type gets it (see ``functions.widening``); columns of ``base`` are always there and
        keep their type. What still does not fit goes to the rescue column, as do the keys a
        sampling ratio below one may miss, so nothing is lost either way.
        ``widen`` gets the new schema before it is stored: a table that cannot take it leaves
        the stored schema as it was.
        """
        known, seen_until = self.load(), self._seen_until()
        started = datetime.now(UTC) - _OVERLAP
        reader = (
            self.spark.read.option("recursiveFileLookup", "true")
            .option("samplingRatio", sampling_ratio)
            .option("dropFieldIfAllNull", "true")
        )
        if seen_until:
            reader = reader.option("modifiedAfter", seen_until).option("timeZone", "UTC")
        try:
            found = reader.json(source).schema
        except AnalysisException as error:
            # No file is newer than the last look; a missing folder is an error the first time.
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            found = T.StructType([])
        fixed = {f.name.lower() for f in base.fields} if base else set()
        merged = merge_schemas(merge_schemas(known or T.StructType([]), base), found, fixed)
        if merged != known:
            if widen:
                widen(merged)
            self.save(merged)
        self._write(started.strftime("%Y-%m-%dT%H:%M:%S"), self.progress)
        return merged


def merge_schemas(
    known: T.StructType, found: T.StructType | None, fixed: Collection[str] | None = None
) -> T.StructType:
    """``known`` followed by the columns only ``found`` has.

    Columns are told apart without regard to case, as in a table. Reserved names and second
    spellings stay out, so their values go to the rescue column. Known columns but those in
    ``fixed`` (lower case) take the wider type of both; without ``fixed`` all keep theirs.
    """
    names = {f.name.lower() for f in known.fields} | {name.lower() for name in RESERVED_COLUMNS}
    merged = list(known.fields)
    places = {f.name: place for place, f in enumerate(merged)}
    for f in found.fields if found else []:
        if f.name.lower() not in names and not is_stored_name(f.name):
            names.add(f.name.lower())
            merged.append(f)
        elif fixed is not None and f.name in places and f.name.lower() not in fixed:
            place = places[f.name]
            kind = widest(merged[place].dataType, f.dataType)
            if kind is not None and step_of(kind):
                merged[place] = T.StructField(f.name, kind)
    return T.StructType(merged)
