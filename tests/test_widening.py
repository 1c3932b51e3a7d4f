from __future__ import annotations

import json

import pytest
from conftest import as_list, as_set
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.widening import read_widest, widest
from gaugeworks.settings import BRONZE_TELEMETRY
from gaugeworks.sources.files import stream_lines
from gaugeworks.sources.schema_store import SchemaStore, merge_schemas
from gaugeworks.streaming.flows import ingest_stream, stream_table, widening

INT, LONG, DOUBLE, TEXT, FLAG = (
    T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
)
MIXED = T.DecimalType(38, 18)


@pytest.mark.parametrize(
    "known, found, want",
    [
        (LONG, LONG, LONG),
        (INT, LONG, LONG),
        (LONG, DOUBLE, DOUBLE),
        (DOUBLE, LONG, DOUBLE),
        (LONG, T.DecimalType(10, 2), MIXED),
        (MIXED, T.DecimalType(5, 5), MIXED),
        (LONG, T.DecimalType(38, 30), DOUBLE),
        (LONG, TEXT, TEXT),
        (FLAG, LONG, TEXT),
        (LONG, T.NullType(), LONG),
        (T.NullType(), TEXT, TEXT),
        (LONG, T.ArrayType(LONG), TEXT),
        (T.ArrayType(LONG), LONG, None),
        (T.StructType(), TEXT, None),
    ],
)
def test_widest(known, found, want):
    assert widest(known, found) == want


def test_merging_keeps_the_types_of_the_base(spark):
    known = T.StructType.fromDDL("a bigint, b bigint")
    found = T.StructType.fromDDL("a double, b string, a__as_double double, c int")
    assert merge_schemas(known, found).simpleString() == "struct<a:bigint,b:bigint,c:int>"
    grown = merge_schemas(known, found, fixed={"b"})
    assert grown.simpleString() == "struct<a:double,b:bigint,c:int>"


class Stream:
    def __init__(self, spark, names, folder):
        self.spark, self.folder = spark, folder
        self.table = names.bronze(BRONZE_TELEMETRY)
        self.store = SchemaStore(spark, f"{folder}/schema")

    def land(self, name, *rows):
        (self.folder / "in").mkdir(exist_ok=True)
        text = "\n".join(json.dumps(row) for row in rows)
        (self.folder / "in" / name).write_text(text + "\n")
        schema = self.store.evolve(f"{self.folder}/in", widen=widening(self.spark, self.table))
        lines = stream_lines(self.spark, f"{self.folder}/in")
        ingest_stream(lines, self.table, f"{self.folder}/state", schema)

    def read(self):
        return read_widest(self.spark.table(self.table))


def test_values_of_all_types_are_read_as_the_widest(spark, names, tmp_path):
    stream = Stream(spark, names, tmp_path)
    stream.land("1", {"id": 1, "v": 1, "w": True})
    stream.land("2", {"id": 2, "v": 1.5, "w": 3})
    stream.land("3", {"id": 3, "v": "high", "w": False})
    stream.land("4", {"id": 4, "v": 7, "w": None})
    got = stream.read()
    assert dict(got.dtypes)["v"] == "string" and dict(got.dtypes)["id"] == "bigint"
    assert as_set(got, "id", "v", "w") == {
        (1, "1", "true"), (2, "1.5", "3"), (3, "high", "false"), (4, "7", None),
    }
    assert got.where("_rescued_data IS NOT NULL").count() == 0
    assert not [name for name in got.columns if "__as_" in name]


def test_streams_over_the_table_read_the_widest_type_too(spark, names, tmp_path):
    stream = Stream(spark, names, tmp_path)
    stream.land("1", {"id": 1, "v": 1})
    stream.land("2", {"id": 2, "v": 1.5})
    target = f"{tmp_path}/copy"
    rows = stream_table(spark, stream.table).select("id", "v")
    query = (
        rows.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
        .trigger(availableNow=True).start(target)
    )
    query.awaitTermination()
    assert as_list(spark.read.parquet(target), "id", "v") == [(1, 1.0), (2, 1.5)]


def test_objects_beside_numbers_are_read_as_text_and_stored_names_rescued(spark, names, tmp_path):
    stream = Stream(spark, names, tmp_path)
    stream.land("1", {"id": 1, "v": 1, "a__as_double": 2})
    stream.land("2", {"id": 2, "v": {"x": 1}})
    got = {row.id: row for row in stream.read().collect()}
    assert (got[1].v, got[2].v) == ("1", '{"x":1}') and got[2]._rescued_data is None
    assert json.loads(got[1]._rescued_data) == {"a__as_double": "2"}


def test_rows_without_grown_columns_stay_as_they_are(spark):
    rows = spark.range(3).withColumn("lone__as_double", F.lit(1.0))
    assert read_widest(rows).columns == ["id", "lone__as_double"]
