from __future__ import annotations

import json

import pytest
from conftest import as_list, as_set
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.messages import (
    decode_messages,
    encode_keyed,
    explode_readings,
    parse_json_lines,
)
from gaugeworks.sinks.archive import archive_batch, export_archive, read_archive
from gaugeworks.sources.broker import stream_messages
from gaugeworks.sources.files import read_fields, read_lines, read_snapshot

SCHEMA = (
    T.StructType().add("a", T.DoubleType()).add("b", T.StringType()).add("n", T.IntegerType())
)


def parse(spark, *lines):
    frame = spark.createDataFrame([(text,) for text in lines], "value string")
    return parse_json_lines(frame, SCHEMA)


def rescued(spark, line):
    text = parse(spark, line).first()["_rescued_data"]
    return None if text is None else json.loads(text)


def test_fitting_lines_have_nothing_to_rescue(spark):
    assert rescued(spark, '{"a":1,"b":"x","n":2}') is None
    assert rescued(spark, '{"a":null}') is None
    assert tuple(parse(spark, '{"a":1,"b":"x","n":2}').first())[:3] == (1.0, "x", 2)


def test_unknown_keys_are_rescued(spark):
    assert rescued(spark, '{"a":1,"z":[1,2],"y":"q"}') == {"z": "[1,2]", "y": "q"}
    assert list(rescued(spark, '{"a":1,"z":null}')) == ["z"]


def test_values_of_the_wrong_type_are_rescued_and_the_rest_is_read(spark):
    row = parse(spark, '{"a":"n/a","b":"x","n":1.5}').first()
    assert (row["a"], row["b"], row["n"]) == (None, "x", None)
    assert json.loads(row["_rescued_data"]) == {"a": "n/a", "n": "1.5"}


def test_text_that_is_no_json_is_kept_whole(spark):
    assert rescued(spark, '{"a": 1') == {"_corrupt_record": '{"a": 1'}
    assert rescued(spark, "hello") == {"_corrupt_record": "hello"}


def test_blank_lines_are_skipped(spark):
    assert parse(spark, "", "   ", '{"a":1}').count() == 1


def test_encoding_writes_integer_keys_and_json_nulls(spark):
    rows = [(3.0, None, 1.5), (None, 2.0, 0.1)]
    df = spark.createDataFrame(rows, "engine_id double, x double, y double")
    got = {row.key: json.loads(row.value) for row in encode_keyed(df, "engine_id").collect()}
    assert got == {
        "3": {"engine_id": 3.0, "x": None, "y": 1.5},
        None: {"engine_id": None, "x": 2.0, "y": 0.1},
    }


def test_decoding_reads_bytes_and_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, bytearray(b'{"a": 2}'))], "offset long, value binary")
    assert as_list(decode_messages(df, "a double")) == [(1, 2.0)]


def test_explode_readings(spark):
    text = '[{"sensor":"s1","reading":1.0},{"sensor":"s2","reading":null}]'
    df = spark.createDataFrame([(7, text)], "cycle int, value string")
    got = explode_readings(df, "value")
    assert as_list(got) == [(7, "s1", 1.0, None), (7, "s2", None, None)]


def test_explode_readings_loses_nothing(spark):
    texts = ["[{oops", "[]", None, '[{"sensor":"s1","reading":"hot"}]', '[{"sensor":"s2","more":1}]']
    df = spark.createDataFrame(list(enumerate(texts)), "cycle int, value string")
    got = {row[0]: tuple(row)[1:] for row in explode_readings(df, "value").collect()}
    assert len(got) == 5
    assert got[0] == (None, None, "[{oops")
    assert got[1] == got[2] == (None, None, None)
    assert got[3] == ("s1", None, '{"sensor":"s1","reading":"hot"}')
    assert got[4] == ("s2", None, '{"sensor":"s2","more":1}')


def test_explode_readings_of_mixed_arrays(spark):
    texts = {
        0: '[{"sensor":"a","reading":1},{"sensor":"b","reading":"hot"},{"sensor":"c","reading":2}]',
        1: '[{"sensor":"a"},null,{"reading":3.5}]',
        2: '[1,2]',
        3: '{"sensor":"a","reading":1.0}',
        4: '[{"sensor":{"x":1},"reading":1}]',
        5: '[{"sensor":"a","reading":1},{"sensor":"b","reading":2,"unit":"K"}]',
    }
    df = spark.createDataFrame(list(texts.items()), "n int, value string")
    got = {}
    for row in explode_readings(df, "value").collect():
        got.setdefault(row.n, []).append(tuple(row)[1:])
    assert got[0] == [("a", 1.0, None), ("b", None, '{"sensor":"b","reading":"hot"}'), ("c", 2.0, None)]
    assert got[1] == [("a", None, None), (None, None, None), (None, 3.5, None)]
    assert got[2] == [(None, None, "[1,2]")]
    assert got[3] == [("a", 1.0, None)]
    assert got[4] == [('{"x":1}', 1.0, None)]
    assert got[5] == [("a", 1.0, None), ("b", 2.0, '{"sensor":"b","reading":2,"unit":"K"}')]


def test_decoding_rescues_what_the_schema_cannot_hold(spark):
    texts = ["oops", '{"k":"x","z":2}', '{"k":3}', None, " "]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    got = {r["n"]: (r["k"], r["rest"]) for r in decode_messages(df, "k int", rescued="rest").collect()}
    assert got == {
        0: (None, '{"_corrupt_record":"oops"}'),
        1: (None, '{"k":"x","z":"2"}'),
        2: (3, None),
        3: (None, None),
        4: (None, None),
    }


def test_read_fields_ignores_extra_fields_and_blank_lines(spark, tmp_path):
    (tmp_path / "r.txt").write_text("  1 2.5\t-3   4\n\n\t5 6 7\t\n\t \n8\n")
    got = read_fields(spark, str(tmp_path), ["a", "b", "c"])
    assert as_set(got) == {(1.0, 2.5, -3.0), (5.0, 6.0, 7.0), (8.0, None, None)}


def test_snapshots_in_three_formats(spark, tmp_path):
    df = spark.createDataFrame([("k1", 1), ("k2", None)], "k string, n int")
    for fmt in ("json", "csv", "parquet"):
        writer = df.write.format(fmt)
        (writer.option("header", "true") if fmt == "csv" else writer).save(f"{tmp_path}/{fmt}")
        got = read_snapshot(spark, f"{tmp_path}/{fmt}", fmt)
        assert as_set(got, "k", "n") == {("k1", 1), ("k2", None)}


def test_the_broker_source_needs_its_package(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        stream_messages(spark, "host:9092", "readings", max_offsets=10)


def messages(spark, *rows):
    return spark.createDataFrame(
        [(partition, offset, text.encode()) for partition, offset, text in rows],
        "partition int, offset long, value binary",
    )


def message(engine, cycle, mark):
    return json.dumps({"engine_id": engine, "cycle": cycle, "mark": mark})


def test_archive_keeps_the_last_message_per_engine_and_cycle(spark, names):
    table = names.bronze("raw")
    first = messages(
        spark,
        (0, 1, message(1.0, 1.0, "old")),
        (0, 3, message(1.0, 1.0, "new")),
        (0, 2, message(1.0, 2.0, "only")),
        (1, 1, "broken {"),
        (0, 4, "also broken"),
    )
    archive_batch(first, table, "q-0")
    archive_batch(first, table, "q-0")
    assert spark.table(table).count() == 4
    archive_batch(messages(spark, (0, 9, message(1.0, 2.0, "resent"))), table, "q-1")
    got = read_archive(spark, table)
    assert as_set(got, "engine", "cycle", "offset") == {
        ("1.0", "1.0", 3), ("1.0", "2.0", 9), (None, None, 1), (None, None, 4),
    }
    assert as_set(read_archive(spark, table, "1.0"), "offset") == {(3,), (9,)}
    # A second consumer that starts over stores everything again; readers see no difference.
    archive_batch(first, table, "other-0")
    assert as_list(read_archive(spark, table)) == as_list(got)


def test_archive_exports_a_folder_per_engine(spark, names, tmp_path):
    table = names.bronze("raw")
    rows = [(0, n, message(float(n % 2), float(n), "m")) for n in range(10)]
    archive_batch(messages(spark, *rows), table, "b")
    out = tmp_path / "export"
    export_archive(read_archive(spark, table), str(out))
    assert {p.name for p in out.iterdir() if p.is_dir()} == {"engine=0.0", "engine=1.0"}
    export_archive(read_archive(spark, table, "1.0"), str(out))
    assert read_lines(spark, str(out)).count() == 10
    marks = read_lines(spark, str(out)).select(F.get_json_object("value", "$.cycle").cast("double"))
    assert as_set(marks) == {(float(n),) for n in range(10)}
