"""Random inputs against plain Python results."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from gaugeworks.functions.messages import parse_json_lines
from gaugeworks.operators.alerts import threshold_alerts
from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.rules import split_by_rules
from gaugeworks.settings import ALERT_SENSORS
from gaugeworks.sinks.archive import keyed_messages, latest_messages


@pytest.fixture(params=[1, 2, 3])
def rng(request):
    return random.Random(request.param)


def test_every_value_is_read_or_rescued(spark, rng):
    schema = T.StructType().add("a", T.DoubleType()).add("b", T.StringType())
    schema = schema.add("n", T.IntegerType())
    values = [None, 1, 2.5, -3, "text", "7", True, [1, 2], {"k": "v"}, 3_000_000_000]
    sent = []
    for number in range(400):
        keys = rng.sample(["a", "b", "n", "x", "y"], rng.randint(0, 5))
        sent.append((number, {key: rng.choice(values) for key in keys}))
    lines = spark.createDataFrame([(n, json.dumps(d)) for n, d in sent], "id int, value string")
    got = {row["id"]: row.asDict() for row in parse_json_lines(lines, schema).collect()}
    assert len(got) == len(sent)
    for number, message in sent:
        row = got[number]
        rescued = json.loads(row["_rescued_data"]) if row["_rescued_data"] else {}
        for key, value in message.items():
            read = key in ("a", "b", "n") and row[key] is not None
            if value is None:
                assert not read
            else:
                assert read != (key in rescued)


def test_split_loses_and_doubles_no_row(spark, rng):
    rows = [
        (
            n,
            rng.choice([None, 1, 2]),
            rng.choice([None, -60.0, -50.0, 10.0]),
            rng.choice([None, -1.0, 0.0, 5.0]),
        )
        for n in range(300)
    ]
    shape = "n int, engine_id int, temp_hpc_out double, physical_core_speed double"
    df = spark.createDataFrame(rows, shape)
    want = {"valid": set(), "quarantined": set(), "unknown": set()}
    for n, engine, temp, speed in rows:
        hits = [engine is None, temp is not None and temp < -50, speed is not None and speed < 0]
        open_ = temp is None or speed is None
        want["quarantined" if any(hits) else "unknown" if open_ else "valid"].add(n)
    split = split_by_rules(df)
    for name, numbers in want.items():
        assert {row.n for row in getattr(split, name).select("n").collect()} == numbers


def test_latest_messages_by_brute_force(spark, rng):
    messages, want = [], {}
    for offset in rng.sample(range(5000), 600):
        engine, cycle = rng.choice([1.0, 2.0, None]), rng.choice([1.0, 2.0, 3.0])
        text = json.dumps({"engine_id": engine, "cycle": cycle, "m": offset})
        messages.append((0, offset, text))
        key = (engine, cycle) if engine is not None else ("own", offset)
        want[key] = max(want.get(key, -1), offset)
    df = spark.createDataFrame(messages, "partition int, offset long, value string")
    latest = latest_messages(keyed_messages(df.repartition(4))).collect()
    assert Counter(row.offset for row in latest) == Counter(want.values())
    assert all(json.loads(row.value)["m"] == row.offset for row in latest)


def test_first_per_key_by_brute_force(spark, rng):
    rows = [(rng.randint(0, 20), rng.choice([None, 1, 2, 3]), rng.choice("abc")) for _ in range(400)]
    want = {}
    for key, number, text in rows:
        rank = (number is not None, number or 0, text)
        if key not in want or rank < want[key][0]:
            want[key] = (rank, (key, number, text))
    df = spark.createDataFrame(rows, "k int, n int, t string").repartition(5)
    got = {tuple(row) for row in first_per_key(df, ["k"]).collect()}
    assert got == {row for _, row in want.values()}


def test_alerts_by_brute_force(spark, rng):
    limits = {sensor: float(rng.randint(0, 5)) for sensor in rng.sample(ALERT_SENSORS, 3)}
    readings = [
        (n, *[rng.choice([None, float(rng.randint(0, 6))]) for _ in ALERT_SENSORS])
        for n in range(200)
    ]
    shape = "engine_id int, " + ", ".join(f"{sensor} double" for sensor in ALERT_SENSORS)
    telemetry = spark.createDataFrame(readings, shape).selectExpr(
        "*", "engine_id AS cycle", "TIMESTAMP'2024-01-01' AS telemetry_timestamp"
    )
    table = spark.createDataFrame(
        [(sensor, limit, "x") for sensor, limit in limits.items()],
        "sensor_name string, critical_limit double, alert_description string",
    )
    want = {
        (n, sensor)
        for n, *values in readings
        for sensor, value in zip(ALERT_SENSORS, values, strict=True)
        if sensor in limits and value is not None and value > limits[sensor]
    }
    got = threshold_alerts(telemetry, table).select("engine_id", "sensor_name").collect()
    assert Counter(map(tuple, got)) == Counter(want)
