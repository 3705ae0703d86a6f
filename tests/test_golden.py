"""Known input and output pairs."""

import pytest
from pyspark.sql import functions as F

from rigstream import schemas
from rigstream.functions import drilling
from rigstream.operators import aggregates, anchors, decode, payload_tables, rate

# The golden cases below must hold as they stand.
RIG_CASES = [
    (None, -999.25, -999.25, 200, 150, 0, 243, "Depth Data Issue"),
    (None, 0, 100, 200, 150, 0, 243, "Out of Hole"),
    (10.1, 10, 123, 0.00630802, 1.00, 0, 3447280, "Stationary"),
    (10.1, 10, 123, 0.00630802, 3.45, 0, 3447280, "Rotating"),
    (10.1, 10, 123, 0.00630912, 3.45, 0, 3447480, "Rotating Pumping"),
    (10.1, 10, 123, 0.00630912, 0.98, 0, 3448480, "Pumping"),
    (121, 122.8, 123, 0.00630912, 3.81, 0, 3448480, "Rotary Drilling"),
    (121, 122.86, 123, 0.00630912, 0.8, 0, 3448480, "Slide Drilling"),
    (22, 15, 123, 0.00630912, 0.8, 0, 3448480, "Tripping Out Pumping"),
    (22, 15, 123, 0.00630812, 0.8, 0, 3448480, "Tripping Out"),
    (22, 15, 123, 0.00630812, 4.87, 0, 3448480, "Tripping Out Rotating"),
    (22, 85, 123, 0.00631812, 0.68, 0, 3448480, "Tripping In Pumping"),
    (22, 85, 123, 0.00630012, 0.48, 0, 3448480, "Tripping In"),
    (22, 85, 123, 0.00630702, 4.5, 0, 3448480, "Tripping In Rotating"),
    (22, 85, 123, 0.00630702, 4.5, 1, 3448480, "In Slips"),
    (102, 85, 123, 0.00631902, 4.5, 0, 3448480, "Back Ream"),
    (102, 112, 123, 0.00631902, 4.5, 0, 3448480, "Ream In"),
]
RIG_DDL = (
    "anchor_value double, bitDepth double, holeDepth double, totalPumpOutput double, rotaryRpm double, "
    "inSlipStatus int, standpipePressure double, expected string"
)


def _floats(case):
    return tuple(None if v is None else float(v) for v in case[:5]) + (case[5], float(case[6]), case[7])


def test_rig_labels(spark):
    rows = spark.createDataFrame([_floats(c) for c in RIG_CASES], RIG_DDL)
    for row in anchors.rig_labels(rows).collect():
        assert row.RIGSTATE == row.expected


@pytest.mark.parametrize(
    "text, fields, expected",
    [
        ('{"id":"deviceId", "ts":109898, "currentRpm":25.098}', schemas.RPM, ("deviceId", "109898", 25.098)),
        ('{"id":"deviceId", "ts":109898, "currentTorque":780.098}', schemas.TORQUE, ("deviceId", "109898", 780.098)),
        (
            '{"id":"Block Position 123", "ts":"1539926210702", "blockPosition":37.20034722222222}',
            schemas.BLOCK,
            ("Block Position 123", 1539926210702, 37.20034722222222),
        ),
        (
            '{"id":"Rig State 123", "ts":"1539926210702", "bitDepth":37.20034722222222, "holeDepth":89.3423, '
            '"totalPumpOutput":200, "rotaryRpm":150, "bitOnBottom":1, "inSlipStatus":0, "standpipePressure":243}',
            schemas.RIG,
            ("Rig State 123", 1539926210702, 37.20034722222222, 89.3423, 200.0, 150.0, 0, 243.0),
        ),
    ],
)
def test_decode(spark, text, fields, expected):
    rows = decode.decode_record(spark.createDataFrame([(text,)], "value string"), fields)
    assert tuple(decode.decoded(rows).select(*fields).first()) == expected


@pytest.mark.parametrize(
    "column, values", [("currentRpm", [19.098, 19.056, 18.098, 18.998]), ("currentTorque", [890.98, 990.98, 990.18, 895.58])]
)
def test_extrema(spark, column, values):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], f"id string, ts bigint, {column} double")
    found = aggregates.extreme_rows(rows, column, [column, "ts", "id"]).first()
    assert (found.highest[column], found.lowest[column]) == (max(values), min(values))


@pytest.mark.parametrize("before, after, code, name", [(40.3, 35.3, -1, "down"), (35.3, 40.3, 1, "up"), (40.3, 40.3, 0, "stopped")])
def test_direction(spark, before, after, code, name):
    rows = spark.createDataFrame(
        [("a", 1539926320000, after, 1539926310000, before)],
        "id string, ts bigint, blockPosition double, anchor_ts bigint, anchor_value double",
    )
    found = anchors.block_movement(rows).first()
    assert (found.BDIR, found.BDIRTEXT, found.BVEL) == (code, name, abs(after - before) / 10)


@pytest.mark.parametrize(
    "points, expected",
    [
        ([(1000, 10.0123)], (1000, 0.0, 10.0123)),
        ([(1000, 10.0123), (7000, 10.134), (13000, 10.145)], (13000, 0.011058333333333318, 10.145)),
    ],
)
def test_running_rate(spark, points, expected):
    rows = spark.createDataFrame([("123", *p) for p in points], "tankId string, ts bigint, level double")
    found = rate.running_rate(rows, "tankId", "level", "ts", "1 minute", slices=1).first()
    assert (found.ts, found.rate, found.level) == expected
    cut = rate.running_rate(rows, "tankId", "level", "ts", "1 minute", slices=60).first()
    assert (cut.ts, pytest.approx(cut.rate, rel=1e-14), cut.level) == expected


def test_fill_time_message(spark):
    rows = spark.createDataFrame([("123", 13000, 3458), (" ", 1, 2)], "tankId string, ts bigint, eta bigint")
    found = payload_tables.fill_time_messages(rows).collect()
    assert [r.payload for r in found] == ['{"Tank 123":[{"ts":13000,"values":{"timeToFill":3458}}]}']


def test_series_vector(spark):
    rows = spark.createDataFrame(
        [("123", 13000, 10.145), ("123", 1000, 10.0123), ("123", 7000, 10.134)], "tankId string, ts bigint, level double"
    )
    series = aggregates.window_series(rows, "tankId", "level", "ts", "1 minute")
    assert aggregates.series_vector(series, "tankId", "level").first()["values"] == [10.0123, 10.134, 10.145]
    parts = aggregates.series_vector(series, "tankId", "level", part_rows=2).orderBy("part").collect()
    assert [list(p["values"]) for p in parts] == [[10.0123, 10.134], [10.145]]


NAN = float("nan")


@pytest.mark.parametrize(
    "bit, anchor, hole, pump, pressure, rpm, expected",
    [
        (10.0, 9.9, 10.33, 0.00630902, 3447380.0, 1.05, (0, -1, -1, 1)),
        (10.0, 9.8, 10.329, 0.0063091, 3447380.0, 1.06, (-1, 1, 0, 0)),
        (10.0, 10.2, 9.6953, 0.0063091, 3447379.0, 3.15, (1, 2147483647, 0, 0)),
        (10.0, 10.0, 9.695, 0.0, 0.0, 3.16, (0, -1, 1, -1)),
        (NAN, 10.0, 10.0, NAN, 3447380.0, NAN, (2147483647, 2147483647, 2147483647, 1)),
        (10.0, 10.0, 10.0, 1.0, NAN, 1.0, (0, 2147483647, -1, 0)),
    ],
)
def test_status_bounds(spark, bit, anchor, hole, pump, pressure, rpm, expected):
    rows = spark.createDataFrame(
        [(bit, anchor, hole, pump, pressure, rpm)],
        "bitDepth double, anchor_value double, holeDepth double, totalPumpOutput double, standpipePressure double, rotaryRpm double",
    )
    found = anchors.rig_statuses(rows).first()
    assert (found.pipe_direction, found.pump_status, found.top_drive_status, found.bit_on_bottom) == expected


@pytest.mark.parametrize(
    "level, per_second, limit, expected",
    [
        (10.0, 2.0, 15.0, 2), (15.0, 0.0, 15.0, 0), (16.0, 1.0, 15.0, 0), (10.0, 0.0, 15.0, -1),
        (16.0, -1.0, 15.0, -1), (0.0, 5e-324, 15.0, 9223372036854775807), (NAN, 1.0, 15.0, -1), (1.0, NAN, 15.0, -1),
    ],
)
def test_time_to_limit(spark, level, per_second, limit, expected):
    rows = spark.createDataFrame([(per_second, level)], "rate double, level double")
    assert rate.time_to_fill(rows, limit).first().eta == expected


def test_velocity_below_one_second(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 0, 999), (1.0, 1.0, 0, 999)], "a double, b double, t bigint, u bigint")
    speed = [r.v for r in rows.select(drilling.velocity(F.col("a"), F.col("b"), F.col("t"), F.col("u")).alias("v")).collect()]
    assert speed[0] == float("inf") and speed[1] != speed[1]
