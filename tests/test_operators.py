"""Small cases of the operators that the queries do not single out."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigstream import schemas
from rigstream.functions import text
from rigstream.operators import decode, energy, reshape, routing
from rigstream.plans import jobs
from rigstream.schemas import LogKeys
from rigstream.sources.messages import read_json_records, spread
from rigstream.sources.readings import DAY_MS, ReadingTable


def _values(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")


def test_maps(spark):
    texts = ['{"a":"1","b":{"c":2},"a":"3"}', "[1]", '{"a":', "{}", '{"a":null}']
    rows = decode.decode_map(_values(spark, texts)).orderBy("n").collect()
    assert [r.fields for r in rows] == [{"a": "3", "b": '{"c":2}'}, {}, {}, {}, {"a": None}]
    kept = decode.non_empty_map(decode.decode_map(_values(spark, texts)))
    assert [r.n for r in kept.orderBy("n").collect()] == [0, 4]


def test_shared_well_filter(spark):
    rows = decode.decode_map(_values(spark, ['{"v.nameWell":"W"}', '{"nameWell":"W"}']))
    assert [r.n for r in decode.has_shared_well(rows, LogKeys("v.").shared_well).collect()] == [0]


def test_vendor_prefix(spark):
    record = {"v.tsds": "12.5", "v.hint": "DEPTHLOG", "nameWell": "W", "nameWellbore": "B", "LogName": "L", "ROP": "7"}
    keys = LogKeys("v.")
    rows = jobs.depth_logs(_values(spark, [json.dumps(record)]), keys, keep=()).collect()
    assert [tuple(r) for r in rows] == [("W", "B", "L", "ROP", "00000012.5", 12.5, 7.0, "7")]
    paid = {**record, "TOR": "1", "RPM": "2", "WOB": "3", "diameter": "4"}
    payload = jobs.specific_energy(_values(spark, [json.dumps(paid)]), keys=keys).first().payload
    value = 480 * 1.0 * 2 / (16 * 7) + 4 * 3.0 / (16 * 3.141592653589793)
    assert json.loads(payload) == {"W": [{"ds": "12.5", "values": {"CALC_MSE@L": pytest.approx(value)}}]}


def test_energy_inputs(spark):
    base = {"LogName": "Log 1", "TOR": "1", "RPM": "2", "ROP": "3", "WOB": "4", "diameter": "5"}
    cases = [
        base, base | {"diameterLog1": "6"}, base | {"diameterLog1": "-9999"}, base | {"diameterLog1": "x"},
        base | {"TOR": "-9999"}, base | {"WOB": "n/a"}, {k: v for k, v in base.items() if k != "RPM"}, base | {"ROP": "0"},
    ]
    rows = energy.add_energy(decode.decode_map(_values(spark, [json.dumps(c) for c in cases]))).orderBy("n").collect()
    assert [r.n for r in rows] == [0, 1, 2, 7]
    assert rows[0].mse == rows[2].mse != rows[1].mse and rows[3].mse == float("inf")
    assert rows[0].fields["CALC_MSE"] == rows[0].mse_key == "CALC_MSE@Log 1"
    assert float(rows[0].fields["CALC_MSE@Log 1"]) == rows[0].mse


def test_screened_casts_equal_plain_casts(spark):
    draw = random.Random(1)
    texts = ["", " ", "1", " 1.5 ", "-2.", ".5", "1e3", "1E-3d", "2f", "n/a", "NaN", "Infinity", "-inf", "+7", "1,5", "0x1p3", "--1", "\t4\n"]
    texts += ["".join(draw.choice("0123456789.eE+-dfxnaiINF ") for _ in range(draw.randint(1, 6))) for _ in range(400)]
    texts += ["nan", "inf", "+infinity", "-Infinity", "finance", "0x", "0x1"]
    # a cast takes other spellings of the special values as well
    special = F.lower(F.trim("value")).rlike("^[-+]?(nan|inf|infinity)$") & ~F.col("value").rlike(r"^\s*[-+]?(NaN|Infinity)\s*$")
    cast = F.when(~special, F.col("value").try_cast("double"))
    rows = _values(spark, texts).select("value", text.parsed_double(F.col("value")).alias("a"), cast.alias("b"))
    assert [r for r in rows.collect() if repr(r.a) != repr(r.b)] == []


def test_text_functions(spark):
    rows = _values(spark, ["1539926210702", "soon", "12", "123456789012", "99999999999999999", None, "-1000"]).select(
        text.event_time(F.col("value")).alias("t"), text.depth_string(F.col("value")).alias("d")
    )
    assert [tuple(r) for r in rows.collect()] == [
        ("2018-10-19T05:16:50Z", "1539926210702"), ("soon", "000000soon"), ("1970-01-01T00:00:00Z", "0000000012"),
        ("1973-11-29T21:33:09Z", "123456789012"), ("3170843-11-07T09:46:39Z", "99999999999999999"), (None, None),
        ("1969-12-31T23:59:59Z", "00000-1000"),
    ]


def test_event_times_of_any_year(spark):
    """Against the calendar of numpy, which has no last year; years before the first count backwards."""
    draw = random.Random(3)
    numbers = [0, -1, 253402300799999, 253402300800000, -62135596800000, -62135596800001, 2**63 - 1, -(2**62)]
    numbers += [draw.randrange(-(2**62), 2**62) >> draw.randrange(0, 40) for _ in range(300)]
    rows = _values(spark, [str(n) for n in numbers]).select("value", text.event_time(F.col("value")).alias("t")).collect()
    for row in rows:
        moment = np.datetime64(int(row.value) // 1000, "s")
        year = int(moment.astype("datetime64[Y]").astype(int)) + 1970
        rest = np.datetime_as_string(moment).split("-", 2 if year > 0 and not str(moment).startswith("-") else 3)[-2:]
        assert row.t == f"{year if year > 0 else 1 - year:04d}-{rest[0]}-{rest[1]}Z", row.value


def test_json_records_name_what_is_wrong(spark, tmp_path):
    lines = ['{"id":"a","ts":"1","bitDepth":2.5}', '{"id":"b","ts":"x","bitDepth":"y"}', "no json", '{"id":"c"}']
    (tmp_path / "a.json").write_text("\n".join(lines))
    fields = {"id": "string", "ts": "bigint", "bitDepth": "double"}
    rows = read_json_records(spark, str(tmp_path), fields, error="why").collect()
    found = sorted((r.id or "", r.ts, r.bitDepth, r.why) for r in rows)
    assert found[0] == ("", None, None, "not a JSON object") and found[1:] == [
        ("a", 1, 2.5, None), ("b", None, None, "ts is not a number"), ("c", None, None, None),
    ]
    assert read_json_records(spark, str(tmp_path), fields).columns == list(fields)


def test_readings_lie_by_day(spark, tmp_path):
    table = ReadingTable(str(tmp_path / "readings"), "id string, ts bigint, x double", parts=4)
    rows = [(f"d{n % 50}" if n % 3 else "hot", n * 3_600_000, float(n)) for n in range(-30, 24 * 20)]
    df = spark.createDataFrame(rows + [(None, 5, 1.0), ("late", None, 2.0)], "id string, ts bigint, x double").repartition(16)
    for batch, part in enumerate((df.where("x < 100 or x is null"), df.where("x >= 100"), df.where("x >= 100"), df.limit(0))):
        table.write_batch(part, min(batch, 1) if batch < 3 else 2)
    files = spark.read.parquet(f"{table.path}/batch_id=1").inputFiles()
    days = [f.split("_day=")[1].split("/")[0] for f in files]
    assert max(days.count(d) for d in set(days)) <= 4
    everything = {tuple(r) for r in table.read(spark).collect()}
    assert everything == {*rows, (None, 5, 1.0)}
    now = 15 * DAY_MS + 12_345
    kept = table.retained(spark, now, days=2)
    assert {tuple(r) for r in kept.collect()} == {r for r in everything if r[1] >= now - 2 * DAY_MS}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan and "_day" in plan
    middle = table.read(spark, 3 * DAY_MS, 5 * DAY_MS - 1)
    assert {r.ts // DAY_MS for r in middle.collect()} == {3, 4}


def test_envelope_filters(spark):
    tags = [("blockPosition", "1", 5, None), ("x", "2", 6, None)]
    rows = spark.createDataFrame(
        [("POST_TELEMETRY", "d", "default", {"a": "1"}, {"deviceName": "D"}, tags), ("GET_ATTRIBUTES", "d", "DrillBit", {}, {}, [])],
        schemas.ENVELOPE_DDL,
    )
    assert routing.message_types(rows, "GET_ATTRIBUTES").count() == 1
    assert routing.device_types(rows, "default", "DrillBit").count() == 2
    assert routing.has_attributes(rows, "a").count() == 1 and routing.has_attributes(rows, a="2").count() == 0
    assert routing.requires_channels(rows, "x", "blockPosition").count() == 1
    assert routing.requires_channels(rows, "x", "y").count() == 0
    assert [r.value for r in routing.block_records(rows).collect()] == ['{"id":"D","ts":"5","blockPosition":1}']


def test_device_records_of_all_topics(spark):
    rig = [(c, str(i), 9, None) for i, c in enumerate(["bitDepth", "holeDepth", "totalPumpOutput", "rotaryRpm", "inSlipStatus"])]
    tags = [("blockPosition", "1.5", 5, None), ("blockPosition", "2.50", 6, None), *rig, ("standpipePressure", None, 9, None)]
    tank = {"tankId": 'T"\\\n', "deviceType": "WaterTank"}
    rows = spark.createDataFrame(
        [
            ("POST_TELEMETRY", "d}", "default", {}, {"deviceName": "D"}, tags),
            ("POST_TELEMETRY", "d", "DrillBit", tank, {}, [("waterTankLevel", "7", 1, None), ("currentRpm", "8", 2, None)]),
            ("POST_ATTRIBUTES", "d", "default", {}, {"deviceName": "D"}, tags),
            ("POST_TELEMETRY", None, None, None, None, None),
        ],
        schemas.ENVELOPE_DDL,
    )
    assert {(r.topic, r.value) for r in routing.device_records(rows).collect()} == {
        ("block", '{"id":"D","ts":"6","blockPosition":2.50}'),
        ("rig", '{"id":"d}","ts":"9","bitDepth":0,"holeDepth":1,"totalPumpOutput":2,"rotaryRpm":3,"inSlipStatus":4}'),
        ("tank", '{"tankId":"T\\"\\\\\\n","ts":"1","waterTankLevel":"7"}'),
        ("rpm", '{"ts":"2","currentRpm":8}'),
    }


def test_retention(spark):
    day = 86_400_000
    rows = spark.createDataFrame([(0,), (day,), (400 * day,)], "ts bigint")
    assert [r.ts for r in routing.retained(rows, 366 * day).collect()] == [day, 400 * day]


def test_json_records_and_spread(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"tankId":"t","ts":"5","waterTankLevel":1.5}\n{"tankId":"u","ts":6,"waterTankLevel":"x"}\n')
    rows = read_json_records(spark, str(tmp_path), schemas.TANK)
    assert sorted(tuple(r) for r in spread(rows).collect()) == [("t", 5, 1.5), ("u", 6, None)]
    assert spread(rows).rdd.getNumPartitions() >= 8
    many = spark.range(100, numPartitions=9)
    assert spread(many) is many


def test_message_defaults(spark):
    record = {"tsds": "1000", "nameWell": "W", "nameWellbore": "B", "Message": "hello"}
    rows = reshape.message_log(decode.decode_map(_values(spark, [json.dumps(record), json.dumps(record | {"LogName": " "})])))
    assert {r.namelog for r in rows.collect()} == {"Log #messages_time"}
