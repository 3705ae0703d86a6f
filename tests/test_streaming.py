"""Stream results against batch results, and replay of micro-batches."""

import json
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigstream.operators import anchors, decode, reshape
from rigstream.plans import jobs
from rigstream.schemas import PRIMARY_KEYS, RIG, TANK
from rigstream.sources.messages import from_kafka, read_messages, read_text
from rigstream.sources.offsets import offsets_reached, starting_offsets, unread
from rigstream.sources.tables import KeyedTable, batch_base
from rigstream.streaming import batches, counts
from rigstream.streaming.late import device_windows, split_late
from rigstream.streaming.rate import KEPT
from rigstream.streaming.state import anchors_kept, with_first_reading_stream

FAR = 10_000_000


def _store(spark, folder, records, files=3):
    """Messages in ``files`` parquet files whose times follow the records' order."""
    os.makedirs(folder)
    size = -(-len(records) // files)
    for part in range(files):
        rows = [
            ("t", at % 2, at, None, json.dumps(record))
            for at, record in list(enumerate(records))[part * size : (part + 1) * size]
        ]
        target = f"{folder}/part-{part}.parquet"
        df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp timestamp, value string")
        df = df.withColumn("timestamp", F.timestamp_millis(F.get_json_object("value", "$.ts").cast("bigint")))
        df.toPandas().astype({"partition": "int32"}).to_parquet(target, coerce_timestamps="us")
        os.utime(target, (1_700_000_000 + part * 10,) * 2)


def _series(fields, seed=5, count=240, step=900, devices=3):
    draw = np.random.default_rng(seed)
    ts, out = 0, []
    for _ in range(count):
        ts += int(draw.integers(1, step))
        out.append({"ts": str(ts)} | {name: make(draw, devices) for name, make in fields.items()})
    return out


def _device(draw, devices):
    return f"d{draw.integers(0, devices)}"


def _level(draw, _):
    return round(float(draw.uniform(0, 100)), 2)


def _run(spark, tmp_path, stream, name):
    query = jobs.start(stream, str(tmp_path / "checkpoint"), name=name)
    query.awaitTermination()
    return spark.table(name)


def _both(spark, tmp_path, records, job, name):
    folder = str(tmp_path / "in")
    _store(spark, folder, records)
    batch = job(read_messages(spark, folder))
    stream = job(read_messages(spark, folder, streaming=True, maxFilesPerTrigger="1"))
    return batch, _run(spark, tmp_path, stream, name)


def _set(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


RIG_FIELDS = {
    "id": _device,
    "bitDepth": lambda d, _: float(d.choice([10, 10.05, 20, 30])),
    "holeDepth": lambda d, _: float(d.choice([10, 40])),
    "totalPumpOutput": lambda d, _: float(d.choice([0, 1])),
    "rotaryRpm": lambda d, _: float(d.choice([0, 2, 9])),
    "inSlipStatus": lambda d, _: int(d.choice([0, 0, 1])),
    "standpipePressure": lambda d, _: float(d.choice([0, 4e6])),
}
BLOCK_FIELDS = {"id": _device, "blockPosition": _level}
TANK_FIELDS = {"tankId": _device, "waterTankLevel": _level}


def test_rig_state(spark, tmp_path):
    batch, stream = _both(spark, tmp_path, _series(RIG_FIELDS), jobs.rig_state, "rig_out")
    got = _set(stream, "device", "ts", "payload")
    assert len(got) == 237 and got == _set(batch, "device", "ts", "payload")


def test_block_movement(spark, tmp_path):
    job = lambda m: jobs.block_movement(m, 1, 4)
    batch, stream = _both(spark, tmp_path, _series(BLOCK_FIELDS), job, "block_out")
    got = _set(stream, "device", "ts", "payload")
    assert len(got) > 50 and got == _set(batch, "device", "ts", "payload")


def _micro_batches(spark, records, fields, pieces=3):
    size = -(-len(records) // pieces)
    for number in range(pieces):
        rows = [tuple(type_(r[name]) for name, type_ in fields.items()) for r in records[number * size : (number + 1) * size]]
        yield number, spark.createDataFrame(rows, list(fields))


@pytest.mark.parametrize("kind", ["rig", "block"])
def test_micro_batch_forms_and_replay(spark, tmp_path, kind):
    kept = {}

    def emit(rows, number):
        kept[number] = sorted(tuple(r) for r in rows.select(*columns).collect())

    state = batches.state_table(str(tmp_path / "state"))
    if kind == "rig":
        fields, columns = RIG_FIELDS, ["id", "ts", "RIGSTATE"]
        run = batches.rig_state_batches(state, emit)
        types = {"id": str, "ts": int} | {n: float for n in RIG_FIELDS if n not in ("id", "inSlipStatus")} | {"inSlipStatus": int}
    else:
        fields, columns = BLOCK_FIELDS, ["id", "ts", "BDIR", "BVEL", "anchor_ts"]
        run = batches.block_batches(state, emit, 1000, 4000)
        types = {"id": str, "ts": int, "blockPosition": float}
    records = _series(fields)
    for number, rows in _micro_batches(spark, records, types):
        run(rows, number)
        first = kept[number]
        run(rows, number)
        assert kept[number] == first
    got = sorted(r for part in kept.values() for r in part)

    _store(spark, str(tmp_path / "in"), records)
    whole = next(_micro_batches(spark, records, types, pieces=1))[1]
    if kind == "rig":
        want = jobs.anchors.rig_state(whole)
    else:
        want = jobs.anchors.block_movement(jobs.anchors.with_moving_anchor(whole, 1000, 4000))
    assert got == sorted(tuple(r) for r in want.select(*columns).collect())


def test_block_batches_ignore_late_readings(spark, tmp_path):
    kept = {}
    run = batches.block_batches(batches.state_table(str(tmp_path / "state")), lambda rows, n: kept.update({n: rows.collect()}), 1000, 4000)
    ddl = "id string, ts bigint, blockPosition double"
    run(spark.createDataFrame([("a", 10_000, 1.0)], ddl), 0)
    run(spark.createDataFrame([("a", 3_000, 9.0), ("a", 12_000, 2.0), ("b", 1, 1.0)], ddl), 1)
    assert kept[0] == []
    assert [(r.id, r.ts, r.BVEL, r.anchor_ts) for r in kept[1]] == [("a", 12_000, 0.5, 10_000)]


@pytest.mark.parametrize("kind", ["rig", "block"])
def test_a_query_starts_from_the_state_of_another(spark, tmp_path, kind):
    """Checkpoint -> table -> new query; and the table of the spread form is read back the same."""
    fields, job, spread = {
        "rig": (RIG_FIELDS, jobs.rig_state, jobs.spread_rig_state),
        "block": (BLOCK_FIELDS, lambda m, initial=None: jobs.block_movement(m, 1, 4, initial=initial), lambda t, e: jobs.spread_block_movement(t, e, 1, 4)),
    }[kind]
    records = _series(fields)
    # each half keeps the order of its readings
    for part, found in enumerate((records[:130], records[130:])):
        _store(spark, str(tmp_path / f"in{part}"), found, files=2)
        _store(spark, str(tmp_path / "all" / str(part)), found, files=1)
    pick = ["device", "ts", "payload"]
    got, initial = [], None
    for part in range(2):
        stream = job(read_messages(spark, str(tmp_path / f"in{part}"), streaming=True, maxFilesPerTrigger="1"), initial=initial)
        checkpoint = str(tmp_path / f"checkpoint{part}")
        jobs.start(stream, checkpoint, name=f"{kind}_part{part}").awaitTermination()
        got += _set(spark.table(f"{kind}_part{part}"), *pick)
        initial = spark.createDataFrame(anchors_kept(spark, checkpoint).collect(), "id string, anchor_ts bigint, anchor_value double")
    whole = read_messages(spark, str(tmp_path / "all" / "*"))
    assert sorted(got) == _set(job(whole), *pick) and len(got) > 50

    kept, emitted = batches.state_table(str(tmp_path / "table")), []
    step = spread(kept, lambda rows, n: emitted.extend(_set(rows, *pick)))
    messages = read_messages(spark, str(tmp_path / "in0"), streaming=True, maxFilesPerTrigger="1")
    jobs.start(messages, str(tmp_path / "spread0"), emit=step).awaitTermination()
    # the second half goes on in keyed state, from the table
    stream = job(read_messages(spark, str(tmp_path / "in1"), streaming=True), initial=kept.read(spark))
    jobs.start(stream, str(tmp_path / "spread1"), name=f"{kind}_from_table").awaitTermination()
    assert sorted(emitted + _set(spark.table(f"{kind}_from_table"), *pick)) == sorted(got)


def test_a_batch_reads_no_more_state_than_one_compaction_leaves(spark, tmp_path):
    kept = batches.state_table(str(tmp_path / "state"))
    types = {"id": str, "ts": int, "blockPosition": float}
    step = batches.in_order(batches.block_batches(kept, lambda rows, n: None, 1000, 4000), batches.compacted(kept, 3))
    for number, rows in _micro_batches(spark, _series(BLOCK_FIELDS, count=80), types, pieces=8):
        step(rows, number)
        read = kept.read_before(spark, number + 1).inputFiles()
        assert len({f.split("/batch_id=")[1].split("/")[0] for f in read if "batch_id=" in f}) <= 2


def test_averages(spark, tmp_path):
    records = _series(TANK_FIELDS) + [{"ts": str(FAR), "tankId": "end", "waterTankLevel": 1.0}]
    job = lambda m: jobs.tank_average(m, "10 seconds", "1 second")
    batch, stream = _both(spark, tmp_path, records, job, "tank_out")
    closed = batch.where(F.col("tankId") != "end")
    got = _set(stream, "tankId", "window_start", "n", "total")
    assert [g[:3] for g in got] == [w[:3] for w in _set(closed, "tankId", "window_start", "n", "total")]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in _set(closed, "tankId", "window_start", "n", "total")])


def test_zone_messages(spark, tmp_path):
    records = _series({"geoZone": _device, "windSpeed": lambda d, _: float(d.integers(0, 64))})
    records += [{"ts": str(FAR), "geoZone": "end", "windSpeed": 1.0}]
    job = lambda m: jobs.zone_average(m, "10 seconds", "1 second")
    batch, stream = _both(spark, tmp_path, records, job, "zone_out")
    got = _set(stream, "window_start", "payload")
    assert len(got) > 5 and got == _set(batch.where(~F.col("payload").contains("end")), "window_start", "payload")


@pytest.mark.parametrize("keys", [None, ["id"]])
def test_running_extrema(spark, tmp_path, keys):
    records = _series({"id": _device, "currentRpm": _level}) + [{"ts": str(FAR), "id": "end", "currentRpm": 50.0}]
    job = lambda m: jobs.rpm_peak_to_peak(m, "10 seconds", keys=keys, watermark="1 second")
    name = "rpm_out" + str(len(keys or []))
    batch, stream = _both(spark, tmp_path, records, job, name)
    got = _set(stream, "device", "ts", "payload")
    assert len(got) > 5 and got == _set(batch.where(F.col("device") != "end"), "device", "ts", "payload")


def test_fill_time(spark, tmp_path):
    records = _series(TANK_FIELDS, step=400) + [{"ts": str(FAR), "tankId": "end", "waterTankLevel": 1.0}]
    job = lambda m: jobs.fill_time(m, 120.0, "20 seconds", "5 seconds", "1 second")
    batch, stream = _both(spark, tmp_path, records, job, "fill_out")
    got = _set(stream, "tankId", "window_start", "ts", "level", "eta", "payload")
    want = _set(batch.where(F.col("tankId") != "end"), "tankId", "window_start", "ts", "level", "eta", "payload")
    assert len(got) > 5 and got == want


def test_merged_instants_in_the_stream_form(spark, tmp_path):
    levels = [(0, 1.0), (1000, 2.0), (1000, 5.0), (3000, 3.0), (9000, 4.0), (9000, 8.0)]
    records = [{"ts": str(t), "tankId": "a", "waterTankLevel": v} for t, v in levels]
    records += [{"ts": str(FAR), "tankId": "end", "waterTankLevel": 1.0}]
    job = lambda m: jobs.fill_time(m, 120.0, "20 seconds", "5 seconds", "1 second")
    batch, stream = _both(spark, tmp_path, records, job, "tie_out")
    want = batch.where(F.col("tankId") == "a").select("ts", "level", "eta", "rate").first()
    got = stream.select("ts", "level", "eta", "rate").collect()
    assert [tuple(r)[:3] for r in got] == [tuple(want)[:3]] and want.level == 4.0
    assert got[0].rate == pytest.approx(want.rate, rel=1e-12)


def test_the_rate_of_a_dense_slice_needs_bounded_state(spark, tmp_path):
    """One reading per millisecond, out of order between batches; against the batch form, and the state in between."""
    draw = np.random.default_rng(2)
    ts = np.arange(1_000, 7_000)
    draw.shuffle(ts)
    records = [{"ts": str(t), "tankId": "a", "waterTankLevel": float(draw.integers(0, 64))} for t in ts.tolist()]
    records += [{"ts": "6999", "tankId": "a", "waterTankLevel": 70.0}, {"ts": "1000", "tankId": "b", "waterTankLevel": 1.0}]
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    _store(spark, folder, records, files=4)

    sunk = []
    emit = lambda rows, n: sunk.extend(rows.collect())

    def job():
        messages = read_messages(spark, folder, streaming=True, maxFilesPerTrigger="1")
        return jobs.fill_time(messages, 120.0, "20 seconds", "10 seconds", "30 seconds")

    jobs.start(job(), checkpoint, emit=emit).awaitTermination()
    held = spark.read.format("statestore").option("stateVarName", "readings").option("operatorId", 1).load(checkpoint).collect()
    assert sunk == [] and 1_000 < len(held) <= 2 * KEPT + 1
    batch = jobs.fill_time(read_messages(spark, folder), 120.0, "20 seconds")
    _store(spark, str(tmp_path / "end"), [{"ts": str(FAR), "tankId": "end", "waterTankLevel": 1.0}], files=1)
    os.rename(str(tmp_path / "end" / "part-0.parquet"), f"{folder}/part-9.parquet")
    jobs.start(job(), checkpoint, emit=emit).awaitTermination()
    got = sorted((r.tankId, r.window_start, r.ts, r.level, r.eta) for r in sunk)
    assert got == _set(batch, "tankId", "window_start", "ts", "level", "eta") and len(got) == 2
    rates = {r.tankId: r.rate for r in sunk}
    assert all(rates[r.tankId] == pytest.approx(r.rate, rel=1e-12) for r in batch.collect())


def test_late_readings_are_handed_on(spark, tmp_path):
    """Every reading is counted in a window of its device or handed on as late."""
    draw = np.random.default_rng(4)
    records = []
    for at in range(600):
        ts = at * 100 - int(draw.choice([0, 0, 0, 500, 4_000, 30_000]))
        records.append({"ts": str(max(ts, 0)), "tankId": f"d{draw.integers(0, 3)}", "waterTankLevel": float(draw.integers(0, 9))})
    records += [{"ts": str(FAR), "tankId": f"d{n}", "waterTankLevel": 0.0} for n in range(3)]
    _store(spark, str(tmp_path / "in"), records, files=6)
    windows, late = [], []
    emit = split_late(lambda rows, n: windows.extend(rows.collect()), lambda rows, n: late.extend(rows.collect()))
    messages = read_messages(spark, str(tmp_path / "in"), streaming=True, maxFilesPerTrigger="1")
    rows = device_windows(jobs._records(messages, TANK), "tankId", "waterTankLevel", "ts", "2 seconds", "1 second")
    jobs.start(rows, str(tmp_path / "checkpoint"), emit=emit).awaitTermination()

    want, gone, clocks, size = {}, [], {}, -(-len(records) // 6)
    for begin in range(0, len(records), size):
        before = dict(clocks)
        for r in records[begin : begin + size]:
            ts, tank = int(r["ts"]), r["tankId"]
            start = ts // 2_000 * 2_000
            if tank in before and start + 2_000 <= before[tank] - 1_000:
                gone.append((tank, ts, r["waterTankLevel"]))
                continue
            clocks[tank] = max(clocks.get(tank, 0), ts)
            want.setdefault((tank, start), []).append(r["waterTankLevel"])
    want = {k: v for k, v in want.items() if k[1] + 2_000 <= clocks[k[0]] - 1_000}
    assert {(r.tankId, r.window_start): (r.total, r.n) for r in windows} == {k: (sum(v), len(v)) for k, v in want.items()}
    assert sorted((r.tankId, r.late_ts, r.late_value) for r in late) == sorted(gone) and len(gone) > 50
    # the far readings' windows stay open
    assert sum(r.n for r in windows) + len(late) == len(records) - 3


def test_counts_are_taken_while_a_batch_runs(spark, tmp_path):
    records = _series(TANK_FIELDS, count=90)
    for at in range(0, 90, 9):
        records[at]["waterTankLevel"] = "broken"
    _store(spark, str(tmp_path / "in"), records)
    listener = counts.gather(spark)
    try:
        messages = read_messages(spark, str(tmp_path / "in"), streaming=True, maxFilesPerTrigger="1")
        rows = counts.observed_decode(decode.decode_record(decode.non_blank(messages), TANK))
        rows = counts.observed(rows, "written", high=F.count_if(F.col("waterTankLevel") > 50))
        jobs.start(rows, str(tmp_path / "checkpoint"), name="counted").awaitTermination()
        found = spark.table("counted")
        deadline = time.time() + 30
        while listener.total("counted", "written") < found.count() and time.time() < deadline:
            time.sleep(0.2)
        assert [listener.total("counted", "decode", c) for c in ("rows", "quarantined")] == [90, 10]
        assert listener.total("counted", "written") == found.count() == 80
        assert listener.total("counted", "written", "high") == found.where("waterTankLevel > 50").count()
        assert {b for q, n, b in listener.counts if (q, n) == ("counted", "decode") and listener.counts[q, n, b]["rows"]} == {0, 1, 2}
    finally:
        spark.streams.removeListener(listener)


def test_a_job_keeps_models(spark, tmp_path):
    records = _series(TANK_FIELDS, count=300, step=500)
    _store(spark, str(tmp_path / "in"), records, files=3)
    kept, models = batches.sums_table(str(tmp_path / "kept"), "tankId"), batches.models_table(str(tmp_path / "models"), "tankId")
    told = {}
    emit = lambda rows, n: told.update({n: {(r.tankId, r.step): r.forecast for r in rows.collect()}})
    step = jobs.keep_level_models(kept, models, 1, 1, emit, slice_ms=20_000, compact_every=2)
    messages = read_messages(spark, str(tmp_path / "in"), streaming=True, maxFilesPerTrigger="1")
    jobs.start(messages, str(tmp_path / "checkpoint"), emit=step).awaitTermination()
    assert len(told) == 3
    batch = read_messages(spark, str(tmp_path / "in"))
    want = {(r.tankId, r.step): r.forecast for r in jobs.level_forecast(batch, 1, 1, slice_ms=20_000).collect()}
    assert told[max(told)] == pytest.approx(want, rel=1e-6) and len(want) == 15
    again = jobs.level_forecast(batch, 1, 1, stored_models=models.read(spark), slice_ms=20_000)
    assert {(r.tankId, r.step): r.forecast for r in again.collect()} == pytest.approx(want, rel=1e-6)


def _log(depth, **channels):
    return {"nameWell": "W1", "nameWellbore": "WB", "LogName": "L", "tsds": depth, "hint": "DEPTHLOG"} | channels


def test_keyed_table_replay_and_compaction(spark, tmp_path):
    table = KeyedTable.named("depth_log", str(tmp_path), order=("offset",))
    assert table.keys == PRIMARY_KEYS["depth_log"] and table.buckets == 4
    folder = str(tmp_path / "in")
    _store(spark, folder, [_log("1", ROP="5"), _log("1", ROP="6"), _log("2", ROP="7"), _log("1", ROP="8", GR="x")], files=2)
    stream = jobs.depth_logs(read_messages(spark, folder, streaming=True, maxFilesPerTrigger="1"))
    jobs.start(stream, str(tmp_path / "checkpoint"), emit=batches.upsert_into(table)).awaitTermination()

    def state(df):
        return sorted((r.depthstring, r.mnemonic, r.value_str, r.value) for r in df.collect())

    want = [("0000000001", "GR", "x", 0.0), ("0000000001", "ROP", "8", 8.0), ("0000000002", "ROP", "7", 7.0)]
    assert state(table.read(spark)) == want
    again = jobs.depth_logs(read_messages(spark, folder)).where(F.col("offset") >= 2)
    base = batch_base(spark, str(tmp_path / "checkpoint"))
    table.write_batch(again, base + 1)
    assert state(table.read(spark)) == want
    assert state(table.read_before(spark, base + 1)) == [("0000000001", "ROP", "6", 6.0)]
    assert table.read_before(spark, base) is None
    assert table.compact(spark) == base + 1 and table.compact(spark) == base + 1
    assert state(table.read(spark)) == want
    wells = [(9, f"W{n}", "WB", "L", "ROP", "0000000009", 9.0, 1.0, "1") for n in range(2, 22)]
    newer = spark.createDataFrame(wells, again.schema)
    table.write_batch(newer, base + 2)
    assert len(state(table.read(spark))) == 23 and len(state(table.read_before(spark, base + 2))) == 3
    found = [len(state(table.read_bucket(spark, b))) for b in range(4)]
    assert sum(found) == 23 and min(found) > 0


def test_offset_ledger(spark, tmp_path):
    ledger = KeyedTable.named("offsetmgr", str(tmp_path), order=("offsetid",))
    messages = spark.createDataFrame([("t", 0, 4), ("t", 0, 9), ("t", 1, 2), ("u", 0, 0)], "topic string, partition int, offset bigint")
    run = batches.skip_empty(batches.record_offsets(ledger, "G"))
    run(messages, 0)
    run(messages.where("offset > 100"), 1)
    assert json.loads(starting_offsets(ledger.read(spark), "t", "G")) == {"t": {"0": 10, "1": 3}}
    assert starting_offsets(ledger.read(spark), "t", "other") == "latest"
    assert offsets_reached(messages, "G").count() == 3


@pytest.mark.parametrize("compact", [False, True])
def test_a_lost_checkpoint_loses_no_row(spark, tmp_path, monkeypatch, compact):
    table = KeyedTable.named("depth_log", str(tmp_path / "tables"))
    clock = iter([1_000, 2_000])
    monkeypatch.setattr("rigstream.sources.tables.time.time", lambda: next(clock))
    for run, records in enumerate([[_log("1", ROP="5"), _log("2", ROP="7")], [_log("1", ROP="6"), _log("3", ROP="9")]]):
        folder = str(tmp_path / f"in{run}")
        _store(spark, folder, records, files=1)
        stream = jobs.depth_logs(read_messages(spark, folder, streaming=True))
        jobs.start(stream, str(tmp_path / f"checkpoint{run}"), emit=batches.upsert_into(table)).awaitTermination()
        if compact:
            table.compact(spark)
    found = {r.depthstring: r.value for r in table.read(spark).collect()}
    assert found == {"0000000001": 6.0, "0000000002": 7.0, "0000000003": 9.0}


def test_recorded_messages_are_resumed_from_the_ledger(spark, tmp_path):
    """Stopped after some files, its checkpoint lost: the next query reads what no earlier one has, of all partitions."""
    ledger = KeyedTable.named("offsetmgr", str(tmp_path / "tables"), order=("offsetid",))
    folder, read = str(tmp_path / "in"), []
    records = [_log(str(n), ROP=str(n)) for n in range(40)]
    _store(spark, str(tmp_path / "all"), records, files=4)
    os.makedirs(folder)

    def run(number):
        messages = unread(read_messages(spark, folder, streaming=True, maxFilesPerTrigger="1"), ledger.read(spark), "G")
        emit = batches.in_order(lambda rows, n: read.extend((r.partition, r.offset) for r in rows.collect()), batches.record_offsets(ledger, "G"))
        jobs.start(messages, str(tmp_path / f"checkpoint{number}"), emit=batches.skip_empty(emit)).awaitTermination()

    for number, files in enumerate(([0], [1, 2], [3])):
        for file in files:
            os.link(f"{tmp_path}/all/part-{file}.parquet", f"{folder}/part-{file}.parquet")
        run(number)
        assert sorted(read) == sorted((at % 2, at) for at in range(10 * (max(files) + 1)))
    assert json.loads(starting_offsets(ledger.read(spark), "t", "G")) == {"t": {"0": 39, "1": 40}}
    assert unread(read_messages(spark, folder), ledger.read(spark), "other").count() == 40


def test_tables_and_ledger_before_the_first_row(spark, tmp_path):
    ledger = KeyedTable.named("offsetmgr", str(tmp_path), order=("offsetid",))
    assert ledger.read(spark).columns == ["topic_name", "group_id", "partition", "offsetid"]
    assert starting_offsets(ledger.read(spark), "t", "G", range(2)) == "latest"
    messages = spark.createDataFrame([("t", 1, 4)], "topic string, partition int, offset bigint")
    run = batches.record_offsets(ledger, "G")
    run(messages.limit(0), 0)
    assert ledger.read(spark).collect() == []
    run(messages, 1)
    assert json.loads(starting_offsets(ledger.read(spark), "t", "G", range(3))) == {"t": {"0": -1, "1": 5, "2": -1}}
    assert KeyedTable.named("well", str(tmp_path)).read(spark).collect() == []


def test_readings_of_the_first_instant_are_kept_by_all_forms(spark, tmp_path):
    levels = {"a": [(1, 3.0), (1, 3.0), (1, 5.0), (2, 4.0)], "b": [(7, 1.0)]}
    rows = [(k, t, v, 9.0, 1.0, 0.0, 0, 0.0) for k, found in levels.items() for t, v in found]
    rows += [(None, t, 1.0, 9.0, 1.0, 0.0, 0, 0.0) for t in (1, 2)]
    readings = spark.createDataFrame(rows, ", ".join(f"{name} {kind}" for name, kind in RIG.items()))
    want = [("a", 1, 3.0), ("a", 1, 5.0), ("a", 2, 4.0)]
    pick = lambda df: sorted((r.id, r.ts, r.bitDepth) for r in df.collect())
    assert pick(anchors.with_first_reading(readings)) == want
    emitted = []
    step = batches.rig_state_batches(batches.state_table(str(tmp_path / "state")), lambda df, n: emitted.extend(pick(df)))
    step(readings, 0)
    assert sorted(emitted) == want
    readings.write.parquet(str(tmp_path / "in"))
    stream = with_first_reading_stream(spark.readStream.schema(readings.schema).parquet(str(tmp_path / "in")), tie=["bitDepth"])
    query = jobs.start(stream, str(tmp_path / "c"), name="first_instant")
    query.awaitTermination()
    assert pick(spark.table("first_instant")) == want


def test_quarantine_holds_what_a_job_leaves_out(spark):
    texts = ['{"id":"a","ts":1,"bitDepth":"x"}', '{"id":"a","ts":2}', "no json", ""]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    bad = {r.value for r in jobs.quarantine(messages, RIG, zero_missing=True).collect()}
    assert bad == {texts[0], texts[2]}


def test_attribute_tables_and_ledger_in_one_stream(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "tables")
    base = {"nameWell": "W", "nameWellbore": "B", "nameRig": "R", "timeZone": "UTC", "statusWell": "active"}
    _store(spark, folder, [base | {"state": "TX"}, base | {"nameRig": "R2"}, base | {"state": "OK"}, {"nameWell": "V"}], files=2)
    ledger = KeyedTable.named("offsetmgr", root, order=("offsetid",))
    emit = batches.skip_empty(batches.in_order(batches.upsert_attributes(root), batches.record_offsets(ledger, "ATTRIBUTE")))
    messages = read_messages(spark, folder, streaming=True, maxFilesPerTrigger="1")
    jobs.start(messages, str(tmp_path / "checkpoint"), emit=emit).awaitTermination()
    wells = KeyedTable.named("well", root).read(spark).collect()
    assert [(r.namewell, r.state, r.surface_latitude) for r in wells] == [("W", "OK", "")]
    assert sorted(r.namerig for r in KeyedTable.named("rig", root).read(spark).collect()) == ["R", "R2"]
    assert KeyedTable.named("wellbore", root).read(spark).count() == 1
    assert json.loads(starting_offsets(ledger.read(spark), "t", "ATTRIBUTE")) == {"t": {"0": 3, "1": 4}}


def test_sources_share_one_layout(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.txt").write_text('{"id":"1"}\n\n{"id":"2"}\n')
    lines = read_text(spark, str(tmp_path / "lines"), "topic-a")
    raw = spark.createDataFrame(
        [("t", 0, 1, b"key", bytearray(b"text"))], "topic string, partition int, offset bigint, key binary, value binary"
    ).withColumn("timestamp", F.current_timestamp())
    kafka = from_kafka(raw)
    assert lines.columns == kafka.columns == ["topic", "partition", "offset", "timestamp", "value"]
    assert sorted(r.value for r in lines.collect()) == ["", '{"id":"1"}', '{"id":"2"}']
    assert kafka.first().value == "text"


def test_attributes_and_trajectory_jobs(spark):
    records = [
        {"nameWell": "W", "nameWellbore": "B", "nameRig": "R", "timeZone": "UTC", "statusWell": "active", "ownerRig": "O"},
        {"nameWell": "W", "nameWellbore": "", "nameRig": "R"},
        {"nameWellbore": "B"},
    ]
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "offset bigint, value string")
    found = jobs.attributes(rows)
    assert {name: df.count() for name, df in found.items()} == {"well": 1, "wellbore": 1, "rig": 2}
    stations = [
        {"nameWell": "W", "nameWellbore": "B", "nameTrajectory": "T", "nameTrajectoryStn": "S", "mdValue": text}
        for text in ("", "1.5", "deep")
    ]
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(stations)], "offset bigint, value string")
    good, bad = reshape.split_trajectory(jobs.trajectories(rows))
    assert sorted(r.mdvalue for r in good.collect()) == [0.0, 1.5] and bad.count() == 1
