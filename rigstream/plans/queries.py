"""The registered queries: every operator over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rigstream import fixtures, schemas
from rigstream.functions.payloads import flat_json
from rigstream.operators import (
    aggregates, anchors, decode, energy, forecast, payload_tables, rate, reshape, routing,
)
from rigstream.plans import jobs
from rigstream.session import ensure_checkpoint_dir, materialised
from rigstream.sources.offsets import offsets_reached, unread
from rigstream.sources.readings import ReadingTable
from rigstream.sources.tables import BATCHES_PER_RUN, KeyedTable, latest_rows
from rigstream.streaming import batches

Query = Callable[[SparkSession, str], DataFrame]

DAY = "1 day"
DAY_MS = 86_400_000
BLOCK_MIN_MS = 1_000
BLOCK_MAX_MS = 14_400_000
TANK_LIMIT = 60.0
AS_OF = "2024-02-01 00:00:00"
RETENTION_AS_OF_MS = 1_737_331_200_000
REUSE_BEFORE_MS = 1_705_795_200_000
DIGITS = 8

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _round(name: str) -> Column:
    return F.round(name, DIGITS).alias(name)


# ------------------------------------------------------------------ rig state


@query
def rig_state(spark, sf_dir):
    rows = anchors.rig_state(fixtures.rig(spark, sf_dir), tie=fixtures.RIG_TIE)
    return rows.select("id", "ts", *fixtures.RIG_TIE, "RIGSTATE")


@query
def rig_state_counts(spark, sf_dir):
    rows = anchors.rig_state(fixtures.rig(spark, sf_dir), tie=fixtures.RIG_TIE)
    return rows.groupBy("RIGSTATE").agg(F.count(F.lit(1)).alias("n"))


@query
def rig_state_previous(spark, sf_dir):
    rows = anchors.rig_state(
        fixtures.rig(spark, sf_dir), tie=fixtures.RIG_TIE, reference="previous", slice_ms=90 * DAY_MS
    )
    return rows.select("id", "ts", *fixtures.RIG_TIE, "RIGSTATE")


@query
def rig_substatus(spark, sf_dir):
    paired = anchors.with_first_reading(fixtures.rig(spark, sf_dir), tie=fixtures.RIG_TIE)
    return anchors.rig_statuses(paired).select(
        "id", "ts", *fixtures.RIG_TIE, "pipe_direction", "pump_status", "top_drive_status", "bit_on_bottom"
    )


# ------------------------------------------------------------------ block position


def _paired_blocks(spark, sf_dir) -> DataFrame:
    return anchors.with_moving_anchor(fixtures.block(spark, sf_dir), BLOCK_MIN_MS, BLOCK_MAX_MS)


@query
def block_anchor(spark, sf_dir):
    return _paired_blocks(spark, sf_dir).select("id", "ts", "blockPosition", "anchor_ts", "anchor_value")


@query
def block_dir_vel(spark, sf_dir):
    moved = anchors.block_movement(_paired_blocks(spark, sf_dir))
    return moved.select("id", "ts", "BDIR", "BDIRTEXT", "BVEL")


# ------------------------------------------------------------------ averages


def _tank_averages(spark, sf_dir) -> DataFrame:
    return aggregates.windowed_average(fixtures.tank(spark, sf_dir), "tankId", "waterTankLevel", "ts", DAY)


def _wind_averages(spark, sf_dir) -> DataFrame:
    return aggregates.windowed_average(fixtures.wind(spark, sf_dir), "geoZone", "windSpeed", "ts", DAY)


@query
def tank_avg(spark, sf_dir):
    return _tank_averages(spark, sf_dir).select("tankId", "window_start", _round("average"))


@query
def wind_avg(spark, sf_dir):
    return _wind_averages(spark, sf_dir).select("geoZone", "window_start", _round("average"), "n")


@query
def avg_rollup(spark, sf_dir):
    rolled = aggregates.roll_up(_tank_averages(spark, sf_dir), ["tankId"])
    return rolled.select("tankId", _round("total"), "n", _round("average"))


# ------------------------------------------------------------------ extrema


def _rpm_extrema(spark, sf_dir, keys=None) -> DataFrame:
    return aggregates.window_extrema(fixtures.rpm(spark, sf_dir), "currentRpm", "ts", "1 hour", keys)


def _torque_extrema(spark, sf_dir, keys=None) -> DataFrame:
    return aggregates.window_extrema(fixtures.torque(spark, sf_dir), "currentTorque", "ts", "1 hour", keys)


def _spread(extrema: DataFrame, prefix: str) -> DataFrame:
    out = aggregates.peak_to_peak(extrema, prefix)
    return out.select("window_start", "id", "ts", prefix, prefix + "MAX", prefix + "MIN")


@query
def rpm_p2p_running(spark, sf_dir):
    return _spread(aggregates.running_extrema(_rpm_extrema(spark, sf_dir)), "RPMP2P")


@query
def rpm_p2p_window(spark, sf_dir):
    return _spread(_rpm_extrema(spark, sf_dir), "RPMP2P")


@query
def torque_p2p_running(spark, sf_dir):
    return _spread(aggregates.running_extrema(_torque_extrema(spark, sf_dir)), "TRQP2P")


@query
def torque_p2p_by_device(spark, sf_dir):
    return _spread(aggregates.running_extrema(_torque_extrema(spark, sf_dir, ["id"]), ["id"]), "TRQP2P")


@query
def rpm_extreme_rows(spark, sf_dir):
    rows = aggregates.extreme_rows(fixtures.rpm(spark, sf_dir), "currentRpm", ["currentRpm", "ts", "id"])
    return rows.select(
        F.col("highest.id").alias("max_id"), F.col("highest.ts").alias("max_ts"), F.col("highest.currentRpm").alias("max_rpm"),
        F.col("lowest.id").alias("min_id"), F.col("lowest.ts").alias("min_ts"), F.col("lowest.currentRpm").alias("min_rpm"),
    )


@query
def first_rows(spark, sf_dir):
    rows = aggregates.first_row(fixtures.rpm(spark, sf_dir), ["id", "ts", "currentRpm"], ["ts", "id"], ["id"])
    return rows.select("first.*")


@query
def record_count(spark, sf_dir):
    return aggregates.record_count(decode.tank_series(fixtures.tank(spark, sf_dir), "8"))


# ------------------------------------------------------------------ level series


def _tank_rates(spark, sf_dir) -> DataFrame:
    return rate.running_rate(fixtures.tank(spark, sf_dir), "tankId", "waterTankLevel", "ts", DAY)


@query
def tank_rate(spark, sf_dir):
    return _tank_rates(spark, sf_dir).select("tankId", "window_start", "ts", F.round("rate", 9).alias("rate"), "level")


@query
def tank_eta(spark, sf_dir):
    return rate.time_to_fill(_tank_rates(spark, sf_dir), TANK_LIMIT).select("tankId", "window_start", "ts", "eta")


@query
def tank_series(spark, sf_dir):
    return aggregates.window_series(fixtures.tank(spark, sf_dir), "tankId", "waterTankLevel", "ts", DAY)


@query
def tank_vector(spark, sf_dir):
    series = aggregates.window_series(fixtures.tank(spark, sf_dir), "tankId", "waterTankLevel", "ts", DAY)
    vector = aggregates.series_vector(series, "tankId", "waterTankLevel", part_rows=2)
    text = F.array_join(F.transform("values", lambda v: v.cast("string")), ",")
    return vector.select("tankId", "window_start", "part", text.alias("vector"))


@query
def tank_lines(spark, sf_dir):
    return decode.as_text_line(decode.tank_series(fixtures.tank(spark, sf_dir)), "tankId", "ts", "waterTankLevel")


# ------------------------------------------------------------------ sliding windows


@query
def rpm_p2p_sliding(spark, sf_dir):
    extrema = aggregates.window_extrema(fixtures.rpm(spark, sf_dir), "currentRpm", "ts", "3 hours", slide="2 hours")
    return _spread(extrema, "RPMP2P")


@query
def torque_p2p_sliding_by_device(spark, sf_dir):
    extrema = aggregates.window_extrema(fixtures.torque(spark, sf_dir), "currentTorque", "ts", "36 hours", ["id"], slide="1 day")
    return _spread(extrema, "TRQP2P")


@query
def tank_rate_sliding(spark, sf_dir):
    rates = rate.running_rate(fixtures.tank(spark, sf_dir), "tankId", "waterTankLevel", "ts", "36 hours", slide="1 day")
    return rates.select("tankId", "window_start", "ts", F.round("rate", 9).alias("rate"), "level")


@query
def tank_series_sliding(spark, sf_dir):
    return aggregates.window_series(fixtures.tank(spark, sf_dir), "tankId", "waterTankLevel", "ts", "36 hours", slide="1 day")


# ------------------------------------------------------------------ well logs


def _maps(df: DataFrame) -> DataFrame:
    return decode.non_empty_map(decode.decode_map(decode.non_empty(df)))


def _energies(spark, sf_dir) -> DataFrame:
    return energy.energies(_maps(fixtures.witsml_mse(spark, sf_dir)))


@query
def mse(spark, sf_dir):
    rows = _energies(spark, sf_dir).select("l_orderkey", "l_linenumber", "mse_key", "mse")
    finite = F.when(F.col("mse") < float("inf"), F.round("mse", 6))
    return rows.select("l_orderkey", "l_linenumber", "mse_key", finite.alias("mse"), F.isnull(finite).alias("unbounded"))


@query
def mse_payload(spark, sf_dir):
    rounded = _energies(spark, sf_dir).withColumn("mse", F.round("mse", 3))
    return energy.energy_payload(rounded).select("payload")


@query
def depth_log(spark, sf_dir):
    return reshape.depth_log(_maps(fixtures.witsml_depth(spark, sf_dir)))


@query
def time_log(spark, sf_dir):
    return reshape.time_log(_maps(fixtures.witsml_time(spark, sf_dir)))


@query
def message_log(spark, sf_dir):
    return reshape.message_log(_maps(fixtures.witsml_message(spark, sf_dir)))


@query
def trajectory(spark, sf_dir):
    return reshape.trajectory(_maps(fixtures.witsml_trajectory(spark, sf_dir)), _as_of())


@query
def attr_well(spark, sf_dir):
    return reshape.wells(_maps(fixtures.attribute(spark, sf_dir)), _as_of())


@query
def attr_wellbore(spark, sf_dir):
    return reshape.wellbores(_maps(fixtures.attribute(spark, sf_dir)), _as_of())


@query
def attr_rig(spark, sf_dir):
    return reshape.rigs(_maps(fixtures.attribute(spark, sf_dir)), _as_of())


@query
def upsert_latest(spark, sf_dir):
    rows = reshape.depth_log(_maps(fixtures.witsml_depth(spark, sf_dir)), keep=("seq",))
    return latest_rows(rows, list(schemas.PRIMARY_KEYS["depth_log"]), ["seq", "value", "value_str"])


@query
def upsert_replayed(spark, sf_dir):
    """The depth log through a stored table: two checkpoints' batches, each counted from 0, one replayed, one empty."""
    rows = reshape.depth_log(_maps(fixtures.witsml_depth(spark, sf_dir)), keep=("seq",))
    folder = f"{ensure_checkpoint_dir(spark)}/upsert-{uuid.uuid4().hex}"
    # all batches are taken of these rows, so they are decoded once
    rows.write.parquet(f"{folder}/decoded")
    rows = spark.read.parquet(f"{folder}/decoded")
    table = KeyedTable.named("depth_log", folder, order=("seq", "value", "value_str"))
    part = F.pmod(F.col("seq"), F.lit(2))
    # the second checkpoint starts later and counts from 0 again
    for base, mine in ((BATCHES_PER_RUN, 0), (2 * BATCHES_PER_RUN, 1)):
        table.write_batch(rows.where(part == mine), base, stored=True)
        table.write_batch(rows.limit(0), base + 1, stored=True)
        table.compact(spark)
        table.write_batch(rows.where(part == mine), base, stored=True)
    return table.read(spark)


@query
def offset_ledger(spark, sf_dir):
    return offsets_reached(fixtures.messages(spark, sf_dir), "TIMELOG")


@query
def offsets_unread(spark, sf_dir):
    """What a group whose reading stopped in the middle of every partition has still to read."""
    messages = fixtures.messages(spark, sf_dir)
    ledger = offsets_reached(messages.where(F.col("offset") % 1000 < 500).where(F.col("topic") != "error"), "TIMELOG")
    return unread(messages, ledger, "TIMELOG").select("topic", "partition", "offset")


# ------------------------------------------------------------------ messages


def _rounded_averages(averages: DataFrame) -> DataFrame:
    return averages.withColumn("average", F.round("average", DIGITS))


@query
def payload_tank(spark, sf_dir):
    averages = _rounded_averages(_tank_averages(spark, sf_dir))
    return payload_tables.tank_average_messages(averages, F.col("window_start")).select("payload")


@query
def payload_wind(spark, sf_dir):
    averages = _rounded_averages(_wind_averages(spark, sf_dir))
    return payload_tables.zone_average_messages(averages, F.col("window_start"))


@query
def payload_eta(spark, sf_dir):
    return payload_tables.fill_time_messages(rate.time_to_fill(_tank_rates(spark, sf_dir), TANK_LIMIT)).select("payload")


@query
def payload_rig(spark, sf_dir):
    rows = anchors.rig_state(fixtures.rig(spark, sf_dir), tie=fixtures.RIG_TIE)
    return payload_tables.device_messages(rows, ["RIGSTATE"])


@query
def payload_block(spark, sf_dir):
    moved = anchors.block_movement(_paired_blocks(spark, sf_dir))
    return payload_tables.device_messages(moved, ["BDIR", "BDIRTEXT"])


@query
def payload_kpi(spark, sf_dir):
    spread = _spread(aggregates.running_extrema(_rpm_extrema(spark, sf_dir)), "RPMP2P")
    return payload_tables.device_messages(spread, ["RPMP2PMAX", "RPMP2PMIN"])


@query
def payload_kpi_spread(spark, sf_dir):
    spread = _spread(_rpm_extrema(spark, sf_dir, ["id"]), "RPMP2P").withColumn("RPMP2P", F.round("RPMP2P", 4))
    return payload_tables.device_messages(spread, ["RPMP2P", "RPMP2PMAX", "RPMP2PMIN"])


@query
def payload_velocity(spark, sf_dir):
    moved = anchors.block_movement(_paired_blocks(spark, sf_dir)).withColumn("BVEL", F.round("BVEL", 6))
    return payload_tables.device_messages(moved.where(F.col("BVEL").between(0.001, 9999)), ["BDIR", "BDIRTEXT", "BVEL"])


@query
def payload_announce(spark, sf_dir):
    announced = payload_tables.announce_messages(fixtures.tank(spark, sf_dir), F.concat(F.lit("Tank "), "tankId"))
    averages = _rounded_averages(_tank_averages(spark, sf_dir))
    told = payload_tables.tank_average_messages(averages, F.col("window_start"))
    return payload_tables.announced_first(announced, told)


# ------------------------------------------------------------------ routing


@query
def route_tags(spark, sf_dir):
    rows = routing.route_tags(fixtures.envelopes(spark, sf_dir))
    return rows.select("event_id", F.col("tag.key").alias("key"), "mnemonic", "log_name", "route")


@query
def route_time_logs(spark, sf_dir):
    return routing.log_records(fixtures.envelopes(spark, sf_dir), "time").select("event_id", "value")


@query
def route_depth_logs(spark, sf_dir):
    return routing.log_records(fixtures.envelopes(spark, sf_dir), "depth").select("event_id", "value")


@query
def route_message_logs(spark, sf_dir):
    return routing.log_records(fixtures.envelopes(spark, sf_dir), "message").select("event_id", "value")


@query
def route_mse(spark, sf_dir):
    return routing.mse_records(fixtures.envelopes(spark, sf_dir)).select("event_id", "value")


@query
def route_attributes(spark, sf_dir):
    return routing.attribute_records(fixtures.envelopes(spark, sf_dir)).select("event_id", "value")


@query
def route_trajectory(spark, sf_dir):
    return routing.trajectory_records(fixtures.envelopes(spark, sf_dir)).select("event_id", "value")


@query
def route_device(spark, sf_dir):
    records = routing.device_records(fixtures.envelopes(spark, sf_dir), "tank", "rpm", "block")
    return records.select("topic", "event_id", "value")


@query
def route_rig(spark, sf_dir):
    channels = ["bitDepth", "holeDepth", "totalPumpOutput", "rotaryRpm", "inSlipStatus", "standpipePressure"]
    # a line without tax sends no pump reading and is left out
    sent = {c: F.col(c).cast("string") for c in channels}
    sent["totalPumpOutput"] = F.when(F.col("totalPumpOutput") > 0, F.col("totalPumpOutput").cast("string"))
    tags = F.array(*[F.struct(F.lit(c).alias("key"), v.alias("value"), "ts") for c, v in sent.items()])
    raw = fixtures.rig(spark, sf_dir).select(
        F.lit(routing.TELEMETRY).alias("msgType"), F.lit("default").alias("deviceType"), F.col("id").alias("deviceName"),
        F.expr("map('', '')").alias("cs"), F.expr("map('', '')").alias("ss"),
        F.filter(tags, lambda tag: tag["value"].isNotNull()).alias("tags"),
    )
    decoded = decode.decoded(decode.decode_record(routing.rig_records(raw), schemas.RIG))
    return decoded.select(*schemas.RIG)


@query
def retention(spark, sf_dir):
    rows = fixtures.tank(spark, sf_dir)
    return routing.retained(rows, RETENTION_AS_OF_MS)


@query
def retention_stored(spark, sf_dir):
    """Readings stored by day in two batches, one of them replayed; old days' files are not opened."""
    rows = fixtures.tank(spark, sf_dir)
    table = ReadingTable(f"{ensure_checkpoint_dir(spark)}/readings-{uuid.uuid4().hex}", "tankId string, ts bigint, waterTankLevel double", device="tankId")
    part = F.col("ts") % 2 == 0
    for number, some in enumerate((rows.where(part), rows.where(~part), rows.where(~part))):
        table.write_batch(some, min(number, 1))
    return table.retained(spark, RETENTION_AS_OF_MS)


# ------------------------------------------------------------------ decoding


def _dirty_blocks(spark, sf_dir) -> DataFrame:
    present = decode.non_blank(fixtures.dirty(spark, sf_dir))
    return decode.decode_record(present, schemas.BLOCK, zero_missing=True)


@query
def decode_block(spark, sf_dir):
    return decode.decoded(_dirty_blocks(spark, sf_dir)).select("event_id", "id", "ts", "blockPosition")


@query
def decode_quarantine(spark, sf_dir):
    bad = decode.quarantined(_dirty_blocks(spark, sf_dir))
    return bad.groupBy("value", decode.ERROR).agg(F.count(F.lit(1)).alias("n"))


@query
def decode_maps(spark, sf_dir):
    rows = decode.decode_map(decode.non_empty(fixtures.dirty(spark, sf_dir)))
    return rows.select("event_id", F.size("fields").cast("bigint").alias("n_fields"), F.element_at("fields", "ts").alias("ts_text"))


def _decoded(messages: DataFrame, fields: dict[str, str]) -> DataFrame:
    return decode.decoded(decode.decode_record(decode.non_blank(messages), fields, zero_missing=True))


@query
def decode_tank(spark, sf_dir):
    return _decoded(fixtures.tank_messages(spark, sf_dir), schemas.TANK).select("event_id", *schemas.TANK)


@query
def decode_wind(spark, sf_dir):
    return _decoded(fixtures.wind_messages(spark, sf_dir), schemas.WIND).select("event_id", *schemas.WIND)


@query
def decode_rpm(spark, sf_dir):
    """Records without a device are left out after decoding."""
    rows = _decoded(fixtures.rpm_messages(spark, sf_dir), schemas.RPM)
    return decode.non_null(rows, "id").select("event_id", *schemas.RPM)


@query
def decode_torque(spark, sf_dir):
    rows = _decoded(fixtures.torque_messages(spark, sf_dir), schemas.TORQUE)
    return decode.non_null(rows, "id").select("event_id", *schemas.TORQUE)


@query
def well_present(spark, sf_dir):
    maps = _maps(fixtures.well_messages(spark, sf_dir))
    shared = schemas.LogKeys(prefix="tempus.").shared_well
    return decode.has_shared_well(maps, shared).select("event_id", F.element_at("fields", shared).alias("well"))


@query
def torque_job(spark, sf_dir):
    """From messages to telemetry: the spread of the torque over all devices so far, window by window."""
    return jobs.torque_peak_to_peak(fixtures.torque_messages(spark, sf_dir), "1 hour")


@query
def flat_payload(spark, sf_dir):
    rows = fixtures.block(spark, sf_dir)
    return rows.select("id", flat_json({"ts": F.col("ts"), "blockPosition": F.col("blockPosition")}).alias("payload"))


# ------------------------------------------------------------------ forecasts


def _tank_series(spark, sf_dir, p, q):
    lagged = forecast.lagged_series(fixtures.tank(spark, sf_dir), "tankId", "ts", "waterTankLevel", p, q, 5 * DAY_MS)
    return materialised(lagged)  # fits and forecasts read it several times


def _tank_path(lagged, models, p, q):
    path = forecast.forecast(lagged, models, "tankId", "ts", "waterTankLevel", p, q)
    return path.select("tankId", F.col("step").cast("bigint").alias("step"), F.round("forecast", 6).alias("forecast"), "status")


@query
def ar1_forecast(spark, sf_dir):
    lagged = _tank_series(spark, sf_dir, 1, 0)
    return _tank_path(lagged, forecast.fit(lagged, "tankId", 1, 0), 1, 0)


@query
def arima_forecast(spark, sf_dir):
    lagged = _tank_series(spark, sf_dir, 1, 2)
    return _tank_path(lagged, forecast.fit(lagged, "tankId", 1, 2), 1, 2)


@query
def arima_models(spark, sf_dir):
    lagged = _tank_series(spark, sf_dir, 1, 2)
    usable = forecast.is_usable(forecast.fit(lagged, "tankId", 1, 2))
    return usable.select(
        "tankId", "n", _round("intercept"), F.round(F.get("ar", F.lit(0)), DIGITS).alias("ar1"),
        F.round(F.get("ma", F.lit(0)), DIGITS).alias("ma1"), F.round(F.get("ma", F.lit(1)), DIGITS).alias("ma2"),
        "status", "stationary", "invertible",
    )


@query
def arima_reuse(spark, sf_dir):
    """Models fitted on the readings of the first 20 days are kept where they still serve, then forecast all readings."""
    lagged = _tank_series(spark, sf_dir, 1, 2)
    early = lagged.where(F.col("ts") < F.lit(REUSE_BEFORE_MS))
    stored = forecast.fit(early, "tankId", 1, 2)
    return _tank_path(lagged, forecast.fit_or_reuse(lagged, stored, "tankId", 1, 2), 1, 2)


@query
def arima_models_kept(spark, sf_dir):
    """Models kept over two batches of readings, the second without reading the first, one of them replayed."""
    folder = f"{ensure_checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"
    kept, models = batches.sums_table(f"{folder}/kept", "tankId"), batches.models_table(f"{folder}/models", "tankId")
    step = batches.model_batches(kept, models, "tankId", "ts", "waterTankLevel", 1, 2, 5 * DAY_MS)
    readings = fixtures.tank(spark, sf_dir)
    early = F.col("ts") < F.lit(REUSE_BEFORE_MS)
    for number, part in enumerate((readings.where(early), readings.where(~early), readings.where(~early))):
        step(part, min(number, 1))
    found = models.read(spark)
    return found.select(
        "tankId", "n", F.round("intercept", 5).alias("intercept"), F.round(F.get("ar", F.lit(0)), 5).alias("ar1"),
        F.round(F.get("ma", F.lit(0)), 5).alias("ma1"), F.round(F.get("ma", F.lit(1)), 5).alias("ma2"), "status",
    )
