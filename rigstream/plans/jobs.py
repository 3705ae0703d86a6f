"""The jobs: each takes a message table, batch or stream, and returns what it publishes or stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from rigstream import schemas
from rigstream.operators import aggregates, anchors, decode, energy, forecast, payload_tables, rate, reshape
from rigstream.operators.energy import EnergyChannels
from rigstream.schemas import LogKeys
from rigstream.sources.tables import KeyedTable, batch_base
from rigstream.streaming import batches, state
from rigstream.streaming.rate import running_rate_stream


# Topic and consumer group of each well-log job, and their batch interval.
WELL_LOG_JOBS = {
    "depth_logs": ("well-log-ds-data", "DEPTHLOG"),
    "time_logs": ("well-log-ts-data", "TIMELOG"),
    "well_messages": ("well-log-msg-data", "MESSAGELOG"),
    "trajectories": ("well-trajectory-data", "TRAJECTORY"),
    "attributes": ("well-attribute-data", "ATTRIBUTE"),
    "specific_energy": ("well-mse-data", "MSE"),
}
WELL_LOG_INTERVAL = "10 seconds"
# Batch intervals of the state jobs.
BLOCK_INTERVAL = "800 milliseconds"
RIG_INTERVAL = "5 seconds"
AVERAGE_WINDOW = "10 seconds"
EXTREMA_WINDOW = "1 minute"


def _records(messages: DataFrame, fields: dict[str, str], zero_missing: bool = False) -> DataFrame:
    blank_free = decode.non_blank(messages)
    return decode.decoded(decode.decode_record(blank_free, fields, zero_missing=zero_missing))


def quarantine(messages: DataFrame, fields: dict[str, str], zero_missing: bool = False) -> DataFrame:
    """The messages that a job over ``fields`` (such as ``schemas.RIG``) leaves out as undecodable.

    Their text and the reason; blank messages are none. Run it as a second query over the same source.
    """
    known = decode.decode_record(decode.non_blank(messages), fields, zero_missing=zero_missing)
    return decode.quarantined(known)


def _maps(messages: DataFrame) -> DataFrame:
    return decode.non_empty_map(decode.decode_map(decode.non_empty(messages)))


# ------------------------------------------------------------------ aggregation jobs


def tank_average(messages: DataFrame, window: str = AVERAGE_WINDOW, watermark: str = "1 minute") -> DataFrame:
    """Mean level per tank and window, with its message, stamped with the window's start."""
    tanks = _records(messages, schemas.TANK, zero_missing=True)
    averages = aggregates.windowed_average(tanks, "tankId", "waterTankLevel", "ts", window, watermark=watermark)
    return payload_tables.tank_average_messages(averages, F.col("window_start"))


def zone_average(messages: DataFrame, window: str = AVERAGE_WINDOW, watermark: str = "1 minute") -> DataFrame:
    """Mean wind speed per zone, one message per window. The record has no time, so the message's is used."""
    zones = _records(messages, schemas.WIND, zero_missing=True).withColumn("ts", F.unix_millis("timestamp"))
    averages = aggregates.windowed_average(zones, "geoZone", "windSpeed", "ts", window, watermark=watermark)
    return payload_tables.zone_average_messages(averages, F.col("window_start"), window=window)


def announce_tanks(messages: DataFrame) -> DataFrame:
    tanks = _records(messages, schemas.TANK, zero_missing=True)
    return payload_tables.announce_messages(tanks, F.concat(F.lit(payload_tables.TANK_PREFIX), "tankId"))


def announce_zones(messages: DataFrame) -> DataFrame:
    return payload_tables.announce_messages(_records(messages, schemas.WIND), F.col("geoZone"))


def _peak_to_peak(
    messages: DataFrame, fields: dict[str, str], value: str, prefix: str, window: str, running: bool,
    keys: list[str] | None, watermark: str,
) -> DataFrame:
    rows = decode.non_null(_records(messages, fields, zero_missing=True), "id")
    extrema = aggregates.window_extrema(rows, value, "ts", window, keys, watermark=watermark)
    if running:
        carry = state.running_extrema_stream if messages.isStreaming else aggregates.running_extrema
        extrema = carry(extrema, keys)
    spread = aggregates.peak_to_peak(extrema, prefix)
    return payload_tables.device_messages(spread, [prefix, prefix + "MAX", prefix + "MIN"])


def rpm_peak_to_peak(
    messages: DataFrame, window: str = EXTREMA_WINDOW, running: bool = True, keys: list[str] | None = None,
    watermark: str = "1 minute",
) -> DataFrame:
    return _peak_to_peak(messages, schemas.RPM, "currentRpm", "RPMP2P", window, running, keys, watermark)


def torque_peak_to_peak(
    messages: DataFrame, window: str = EXTREMA_WINDOW, running: bool = True, keys: list[str] | None = None,
    watermark: str = "1 minute",
) -> DataFrame:
    return _peak_to_peak(messages, schemas.TORQUE, "currentTorque", "TRQP2P", window, running, keys, watermark)


# ------------------------------------------------------------------ comparison jobs


BLOCK_NAMES, RIG_NAMES = ["BDIR", "BDIRTEXT", "BVEL"], ["RIGSTATE"]


def _blocks(messages: DataFrame) -> DataFrame:
    return _records(messages, schemas.BLOCK, zero_missing=True)


def _rigs(messages: DataFrame) -> DataFrame:
    return _records(messages, schemas.RIG, zero_missing=True)


def block_movement(
    messages: DataFrame, min_seconds: int = 1, max_seconds: int = 60, tie: list[str] | None = None, initial: DataFrame | None = None
) -> DataFrame:
    """Direction and velocity of the block. A stream starts from the anchors in ``initial`` (``state.anchors_kept``)."""
    bounds = min_seconds * 1000, max_seconds * 1000
    if messages.isStreaming:
        paired = state.with_moving_anchor_stream(_blocks(messages), *bounds, tie=tie, initial=initial)
    else:
        paired = anchors.with_moving_anchor(_blocks(messages), *bounds, tie=tie)
    return payload_tables.device_messages(anchors.block_movement(paired), BLOCK_NAMES)


def rig_state(messages: DataFrame, tie: list[str] | None = None, initial: DataFrame | None = None) -> DataFrame:
    """The rig's activity label. A stream starts from the first readings in ``initial`` (``state.anchors_kept``)."""
    if messages.isStreaming:
        labelled = anchors.rig_labels(state.with_first_reading_stream(_rigs(messages), tie=tie, initial=initial))
    else:
        labelled = anchors.rig_state(_rigs(messages), tie=tie)
    return payload_tables.device_messages(labelled, RIG_NAMES)


def spread_block_movement(
    kept: KeyedTable, emit: batches.Emit, min_seconds: int = 1, max_seconds: int = 60, tie: list[str] | None = None, compact_every: int = 100
) -> batches.Emit:
    """``block_movement`` as a function for ``start`` over messages, for streams in which one device dominates.

    Its rows are spread over the cluster; the anchors are kept in a table (``batches.state_table``).
    """
    step = batches.block_batches(kept, _named(emit, BLOCK_NAMES), min_seconds * 1000, max_seconds * 1000, tie)
    return batches.in_order(lambda messages, n: step(_blocks(messages), n), batches.compacted(kept, compact_every))


def spread_rig_state(kept: KeyedTable, emit: batches.Emit, tie: list[str] | None = None, compact_every: int = 100) -> batches.Emit:
    """``rig_state`` as a function for ``start`` over messages, for streams in which one device dominates."""
    step = batches.rig_state_batches(kept, _named(emit, RIG_NAMES), tie)
    return batches.in_order(lambda messages, n: step(_rigs(messages), n), batches.compacted(kept, compact_every))


def _named(emit: batches.Emit, names: list[str]) -> batches.Emit:
    return lambda rows, n: emit(payload_tables.device_messages(rows, names), n)


# ------------------------------------------------------------------ tank prediction jobs


def fill_time(
    messages: DataFrame, limit: float, window: str = "1 minute", slice_length: str = "10 seconds",
    watermark: str = "1 minute",
) -> DataFrame:
    """Seconds until each tank is full, from the rate of each window."""
    tanks = decode.tank_series(_records(messages, schemas.TANK, zero_missing=True))
    if messages.isStreaming:
        rates = running_rate_stream(tanks, "tankId", "waterTankLevel", "ts", window, slice_length, watermark)
    else:
        rates = rate.running_rate(tanks, "tankId", "waterTankLevel", "ts", window)
    return payload_tables.fill_time_messages(rate.time_to_fill(rates, limit))


def level_forecast(
    messages: DataFrame, p: int = 1, q: int = 2, steps: int = forecast.FORECAST_STEPS, tank: str | None = None,
    stored_models: DataFrame | None = None, slice_ms: int = 3_600_000,
) -> DataFrame:
    """The next levels of every tank, or of one; a table job, run it on closed windows of a stream."""
    tanks = decode.tank_series(_records(messages, schemas.TANK, zero_missing=True), tank)
    lagged = forecast.lagged_series(tanks, "tankId", "ts", "waterTankLevel", p, q, slice_ms)
    if stored_models is None:
        models = forecast.fit(lagged, "tankId", p, q)
    else:
        models = forecast.fit_or_reuse(lagged, stored_models, "tankId", p, q)
    return forecast.forecast(lagged, models, "tankId", "ts", "waterTankLevel", p, q, steps)


def keep_level_models(
    kept: KeyedTable, models: KeyedTable, p: int = 1, q: int = 2, emit: batches.Emit | None = None,
    steps: int = forecast.FORECAST_STEPS, tank: str | None = None, slice_ms: int = 3_600_000, compact_every: int = 100,
) -> batches.Emit:
    """A function for ``start`` over messages that keeps every tank's model up to date and emits its forecasts.

    ``kept`` (``batches.sums_table``) holds what a refit needs, ``models`` (``batches.models_table``) the models,
    which ``level_forecast`` takes as ``stored_models``.
    """
    step = batches.model_batches(kept, models, "tankId", "ts", "waterTankLevel", p, q, slice_ms, emit, steps)

    def run(messages: DataFrame, n: int) -> None:
        step(decode.tank_series(_records(messages, schemas.TANK, zero_missing=True), tank), n)

    return batches.in_order(run, batches.compacted(kept, compact_every), batches.compacted(models, compact_every))


# ------------------------------------------------------------------ well-log jobs


def specific_energy(
    messages: DataFrame, names: EnergyChannels = EnergyChannels(), keys: LogKeys = LogKeys()
) -> DataFrame:
    return energy.energy_payload(energy.energies(_maps(messages), names, keys))


def depth_logs(messages: DataFrame, keys: LogKeys = LogKeys(), keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    return reshape.depth_log(_maps(messages), keys, keep)


def time_logs(messages: DataFrame, keys: LogKeys = LogKeys(), keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    return reshape.time_log(_maps(messages), keys, keep)


def well_messages(messages: DataFrame, keys: LogKeys = LogKeys(), keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    return reshape.message_log(_maps(messages), keys, keep)


def trajectories(messages: DataFrame, as_of: Column | None = None, keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    return reshape.trajectory(_maps(messages), as_of, keep)


def attributes(
    messages: DataFrame, as_of: Column | None = None, keep: tuple[str, ...] = ("offset",)
) -> dict[str, DataFrame]:
    """The well, wellbore and rig rows of attribute messages."""
    records = _maps(messages)
    return {
        "well": reshape.wells(records, as_of, keep),
        "wellbore": reshape.wellbores(records, as_of, keep),
        "rig": reshape.rigs(records, as_of, keep),
    }


# ------------------------------------------------------------------ running


def start(
    rows: DataFrame, checkpoint: str, emit: batches.Emit | None = None, sink: str = "memory",
    interval: str | None = None, name: str | None = None, **options: str,
) -> StreamingQuery:
    """Run a stream into a ``foreachBatch`` function or a Spark sink, resuming from its checkpoint.

    Without an ``interval`` the available data is processed and the query ends. ``emit`` gets batch
    numbers that keep growing when a checkpoint is lost (``tables.batch_base``).
    """
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    if emit is not None:
        base = batch_base(rows.sparkSession, checkpoint)
        return writer.foreachBatch(lambda batch, batch_id: emit(batch, base + batch_id)).start()
    return writer.format(sink).options(**options).start()
