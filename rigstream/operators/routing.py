"""Select raw telemetry envelopes and assemble the per-topic records from their tags.

Everything here is row-local: a message's tags sit in one array, so no shuffle is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rigstream.operators.decode import bound, computed_once, last_wins
from rigstream.schemas import LogKeys

# Message types, key markers and record hints.
TELEMETRY = "POST_TELEMETRY"
DEPTH_TELEMETRY = "POST_TELEMETRY_DEPTH"
ATTRIBUTES = "POST_ATTRIBUTES"
ATTRIBUTE_REQUEST = "GET_ATTRIBUTES"
MESSAGE_MARK = "Message"
TRAJECTORY_MARK = "Traj"
HINTS = {"time": "TIMELOG", "depth": "DEPTHLOG", "message": "MESSAGELOG"}
MSE_CHANNELS = ("ROP", "TOR", "RPM", "WOB")
RETENTION_DAYS = 365


def message_types(df: DataFrame, *wanted: str) -> DataFrame:
    return df.where(F.col("msgType").isin(*wanted))


def device_types(df: DataFrame, *wanted: str) -> DataFrame:
    return df.where(F.col("deviceType").isin(*wanted))


def has_attributes(df: DataFrame, *defined: str, column: str = "cs", **equal: str) -> DataFrame:
    """Keep devices whose attribute map holds all ``defined`` keys and the ``equal`` values."""
    tests = [F.element_at(column, key).isNotNull() for key in defined]
    tests += [F.element_at(column, key) == value for key, value in equal.items()]
    return df.where(reduce(lambda a, b: a & b, tests))


def requires_channels(df: DataFrame, *channels: str) -> DataFrame:
    """Keep messages that carry every one of ``channels``."""
    return df.where(_carries(channels))


def _carries(channels: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.size(_tags_named(channel)) > 0 for channel in channels])


def _tags_named(name: str) -> Column:
    return F.filter("tags", lambda tag: tag["key"] == name)


def mnemonic(key: Column) -> Column:
    return F.substring_index(key, "@", 1)


def log_name(key: Column) -> Column:
    """What follows the first ``@``; null without one."""
    at = F.instr(key, "@")
    return F.when(at > 0, F.substring(key, at + 1, F.length(key)))


def route(msg_type: Column, key: Column) -> Column:
    """The record family a tag belongs to; null for tags that feed no log."""
    return (
        F.when(
            msg_type == TELEMETRY, F.when(key.contains(MESSAGE_MARK), F.lit("message")).otherwise(F.lit("time"))
        )
        .when(
            msg_type == DEPTH_TELEMETRY,
            F.when(key.contains(TRAJECTORY_MARK), F.lit("trajectory")).otherwise(F.lit("depth")),
        )
        .when(msg_type == ATTRIBUTES, F.lit("attribute"))
    )


def route_tags(df: DataFrame) -> DataFrame:
    """One row per tag with its mnemonic, log name and route."""
    rows = df.select("*", F.explode("tags").alias("tag")).drop("tags")
    return rows.withColumns(
        {
            "mnemonic": mnemonic(F.col("tag.key")),
            "log_name": log_name(F.col("tag.key")),
            "route": route(F.col("msgType"), F.col("tag.key")),
        }
    )


def _number_text(value: Column) -> Column:
    """A depth as text, whole depths without a fraction."""
    whole = value.cast("bigint")
    return F.when(value == whole, whole.cast("string")).otherwise(value.cast("string"))


def _log_of(tag: Column) -> Column:
    return F.coalesce(log_name(tag["key"]), F.lit(""))


def _per_log(df: DataFrame, wanted: Column) -> DataFrame:
    """One row per log name among the ``wanted`` tags, with that log's own tags."""

    def grouped(tags: Column) -> Column:
        names = F.array_distinct(F.transform(tags, _log_of))
        return F.transform(
            names, lambda name: F.struct(name.alias("log"), F.filter(tags, lambda tag: _log_of(tag) == name).alias("tags"))
        )

    logs = df.select("*", F.explode(bound(wanted, grouped)).alias("_own"))
    return logs.withColumns({"_log": F.col("_own.log"), "_tags": F.col("_own.tags")}).drop("_own")


def _channel_entries(tags: Column) -> Column:
    return F.transform(tags, lambda tag: F.struct(mnemonic(tag["key"]).alias("key"), tag["value"].alias("value")))


def _record(channels: Column, shared: dict[str, Column]) -> Column:
    """Channels followed by the shared fields, a repeated key keeping its last value."""
    fields = F.map_entries(_literal_map(shared))
    return last_wins(F.concat(_channel_entries(channels), fields))


def _as_message(df: DataFrame, record: Column) -> DataFrame:
    return computed_once(df, "fields", record).withColumn("value", F.to_json("fields"))


def _shared(keys: LogKeys, stamp: Column) -> dict[str, Column]:
    return {
        "LogName": F.col("_log"),
        keys.tsds: stamp,
        "nameWell": F.element_at("cs", "nameWell"),
        "nameWellbore": F.element_at("cs", "nameWellbore"),
    }


def _literal_map(values: dict[str, Column]) -> Column:
    return F.create_map(*[part for name, value in values.items() for part in (F.lit(name), value)])


def log_records(df: DataFrame, kind: str, keys: LogKeys = LogKeys()) -> DataFrame:
    """Time, depth or message log records: one per envelope and log name, as map and JSON text.

    Tags are grouped by their own log name, so a message that mixes logs yields
    one complete record for each.
    """
    source = DEPTH_TELEMETRY if kind == "depth" else TELEMETRY
    picked = message_types(df, source)
    wanted = F.filter("tags", lambda tag: route(F.lit(source), tag["key"]) == kind)
    logs = _per_log(picked, wanted)
    last = F.try_element_at("_tags", F.lit(-1))
    stamp = _number_text(last["ds"]) if kind == "depth" else last["ts"].cast("string")
    shared = _shared(keys, stamp) | {keys.hint: F.lit(HINTS[kind])}
    record = _record(F.col("_tags"), shared)
    return _as_message(logs, record).drop("_tags", "_log")


def mse_records(df: DataFrame, keys: LogKeys = LogKeys()) -> DataFrame:
    """Records for the specific-energy job: its four channels and the device's diameter."""
    picked = message_types(df, DEPTH_TELEMETRY).where(F.element_at("ss", "diameter") != "")
    wanted = F.filter(
        "tags",
        lambda tag: ~tag["key"].contains(TRAJECTORY_MARK) & mnemonic(tag["key"]).isin(*MSE_CHANNELS),
    )
    logs = _per_log(picked, wanted)
    stamp = _number_text(F.try_element_at("_tags", F.lit(-1))["ds"])
    shared = _shared(keys, stamp) | {"diameter": F.element_at("ss", "diameter")}
    record = _record(F.col("_tags"), shared)
    return _as_message(logs, record).drop("_tags", "_log")


def attribute_records(df: DataFrame, keys: LogKeys = LogKeys()) -> DataFrame:
    """All attributes of a device, with the record hint and the shared well name."""
    picked = message_types(df, ATTRIBUTES).where(F.size("tags") > 0)
    entries = F.transform("tags", lambda tag: F.struct(tag["key"].alias("key"), tag["value"].alias("value")))
    shared = {keys.hint: F.lit("ATTRIBUTES")}
    well = {keys.shared_well: F.element_at("cs", "nameWell")}
    record = last_wins(F.concat(F.map_entries(_literal_map(shared)), entries, F.map_entries(_literal_map(well))))
    return _as_message(picked, record)


def trajectory_records(df: DataFrame) -> DataFrame:
    """Trajectory tags hold a whole JSON document as their value."""
    rows = message_types(df, DEPTH_TELEMETRY).select("*", F.explode("tags").alias("_tag"))
    return rows.where(F.col("_tag.key").contains(TRAJECTORY_MARK)).withColumn("value", F.col("_tag.value")).drop("_tag")


def _json_text(text: Column) -> Column:
    """``text`` as a JSON string literal; null stays null."""
    return F.when(text.isNotNull(), F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1))


def _device_value(id_value: Column, id_field: str, channels: tuple[str, ...], quoted: bool) -> Column:
    """A flat device record of ``channels`` as JSON, stamped with the first channel's time.

    Readings go out bare, as they came, or as text if ``quoted``. A missing id or value leaves its field out.
    """
    found = {channel: F.try_element_at(_tags_named(channel), F.lit(-1)) for channel in channels}
    fields = {id_field: _json_text(id_value), "ts": _json_text(found[channels[0]]["ts"].cast("string"))}
    fields |= {name: _json_text(tag["value"]) if quoted else tag["value"] for name, tag in found.items()}
    written = [F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *written), F.lit("}"))


def _device_topics() -> dict[str, tuple[Column, Column, str, tuple[str, ...], bool]]:
    """Per topic: which messages go there, the device's id and its field, the channels, whether readings are quoted."""
    is_tank = F.element_at("cs", "tankId").isNotNull() & (F.element_at("cs", "deviceType") == "WaterTank")
    is_bit, is_default = F.col("deviceType") == "DrillBit", F.col("deviceType") == "default"
    rig = ("bitDepth", "holeDepth", "totalPumpOutput", "rotaryRpm", "inSlipStatus", "standpipePressure")
    return {
        "tank": (is_tank, F.element_at("cs", "tankId"), "tankId", ("waterTankLevel",), True),
        "rpm": (is_bit, F.element_at("ss", "id"), "id", ("currentRpm",), False),
        "block": (is_default, F.element_at("ss", "deviceName"), "id", ("blockPosition",), False),
        "rig": (is_default, F.col("deviceName"), "id", rig, False),
    }


def device_records(df: DataFrame, *topics: str) -> DataFrame:
    """The records of device telemetry for ``topics`` (by default all), in one pass; adds ``topic`` and ``value``.

    A message that serves several topics gives a row for each.
    """
    made = []
    for topic, (chosen, id_value, id_field, channels, quoted) in _device_topics().items():
        if not topics or topic in topics:
            value = _device_value(id_value, id_field, channels, quoted)
            record = F.struct(F.lit(topic).alias("topic"), value.alias("value"))
            made.append(F.when(chosen & _carries(channels), record))
    listed = F.filter(F.array(*made), lambda record: record.isNotNull())
    kept = [c for c in df.columns if c not in ("topic", "value")]
    return message_types(df, TELEMETRY).select(*kept, F.inline(listed))


def tank_records(df: DataFrame) -> DataFrame:
    return device_records(df, "tank").drop("topic")


def rpm_records(df: DataFrame) -> DataFrame:
    return device_records(df, "rpm").drop("topic")


def block_records(df: DataFrame) -> DataFrame:
    return device_records(df, "block").drop("topic")


def rig_records(df: DataFrame) -> DataFrame:
    return device_records(df, "rig").drop("topic")


def retained(df: DataFrame, as_of_millis: int, ts: str = "ts", days: int = RETENTION_DAYS) -> DataFrame:
    """Rows no older than ``days`` at ``as_of_millis``; a plain comparison, so it reaches the scan."""
    return df.where(F.col(ts) >= F.lit(as_of_millis - days * 86_400_000))
