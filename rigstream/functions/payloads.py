"""Telemetry messages as JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def gateway_json(device: Column, at: Column, values: dict[str, Column], time_key: str = "ts") -> Column:
    """``{"<device>":[{"ts":<at>,"values":{...}}]}``."""
    readings = F.struct(*[value.alias(name) for name, value in values.items()])
    return F.to_json(F.create_map(device, F.array(F.struct(at.alias(time_key), readings.alias("values")))))


def gateway_json_keyed(device: Column, at: Column, key: Column, value: Column, time_key: str = "ts") -> Column:
    """The same message for one reading whose name is itself data."""
    reading = F.create_map(key, value)
    return F.to_json(F.create_map(device, F.array(F.struct(at.alias(time_key), reading.alias("values")))))


def flat_json(values: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in values.items()]))


def announce_json(device: Column) -> Column:
    return F.to_json(F.struct(device.alias("device")))
