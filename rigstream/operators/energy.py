"""Mechanical specific energy over well-log maps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rigstream.functions.drilling import MISSING_CHANNEL, specific_energy
from rigstream.functions.payloads import gateway_json_keyed
from rigstream.functions.text import parsed_double
from rigstream.operators.decode import computed_once
from rigstream.schemas import LogKeys


@dataclass(frozen=True)
class EnergyChannels:
    """Names of the input channels and of the result."""

    torque: str = "TOR"
    rpm: str = "RPM"
    rop: str = "ROP"
    wob: str = "WOB"
    diameter: str = "diameter"
    result: str = "CALC_MSE"


def _number(key: Column | str) -> Column:
    return parsed_double(F.element_at("fields", key))


def _inputs(names: EnergyChannels) -> Column:
    """Torque, rpm, rate of penetration, weight and diameter of a record; null where they are no numbers.

    A diameter given for the record's own log wins over the shared one.
    """
    own_key = F.concat(F.lit(names.diameter), F.replace(_log_name(), F.lit(" "), F.lit("")))
    own_text = F.element_at("fields", own_key)
    shared_counts = own_text.isNull() | (parsed_double(own_text) == MISSING_CHANNEL)
    return F.array(
        _number(names.torque), _number(names.rpm), _number(names.rop), _number(names.wob),
        F.when(shared_counts, _number(names.diameter)).otherwise(parsed_double(own_text)),
    )


def _log_name() -> Column:
    return F.coalesce(F.element_at("fields", "LogName"), F.lit(""))


def _usable(inputs: str) -> Column:
    """A channel that is absent, not a number or equal to the missing-value mark drops the record."""
    return F.forall(inputs, lambda v: v.isNotNull() & (v != MISSING_CHANNEL))


def _energy(inputs: str) -> Column:
    return specific_energy(*[F.get(inputs, F.lit(i)) for i in range(5)])


def add_energy(df: DataFrame, names: EnergyChannels = EnergyChannels()) -> DataFrame:
    """Add ``mse_key`` and ``mse``, and both to the map; drop records without usable inputs."""
    inputs = computed_once(df, "_inputs", _inputs(names))
    keyed = computed_once(inputs.where(_usable("_inputs")), "mse", _energy("_inputs"))
    keyed = keyed.withColumn("mse_key", F.concat(F.lit(names.result + "@"), _log_name()))
    kept = F.map_filter("fields", lambda key, _: (key != names.result) & (key != F.col("mse_key")))
    added = F.create_map(F.lit(names.result), F.col("mse_key"), F.col("mse_key"), F.col("mse").cast("string"))
    return keyed.withColumn("fields", F.map_concat(kept, added)).drop("_inputs")


def energies(df: DataFrame, names: EnergyChannels = EnergyChannels(), keys: LogKeys = LogKeys()) -> DataFrame:
    """``mse_key`` and ``mse`` of the records with usable inputs, with the well and depth they are published under.

    All that is needed of the map is read out of it at once, and the map goes no further.
    """
    read = F.struct(
        _inputs(names).alias("inputs"), F.concat(F.lit(names.result + "@"), _log_name()).alias("mse_key"),
        F.element_at("fields", "nameWell").alias("well"), F.element_at("fields", keys.tsds).alias("depth"),
    )
    rows = computed_once(df, "_read", read).drop("fields").where(_usable("_read.inputs"))
    others = [c for c in rows.columns if c != "_read"]
    return rows.select(*others, "_read.well", "_read.depth", "_read.mse_key", _energy("_read.inputs").alias("mse"))


def energy_message(well: Column, depth: Column, mse_key: Column, mse: Column) -> Column:
    well, depth = F.coalesce(well, F.lit("nameWell")), F.coalesce(depth, F.lit("0.00"))
    return gateway_json_keyed(well, depth, mse_key, F.coalesce(mse, F.lit(0.0)), time_key="ds")


def energy_payload(df: DataFrame) -> DataFrame:
    """Depth-stamped telemetry of ``energies``."""
    return df.withColumn("payload", energy_message(*[F.col(c) for c in ("well", "depth", "mse_key", "mse")]))
