"""Message tables: one row per telemetry message to publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rigstream.functions.payloads import announce_json, flat_json, gateway_json
from rigstream.functions.text import is_blank

TANK_PREFIX = "Tank "


def tank_average_messages(averages: DataFrame, at: Column, key: str = "tankId", value: str = "average") -> DataFrame:
    device = F.concat(F.lit(TANK_PREFIX), F.col(key))
    return averages.where(F.col(key).isNotNull()).withColumn(
        "payload", gateway_json(device, at, {"averageWaterLevel": F.col(value)})
    )


def zone_average_messages(
    averages: DataFrame, at: Column, zone: str = "geoZone", value: str = "average", window: str | None = None
) -> DataFrame:
    """One message per window that holds the mean of every zone, zones in name order.

    A window has one aggregated row per zone here, whatever the number of readings. A stream
    needs the ``window`` length, to group the closed windows by their event time.
    """
    reading = F.array(F.struct(F.col("_at").alias("ts"), F.struct(F.col(value).alias("windSpeed")).alias("values")))
    zones = F.sort_array(F.collect_list(F.struct(F.col(zone).alias("zone"), reading.alias("readings"))))
    named = averages.where(F.col(zone).isNotNull()).withColumn("_at", at)
    message = F.to_json(F.map_from_entries(zones)).alias("payload")
    if not averages.isStreaming:
        return named.groupBy("window_start").agg(message)
    slot = F.window(F.window_time("window"), window).alias("slot")
    return named.groupBy(slot).agg(message).select(F.unix_millis("slot.start").alias("window_start"), "payload")


def fill_time_messages(etas: DataFrame, key: str = "tankId") -> DataFrame:
    """Time-to-fill messages; rows without a tank name are left out."""
    device = F.concat(F.lit(TANK_PREFIX), F.col(key))
    known = etas.where(~is_blank(F.col(key)))
    return known.withColumn("payload", gateway_json(device, F.col("ts"), {"timeToFill": F.col("eta")}))


def device_messages(rows: DataFrame, columns: list[str], device: str = "id", ts: str = "ts") -> DataFrame:
    """Device, time and the chosen measures as flat JSON."""
    values = {name: F.col(name) for name in columns}
    return rows.select(F.col(device).alias("device"), F.col(ts).cast("bigint").alias("ts"), flat_json(values).alias("payload"))


def announce_messages(rows: DataFrame, device: Column) -> DataFrame:
    """One connect message per distinct device."""
    names = rows.select(device.alias("device")).where(F.col("device").isNotNull()).distinct()
    return names.select("device", announce_json(F.col("device")).alias("payload"))


def announced_first(announcements: DataFrame, messages: DataFrame) -> DataFrame:
    """Both kinds in one table; ``seq`` orders the announcements ahead of the telemetry."""
    first = announcements.select(F.lit(0).alias("seq"), "payload")
    return first.unionByName(messages.select(F.lit(1).alias("seq"), "payload"))
