"""Ledger of consumed offsets, kept as a keyed table."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def offsets_reached(messages: DataFrame, group: str) -> DataFrame:
    """The next offset to read of each topic partition in ``messages``."""
    reached = messages.where(F.col("offset").isNotNull()).groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("offsetid")
    )
    return reached.select(F.col("topic").alias("topic_name"), F.lit(group).alias("group_id"), "partition", "offsetid")


def unread(messages: DataFrame, ledger: DataFrame, group: str) -> DataFrame:
    """The messages that a group has not read yet, of a source that has no offsets to start from.

    For recorded messages, whose stream starts with the first file when its checkpoint is lost. Partitions that the
    ledger does not know are read from their start; messages without an offset are kept. The ledger holds
    one row per topic partition, so this is a handful of rows.
    """
    reached = ledger.where(F.col("group_id") == group).select("topic_name", "partition", "offsetid").collect()
    if not reached:
        return messages
    place = F.struct(F.col("topic").cast("string").alias("t"), F.col("partition").cast("int").alias("p"))
    keys = [F.struct(F.lit(r.topic_name).alias("t"), F.lit(r.partition).cast("int").alias("p")) for r in reached]
    next_offset: Column = F.create_map(*[x for key, r in zip(keys, reached) for x in (key, F.lit(r.offsetid).cast("bigint"))])
    return messages.where(F.coalesce(F.col("offset") >= F.try_element_at(next_offset, place), F.lit(True)))


#: Kafka's number for "from the latest record on".
LATEST = -1


def starting_offsets(ledger: DataFrame, topic: str, group: str, partitions: Iterable[int] = ()) -> str:
    """Kafka's ``startingOffsets`` for a topic and group; ``latest`` where nothing is recorded.

    Kafka's source wants every partition of the topic named, so give ``partitions``: those that the
    ledger does not know, as nothing was read of them yet, start at the latest record.
    The ledger holds one row per topic partition, so this is a handful of rows.
    """
    mine = ledger.where((F.col("topic_name") == topic) & (F.col("group_id") == group))
    reached = mine.select("partition", "offsetid").collect()
    if not reached:
        return "latest"
    offsets = {int(n): LATEST for n in partitions} | {row.partition: row.offsetid for row in reached}
    return json.dumps({topic: {str(n): offsets[n] for n in sorted(offsets)}})
