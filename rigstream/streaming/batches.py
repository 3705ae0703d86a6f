"""Micro-batch forms: the batch operators applied to each batch, with state in a keyed table.

Use them as ``writeStream.foreachBatch``. They are safe to replay: a batch reads the state as it
was before that batch and replaces its own partition. State is one row per device; ``compacted`` keeps
what a batch has to read of it from growing with the batches before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from rigstream.operators import decode, forecast, reshape
from rigstream.operators.anchors import anchors, block_movement, paired_with, rig_labels, without_first
from rigstream.operators.skew import join_per_key
from rigstream.session import materialised
from rigstream.sources.offsets import offsets_reached
from rigstream.sources.tables import KeyedTable

Emit = Callable[[DataFrame, int], None]


def state_table(path: str) -> KeyedTable:
    return KeyedTable(path, ("id",), ("id",), 8, ("anchor_ts",))


def sums_table(path: str, key: str) -> KeyedTable:
    """A device's sums and last readings (``forecast.advanced``)."""
    return KeyedTable(path, (key,), (key,), 8, ("last_ts",))


def models_table(path: str, key: str) -> KeyedTable:
    """A device's newest model (``forecast.fit_sums``)."""
    return KeyedTable(path, (key,), (key,), 8, ("n",))


def upsert_into(table: KeyedTable) -> Emit:
    """A ``foreachBatch`` function that stores each batch in a keyed table."""
    return lambda rows, batch_id: table.write_batch(rows, batch_id)


def record_offsets(ledger: KeyedTable, group: str) -> Emit:
    """A ``foreachBatch`` function that notes how far a group has read."""
    return lambda messages, batch_id: ledger.write_batch(offsets_reached(messages, group), batch_id)


def upsert_attributes(root: str) -> Emit:
    """A ``foreachBatch`` function over attribute messages that stores the well, wellbore and rig rows.

    The messages are decoded once and kept for the three tables.
    """
    entities = {"well": reshape.wells, "wellbore": reshape.wellbores, "rig": reshape.rigs}

    def run(messages: DataFrame, batch_id: int) -> None:
        records = decode.non_empty_map(decode.decode_map(decode.non_empty(messages))).select("offset", "fields")
        records.persist()
        try:
            for name, rows_of in entities.items():
                KeyedTable.named(name, root).write_batch(rows_of(records, keep=("offset",)), batch_id)
        finally:
            records.unpersist()

    return run


def in_order(*emits: Emit) -> Emit:
    """Run several functions on each batch, one after the other: store first, note the offsets last."""

    def run(rows: DataFrame, batch_id: int) -> None:
        for emit in emits:
            emit(rows, batch_id)

    return run


def compacted(table: KeyedTable, every: int) -> Emit:
    """A ``foreachBatch`` function that compacts a table each so many batches; run it after those that store."""

    def run(rows: DataFrame, batch_id: int) -> None:
        if batch_id % every == every - 1:
            table.compact(rows.sparkSession)

    return run


def skip_empty(emit: Emit) -> Emit:
    def run(rows: DataFrame, batch_id: int) -> None:
        if not rows.isEmpty():
            emit(rows, batch_id)

    return run


def rig_state_batches(state: KeyedTable, emit: Emit, tie: list[str] | None = None) -> Emit:
    """Label readings against each device's first one, over all batches so far."""
    order = ["ts", *(tie or [])]

    def run(rows: DataFrame, batch_id: int) -> None:
        found = rows.groupBy("id").agg(
            F.min(F.struct(*order)).alias("first_at"), F.min_by("bitDepth", F.struct(*order, "bitDepth")).alias("first_value"),
            F.count(F.lit(1)).alias("anchor_rows"),
        )
        known = state.read_before(rows.sparkSession, batch_id)
        if known is None:
            known = rows.sparkSession.createDataFrame([], f"id {dict(rows.dtypes)['id']}, anchor_ts bigint, anchor_value double")
        merged = materialised(
            found.join(known, "id", "left").withColumns(
                {
                    "is_new": F.col("anchor_ts").isNull(),
                    "anchor_ts": F.coalesce("anchor_ts", "first_at.ts"),
                    "anchor_value": F.coalesce("anchor_value", "first_value"),
                }
            )
        )
        state.write_batch(merged.where("is_new").select("id", "anchor_ts", "anchor_value"), batch_id)
        paired = join_per_key(rows, merged.drop("first_value", "anchor_ts"), ["id"], "anchor_rows")
        first = F.when(F.col("is_new"), F.col("first_at"))
        kept = without_first(paired, "id", order, "bitDepth", first)
        emit(rig_labels(kept.drop("is_new", "first_at")), batch_id)

    return run


def block_batches(state: KeyedTable, emit: Emit, min_ms: int, max_ms: int, tie: list[str] | None = None) -> Emit:
    """Direction and velocity against the moving anchor, over all batches so far."""

    def run(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        known = state.read_before(spark, batch_id)
        columns = rows.columns
        if known is None:
            current = rows.withColumn("carried", F.lit(False))
        else:
            counts = rows.groupBy("id").agg(F.count(F.lit(1)).alias("anchor_rows"))
            present = materialised(counts.join(known, "id", "left"))
            timely = join_per_key(rows, present, ["id"], "anchor_rows").where(
                F.col("anchor_ts").isNull() | (F.col("ts") >= F.col("anchor_ts"))
            )
            # the anchor so far goes in as the device's first reading
            first = present.where(F.col("anchor_ts").isNotNull()).select(
                "id", F.col("anchor_ts").alias("ts"), F.col("anchor_value").alias("blockPosition")
            )
            current = timely.select(*columns, F.lit(False).alias("carried")).unionByName(
                first.withColumn("carried", F.lit(True)), allowMissingColumns=True
            )
        current = materialised(current)
        order = ["carried_last", *(tie or ["blockPosition"])]
        ordered = current.withColumn("carried_last", ~F.col("carried"))
        found = materialised(anchors(ordered, max_ms, tie=order))
        newest = found.groupBy("id").agg(F.max(F.struct("anchor_ts", "anchor_value")).alias("a")).select("id", "a.*")
        state.write_batch(newest, batch_id)
        paired = paired_with(ordered, found, min_ms, max_ms)
        emit(block_movement(paired.where(~F.col("carried"))).drop("carried", "carried_last"), batch_id)

    return run


def model_batches(
    kept: KeyedTable, models: KeyedTable, key: str, ts: str, value: str, p: int, q: int, slice_ms: int,
    emit: Emit | None = None, steps: int = forecast.FORECAST_STEPS,
) -> Emit:
    """Fit every device of a batch anew over all its readings so far, without reading those of earlier batches.

    ``models`` gets the models, ``emit`` the forecasts that follow from them.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        before = kept.read_before(rows.sparkSession, batch_id)
        new = materialised(forecast.advanced(before, rows, key, ts, value, p, q, slice_ms))
        kept.write_batch(new, batch_id)
        fitted = materialised(forecast.fit_sums(new, key, p, q).select(key, *forecast.MODEL))
        models.write_batch(fitted, batch_id)
        if emit is not None:
            last = forecast.from_tail(new, key, ts, value, p, q)
            emit(forecast.forecast(last, fitted, key, ts, value, p, q, steps), batch_id)

    return run
