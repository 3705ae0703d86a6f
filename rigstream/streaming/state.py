"""Keyed-state processors for streams.

State per device is one reading, so a batch costs the same however many came before it. A new query
can start from the state of another one, or of the micro-batch forms: ``initial`` takes a table with
one row per device (its key, ``anchor_ts``, ``anchor_value``), and ``anchors_kept`` reads that table out of a query's checkpoint.

A processor sees a device's rows of one micro-batch. Those of ``FirstReading`` pass frame by frame
once the device is known; ``MovingAnchor`` orders them by time and tie, so bound the batch at the source
(``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``). For a stream in which one device dominates use
``rigstream.streaming.batches``, which spreads its rows over the cluster. Readings without a device
id are left out, as in the batch operators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


#: State variable of both comparison processors, and its layout.
ANCHOR, ANCHOR_DDL = "anchor", "ts bigint, value double"


class _Anchored(StatefulProcessor):
    """A processor whose state is an anchor, which a table may give it to begin with."""

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for row in initialState.itertuples(index=False):
            self.anchor.update((None if pd.isna(row.anchor_ts) else int(row.anchor_ts), _number(row.anchor_value)))

    def close(self) -> None:
        pass


def _number(value) -> float | None:
    """A value as it goes into state; pandas marks a missing number by NaN."""
    return None if value is None or value is pd.NA else float(value)


class FirstReading(_Anchored):
    """Pairs every reading with the device's first one, which never changes."""

    def __init__(self, ts: str, order: list[str], value: str):
        self.ts, self.order, self.value = ts, order, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.anchor = handle.getValueState(ANCHOR, ANCHOR_DDL)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.anchor.exists():
            value = self.anchor.get()[1]
        else:
            batch = pd.concat(rows, ignore_index=True).sort_values(self.order, kind="stable")
            first = batch.iloc[0]
            value = _number(first[self.value])
            self.anchor.update((int(first[self.ts]), value))
            rows = iter([batch.iloc[1:]])
        for part in rows:
            yield part.assign(anchor_value=np.nan if value is None else value)


class MovingAnchor(_Anchored):
    """Pairs readings with an anchor that is replaced once a reading lies too far after it."""

    def __init__(self, ts: str, order: list[str], value: str, min_ms: int, max_ms: int, ttl_ms: int | None):
        self.ts, self.order, self.value = ts, order, value
        self.min_ms, self.max_ms, self.ttl_ms = min_ms, max_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.anchor = handle.getValueState(ANCHOR, ANCHOR_DDL, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(rows, ignore_index=True).sort_values(self.order, kind="stable")
        ts, value = batch[self.ts].to_numpy(), batch[self.value].to_numpy()
        at, level = self.anchor.get() if self.anchor.exists() else (None, None)
        anchor_ts, anchor_value = np.zeros(len(ts), dtype="int64"), np.zeros(len(ts))
        done = 0
        while done < len(ts):
            if at is None:
                at, level = int(ts[done]), float(value[done])
            reach = int(np.searchsorted(ts, at + self.max_ms, side="right"))
            anchor_ts[done:reach], anchor_value[done:reach] = at, level
            done = max(done, reach)
            if done < len(ts):
                at = None
        self.anchor.update((at, level))
        gap = ts - anchor_ts
        yield batch.assign(anchor_ts=anchor_ts, anchor_value=anchor_value)[
            (gap >= self.min_ms) & (gap <= self.max_ms)
        ]


class RunningExtrema(StatefulProcessor):
    """Carries the largest and smallest value on from window to window."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bounds = handle.getValueState("bounds", "max double, min double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows = pd.concat(rows, ignore_index=True).sort_values("window_start")
        high, low = self.bounds.get() if self.bounds.exists() else (-np.inf, np.inf)
        windows["max"] = np.maximum(windows["max"].cummax(), high)
        windows["min"] = np.minimum(windows["min"].cummin(), low)
        self.bounds.update((float(windows["max"].iloc[-1]), float(windows["min"].iloc[-1])))
        yield windows

    def close(self) -> None:
        pass


def _with(df: DataFrame, extra: str) -> str:
    return ", ".join([f"`{name}` {kind}" for name, kind in df.dtypes] + [extra])


def _stateful(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str, expires: bool = False, initial: DataFrame | None = None) -> DataFrame:
    # state that expires keeps the query running batches by the clock, so it is opted into
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append",
        timeMode="ProcessingTime" if expires else "None", initialState=None if initial is None else initial.groupBy(*keys),
    )


def _seed(initial: DataFrame | None, key: str) -> DataFrame | None:
    """The table a query starts from; what a query is given counts in its first batch only, its checkpoint from then on."""
    if initial is None:
        return None
    return initial.where(F.col(key).isNotNull()).select(
        key, F.col("anchor_ts").cast("bigint").alias("anchor_ts"), F.col("anchor_value").cast("double").alias("anchor_value")
    )


def anchors_kept(spark: SparkSession, checkpoint: str, key: str = "id") -> DataFrame:
    """The anchors in the checkpoint of a comparison query: ``key``, ``anchor_ts``, ``anchor_value`` per device."""
    found = spark.read.format("statestore").option("stateVarName", ANCHOR).load(checkpoint)
    return found.select(F.col("key")[key].alias(key), F.col("value.ts").alias("anchor_ts"), F.col("value.value").alias("anchor_value"))


def with_first_reading_stream(
    df: DataFrame, key: str = "id", ts: str = "ts", tie: list[str] | None = None, value: str = "bitDepth",
    initial: DataFrame | None = None,
) -> DataFrame:
    known = df.where(F.col(key).isNotNull())
    return _stateful(known, [key], FirstReading(ts, [ts, *(tie or [])], value), _with(df, "anchor_value double"), initial=_seed(initial, key))


def with_moving_anchor_stream(
    df: DataFrame, min_ms: int, max_ms: int, key: str = "id", ts: str = "ts", value: str = "blockPosition",
    tie: list[str] | None = None, ttl_ms: int | None = None, initial: DataFrame | None = None,
) -> DataFrame:
    """A reading before the device's anchor, which only a table or an earlier batch can have set, is paired with nothing."""
    processor = MovingAnchor(ts, [ts, *(tie or [])], value, min_ms, max_ms, ttl_ms)
    schema = _with(df, "anchor_ts bigint, anchor_value double")
    known = df.where(F.col(key).isNotNull())
    return _stateful(known, [key], processor, schema, expires=ttl_ms is not None, initial=_seed(initial, key))


def running_extrema_stream(extrema: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``extrema`` is a stream of closed windows, so the rows that meet here are few."""
    rows = extrema.drop("window")
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    if keys:
        return _stateful(rows, keys, RunningExtrema(), schema)
    return _stateful(rows.withColumn("_all", F.lit(0)), ["_all"], RunningExtrema(), schema)
