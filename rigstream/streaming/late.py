"""Windowed averages by each device's own clock, with late readings as rows of their own.

Spark's watermark is one for all devices, and what lies behind it vanishes. Here a device's clock is the
latest time it has sent, less a delay. A window closes when its device's clock passes its end; a reading whose
window had closed before its batch is late. Closed windows and late readings leave the operator in one
table, told apart by ``late``, so every reading is either counted in a window or handed on.

State is a device's latest time and a sum and count for each of its open windows, as many as the delay spans;
readings are not kept. A device's windows stay open while it sends nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rigstream.operators.panes import duration_ms, pane_start
from rigstream.streaming.batches import Emit

_START = "window_start"
_COLUMNS = [_START, "average", "total", "n", "late", "late_ts", "late_value"]


class DeviceWindows(StatefulProcessor):
    """Sums the readings of a device by window, and hands on closed windows and late readings."""

    def __init__(self, key: str, ts: str, value: str, window_ms: int, delay_ms: int):
        self.key, self.ts, self.value = key, ts, value
        self.window_ms, self.delay_ms = window_ms, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "ts bigint")
        self.windows = handle.getMapState("windows", "start bigint", "total double, n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.latest.get()[0] if self.latest.exists() else None
        latest = before
        for part in rows:
            starts, ts = part[_START], part[self.ts]
            if before is not None:
                is_late = starts + self.window_ms <= before - self.delay_ms
                if is_late.any():
                    late = part[is_late]
                    yield self._rows(key, late[_START], late_ts=late[self.ts], late_value=late[self.value], late=True)
                    part, starts = part[~is_late], starts[~is_late]
            if part.empty:
                continue
            latest = int(ts.max()) if latest is None else max(latest, int(ts.max()))
            sums = part[self.value].groupby(starts).agg(["sum", "count"])
            for start, total, n in sums.itertuples(name=None):
                at = (int(start),)
                held = self.windows.getValue(at) if self.windows.containsKey(at) else (0.0, 0)
                self.windows.updateValue(at, (held[0] + float(total), held[1] + int(n)))
        if latest is not None and latest != before:
            self.latest.update((latest,))
            closed = sorted(int(k[0]) for k in self.windows.keys() if int(k[0]) + self.window_ms <= latest - self.delay_ms)
            found = [self.windows.getValue((start,)) for start in closed]
            for start in closed:
                self.windows.removeKey((start,))
            if closed:
                total, n = pd.Series([f[0] for f in found], dtype=float), pd.Series([f[1] for f in found], dtype="int64")
                yield self._rows(key, pd.Series(closed, dtype="int64"), average=total / n, total=total, n=n, late=False)

    def _rows(self, key, starts: pd.Series, **columns) -> pd.DataFrame:
        out = pd.DataFrame({self.key: key[0], _START: starts})
        for name in _COLUMNS[1:]:
            out[name] = columns.get(name)
        return out

    def close(self) -> None:
        pass


def device_windows(df: DataFrame, key: str, value: str, ts: str, window: str, delay: str) -> DataFrame:
    """Closed windows (``late`` false: ``window_start``, ``average``, ``total``, ``n``) and late readings (``late_ts``, ``late_value``).

    Readings without a key, time or value are left out, as they are in no window's count.
    """
    length = duration_ms(window)
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull() & F.col(value).isNotNull())
    rows = known.select(key, F.col(ts).cast("bigint").alias(ts), F.col(value).cast("double").alias(value), pane_start(F.col(ts).cast("bigint"), length).alias(_START))
    schema = f"`{key}` {dict(df.dtypes)[key]}, {_START} bigint, average double, total double, n bigint, late boolean, late_ts bigint, late_value double"
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=DeviceWindows(key, ts, value, length, duration_ms(delay)), outputStructType=schema, outputMode="Append", timeMode="None"
    )


def split_late(on_time: Emit, late: Emit) -> Emit:
    """A ``foreachBatch`` function over ``device_windows``: closed windows to one function, late readings to another."""

    def run(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            on_time(rows.where(~F.col("late")).drop("late", "late_ts", "late_value"), batch_id)
            late(rows.where("late").select(*[c for c in rows.columns if c not in ("average", "total", "n", "late")]), batch_id)
        finally:
            rows.unpersist()

    return run
