"""Stream form of the running rate: slices folded in keyed state, then slices folded per window.

The k-th of n rates weighs 2^-(n-k+1), so rates behind the last 1,100 weigh nothing in double precision.
The state of a slice is therefore bounded, whatever its readings: its last ``KEPT`` instants, two
readings each. When the watermark passes a slice its timer folds them to one row, and the rows of a
window's slices are folded the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rigstream.operators.aggregates import STAMP, stamp

#: Instants of a slice that can weigh more than nothing, with some to spare: 2^-1075 rounds to 0.
KEPT = 1_100
_POINT = "struct<ts:bigint,opening:double,closing:double>"
# `rest` is the weighted sum of all rates but the first
_FOLD = f"struct<head:{_POINT},tail:{_POINT},first:double,rest:double,n:bigint>"
#: What a slice is folded to, beside its key and start.
_PART = "head_ts bigint, head_opening double, head_closing double, tail_ts bigint, tail_opening double, tail_closing double, first double, rest double, n bigint"


class SliceFold(StatefulProcessor):
    """Folds the readings of a key's slice once the watermark has passed it."""

    def __init__(self, key: str, ts: str, value: str, order: list[str], state_ddl: str):
        self.key, self.ts, self.value, self.order, self.state_ddl = key, ts, value, order, state_ddl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = handle.getListState("readings", self.state_ddl)
        # whether a reading that is no number has left the list: its rate would have made the sum no number
        self.broken = handle.getValueState("broken", "broken boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        if held.empty:
            self.handle.registerTimer(int(key[2]))
        for part in rows:
            held = self._last(pd.concat([held, part[self.order]], ignore_index=True) if len(held) else part[self.order])
        self.readings.put([tuple(_plain(v) for v in row) for row in held.itertuples(index=False, name=None)])
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        if len(held):
            first, rest, n, head, tail = fold(*self._instants(held))
            if self.broken.exists():
                rest = math.nan
            yield pd.DataFrame(
                {
                    self.key: [key[0]], "slice_start": [int(key[1])], "at": [pd.Timestamp(int(key[2]) - 1, unit="ms")],
                    "head_ts": [head[0]], "head_opening": [head[1]], "head_closing": [head[2]],
                    "tail_ts": [tail[0]], "tail_opening": [tail[1]], "tail_closing": [tail[2]],
                    "first": [first], "rest": [rest], "n": [n],
                }
            )
        self.readings.clear()
        self.broken.clear()

    def close(self) -> None:
        pass

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.readings.get()), columns=self.order)

    def _last(self, rows: pd.DataFrame) -> pd.DataFrame:
        """The first and last reading of each of the last instants."""
        rows = rows.sort_values(self.order, kind="stable", ignore_index=True)
        ts = rows[self.ts].to_numpy()
        opens, closes = np.append(True, ts[1:] != ts[:-1]), np.append(ts[1:] != ts[:-1], True)
        rows = rows[opens | closes]
        ts = rows[self.ts].to_numpy()
        distinct = np.unique(ts)
        if len(distinct) > KEPT:
            left = ts < distinct[-KEPT]
            if not np.isfinite(rows[self.value].to_numpy(dtype=float)[left]).all():
                self.broken.update((True,))
            rows = rows[~left]
        return rows

    def _instants(self, held: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ts, level = held[self.ts].to_numpy(dtype="int64"), held[self.value].to_numpy(dtype=float)
        opens, closes = np.append(True, ts[1:] != ts[:-1]), np.append(ts[1:] != ts[:-1], True)
        return ts[opens], level[opens], level[closes]


def _plain(value):
    return value.item() if isinstance(value, np.generic) else value


def fold(ts: np.ndarray, opening: np.ndarray, closing: np.ndarray):
    """(first rate, weighted sum of the rest, number of rates, first and last point) of instants in order; no rate counts as 0."""
    head, tail = (int(ts[0]), float(opening[0]), float(closing[0])), (int(ts[-1]), float(opening[-1]), float(closing[-1]))
    rates = (opening[1:] - closing[:-1]) * 1000 / (ts[1:] - ts[:-1])
    n = len(rates)
    rest = float((rates[1:] * np.exp2(-np.arange(n - 1, 0, -1, dtype=float))).sum()) if n > 1 else 0.0
    return (float(rates[0]) if n else 0.0), rest, n, head, tail


def _rate(before: Column, after: Column) -> Column:
    return F.try_divide((after["opening"] - before["closing"]) * 1000, after["ts"] - before["ts"])


def _state(head: Column, tail: Column, first: Column, rest: Column, n: Column) -> Column:
    fields = {"head": head, "tail": tail, "first": first, "rest": rest, "n": n}
    return F.struct(*[c.alias(name) for name, c in fields.items()]).cast(_FOLD)


def _half_to(power: Column) -> Column:
    return F.pow(F.lit(2.0), -power)


def _append(left: Column, right: Column) -> Column:
    """The fold of two stretches of a series, the right one later."""
    link = _rate(left["tail"], right["head"])
    is_first = left["n"] == 0
    rest = (
        F.when(is_first, F.lit(0.0)).otherwise((left["rest"] + link) * _half_to(right["n"] + 1))
        + F.coalesce(right["first"] * _half_to(right["n"]), F.lit(0.0))
        + right["rest"]
    )
    joined = _state(
        left["head"], right["tail"], F.when(is_first, link).otherwise(left["first"]), rest, left["n"] + right["n"] + 1
    )
    # readings of one instant are one point with its first and last value
    merged = F.struct(
        left["tail"]["ts"].alias("ts"), left["tail"]["opening"].alias("opening"), right["tail"]["closing"].alias("closing")
    ).cast(_POINT)
    same = _state(
        F.when(left["n"] == 0, merged).otherwise(left["head"]), merged, left["first"], left["rest"], left["n"]
    )
    return F.when(left.isNull(), right).when(left["tail"]["ts"] == right["head"]["ts"], same).otherwise(joined)


def _fold(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(None).cast(_FOLD), _append)


def running_rate_stream(
    df: DataFrame, key: str, value: str, ts: str, window: str, slice_length: str, watermark: str, tie: list[str] | None = None
) -> DataFrame:
    """Same columns and values as the batch form, once each window has closed.

    ``slice_length`` must divide ``window``. Readings without a key or level are left out.
    """
    known = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    stamped = known.withColumn(STAMP, stamp(F.col(ts))).withWatermark(STAMP, watermark)
    # the slice takes the place of the time, so that a reading is late when its slice is closed, not before
    slices = stamped.withColumn("slice", F.window(STAMP, slice_length)).drop(STAMP)
    slices = slices.withColumns({"slice_start": F.unix_millis("slice.start"), "slice_end": F.unix_millis("slice.end")})
    kinds = dict(df.dtypes)
    order = list(dict.fromkeys([ts, *(tie or []), value]))
    processor = SliceFold(key, ts, value, order, ", ".join(f"`{c}` {kinds[c]}" for c in order))
    folded = slices.groupBy(key, "slice_start", "slice_end").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=f"`{key}` {kinds[key]}, slice_start bigint, at timestamp, {_PART}", outputMode="Append",
        timeMode="EventTime", eventTimeColumnName="at",
    )

    def point(name: str) -> Column:
        return F.struct(*[F.col(f"{name}_{c}").alias(c) for c in ("ts", "opening", "closing")])

    folded = folded.withColumn("part", _state(point("head"), point("tail"), F.when(F.col("n") > 0, F.col("first")), F.col("rest"), F.col("n")))
    slot = F.window("at", window).alias("window")
    whole = folded.groupBy(slot, key).agg(
        F.sort_array(F.collect_list(F.struct("slice_start", "part"))).alias("parts")
    )
    done = whole.withColumn("fold", _fold(F.transform("parts", lambda p: p["part"])))
    first = F.coalesce(F.col("fold.first") * _half_to(F.col("fold.n") - 1), F.lit(0.0))
    return done.select(
        key, F.unix_millis("window.start").alias("window_start"), F.col("fold.tail.ts").alias("ts"),
        (F.col("fold.rest") + first).alias("rate"), F.col("fold.tail.opening").alias("level"),
    )
