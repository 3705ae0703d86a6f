"""Windowed averages, extrema and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rigstream.operators.panes import duration_ms, pane_ms, pane_start, window_starts

STAMP = "_stamp"


def stamp(ts: Column) -> Column:
    """Epoch milliseconds, as number or text, as a timestamp."""
    return F.timestamp_millis(ts.cast("bigint"))


def _windowed(df: DataFrame, ts: str, window: str, slide: str | None, watermark: str | None) -> tuple[DataFrame, Column]:
    stamped = df.withColumn(STAMP, stamp(F.col(ts)))
    if watermark and df.isStreaming:
        stamped = stamped.withWatermark(STAMP, watermark)
    return stamped, F.window(STAMP, window, slide).alias("window")


def _millis(at: Column) -> Column:
    return F.unix_millis(at)


def windowed_average(
    df: DataFrame, key: str, value: str, ts: str, window: str, into: str = "average",
    slide: str | None = None, watermark: str | None = None,
) -> DataFrame:
    """Mean of ``value`` per key and window, with the sum and count it can be rolled up from."""
    stamped, slot = _windowed(df, ts, window, slide, watermark)
    grouped = stamped.groupBy(slot, F.col(key)).agg(
        F.avg(value).alias(into), F.sum(value).alias("total"), F.count(value).alias("n")
    )
    return grouped.select(key, "window", _millis(F.col("window.start")).alias("window_start"), into, "total", "n")


def roll_up(averages: DataFrame, keys: list[str], into: str = "average") -> DataFrame:
    """Combine partial averages through their sums and counts."""
    merged = averages.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return merged.withColumn(into, F.try_divide("total", "n"))


def window_extrema(
    df: DataFrame, value: str, ts: str, window: str, keys: list[str] | None = None,
    device: str = "id", watermark: str | None = None, slide: str | None = None,
) -> DataFrame:
    """Largest and smallest ``value`` of each window, with the time and device of its first row.

    Windows that overlap (``slide``) are put together from panes; tables only, not streams.
    """
    if slide is not None:
        return _sliding_extrema(df, value, ts, window, slide, keys or [], device)
    stamped, slot = _windowed(df, ts, window, None, watermark)
    first = F.min(F.struct(F.col(ts).cast("bigint").alias("ts"), F.col(device).alias("id")))
    grouped = stamped.groupBy(slot, *[F.col(k) for k in keys or []]).agg(
        F.max(value).alias("max"), F.min(value).alias("min"), first.alias("_first")
    )
    rest = [k for k in keys or [] if k != "id"]
    return grouped.select(
        *rest, "window", _millis(F.col("window.start")).alias("window_start"),
        F.col("_first.id").alias("id"), F.col("_first.ts").alias("ts"), "max", "min",
    )


def _sliding_extrema(df: DataFrame, value: str, ts: str, window: str, slide: str, keys: list[str], device: str) -> DataFrame:
    at = F.col(ts).cast("bigint")
    rows = df.withColumn("_pane", pane_start(at, pane_ms(window, slide))).where(F.col("_pane").isNotNull())
    first = F.min(F.struct(at.alias("ts"), F.col(device).alias("id")))
    panes = rows.groupBy(*keys, "_pane").agg(F.max(value).alias("max"), F.min(value).alias("min"), first.alias("_first"))
    placed = panes.withColumn("window_start", F.explode(window_starts(F.col("_pane"), window, slide)))
    whole = placed.groupBy(*keys, "window_start").agg(F.max("max").alias("max"), F.min("min").alias("min"), F.min("_first").alias("_first"))
    begin, end = F.timestamp_millis("window_start"), F.timestamp_millis(F.col("window_start") + duration_ms(window))
    rest = [k for k in keys if k != "id"]
    return whole.select(
        *rest, F.struct(begin.alias("start"), end.alias("end")).alias("window"), "window_start",
        F.col("_first.id").alias("id"), F.col("_first.ts").alias("ts"), "max", "min",
    )


def running_extrema(extrema: DataFrame, keys: list[str] | None = None, block: str = "day") -> DataFrame:
    """Carry the extrema on from window to window, per ``keys`` or over all devices.

    The input has one row per window. It is cut into calendar blocks; the extrema of each block
    are handed to the next, so that no task sees all windows.
    """
    keys = keys or []
    blocked = extrema.withColumn("_block", F.date_trunc(block, F.timestamp_millis("window_start")))
    blocks = blocked.groupBy(*keys, "_block").agg(F.max("max").alias("_max"), F.min("min").alias("_min"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    handed_on = blocks.select(
        *keys, "_block", F.max("_max").over(earlier).alias("_max"), F.min("_min").over(earlier).alias("_min")
    )
    so_far = Window.partitionBy(*keys, "_block").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.join(handed_on, [*keys, "_block"])
        .withColumns(
            {
                "max": F.greatest("_max", F.max("max").over(so_far)),
                "min": F.least("_min", F.min("min").over(so_far)),
            }
        )
        .select(extrema.columns)
    )


def peak_to_peak(extrema: DataFrame, prefix: str) -> DataFrame:
    """The spread and its bounds under the names a channel is published by."""
    return extrema.withColumns(
        {prefix: F.col("max") - F.col("min"), prefix + "MAX": F.col("max"), prefix + "MIN": F.col("min")}
    ).drop("max", "min")


def extreme_rows(df: DataFrame, value: str, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """The whole rows holding the largest and the smallest ``value``, ties going to the largest row."""
    row = F.struct(*columns)
    order = F.struct(F.col(value), row)
    return df.groupBy(*(keys or [])).agg(F.max_by(row, order).alias("highest"), F.min_by(row, order).alias("lowest"))


def first_row(df: DataFrame, columns: list[str], order: list[str], keys: list[str] | None = None) -> DataFrame:
    """The first row in ``order``, whole or per key."""
    return df.groupBy(*(keys or [])).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("first"))


def record_count(df: DataFrame) -> DataFrame:
    return df.groupBy().agg(F.count(F.lit(1)).alias("n"))


def window_series(
    df: DataFrame, key: str, value: str, ts: str, window: str, tie: list[str] | None = None, slices: int = 64,
    slide: str | None = None,
) -> DataFrame:
    """The readings of each key and window in time order, numbered from 1.

    Each window is cut into ``slices``; rows are numbered inside their slice and moved up by the
    number of rows in the slices before it. Windows that overlap (``slide``) share the slices of their panes.
    """
    tie = tie or [value]
    if slide is not None:
        return _sliding_series(df, key, value, ts, window, slide, tie, slices)
    slot = F.window(stamp(F.col(ts)), window)
    start, end = F.unix_millis(slot["start"]), F.unix_millis(slot["end"])
    rows = df.select(key, ts, value, *[c for c in tie if c not in (key, ts, value)], start.alias("window_start"), end.alias("_end"))
    width = F.greatest((F.col("_end") - F.col("window_start")) / slices, F.lit(1))
    rows = rows.withColumn("_slice", F.floor((F.col(ts) - F.col("window_start")) / width)).drop("_end")
    group = [key, "window_start"]
    counts = rows.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_slice").orderBy(ts, *tie)
    numbered = rows.withColumn("_at", F.row_number().over(inside)).join(offsets, [*group, "_slice"])
    return numbered.select(key, "window_start", (F.col("_before") + F.col("_at")).alias("position"), ts, value)


def _sliding_series(
    df: DataFrame, key: str, value: str, ts: str, window: str, slide: str, tie: list[str], slices: int
) -> DataFrame:
    pane = pane_ms(window, slide)
    width = max(1, pane // max(1, slices * pane // duration_ms(window)))
    start = pane_start(F.col(ts), pane)
    rows = df.select(key, ts, value, *[c for c in tie if c not in (key, ts, value)], start.alias("_pane")).where(F.col("_pane").isNotNull())
    rows = rows.withColumn("_slice", F.floor((F.col(ts) - F.col("_pane")) / width))
    part = [key, "_pane", "_slice"]
    counts = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    placed = counts.withColumn("window_start", F.explode(window_starts(F.col("_pane"), window, slide)))
    earlier = Window.partitionBy(key, "window_start").orderBy("_pane", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.select(*part, "window_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*part).orderBy(ts, *tie)
    numbered = rows.withColumn("_at", F.row_number().over(inside)).join(offsets, part)
    return numbered.select(key, "window_start", (F.col("_before") + F.col("_at")).alias("position"), ts, value)


def series_vector(series: DataFrame, key: str, value: str, part_rows: int = 10_000) -> DataFrame:
    """Numbered readings as arrays of at most ``part_rows``; the parts in order form the vector."""
    part = F.floor((F.col("position") - 1) / part_rows).alias("part")
    pairs = F.sort_array(F.collect_list(F.struct("position", F.col(value).alias("v"))))
    grouped = series.groupBy(key, "window_start", part).agg(pairs.alias("_pairs"))
    return grouped.select(key, "window_start", "part", F.transform("_pairs", lambda pair: pair["v"]).alias("values"))
