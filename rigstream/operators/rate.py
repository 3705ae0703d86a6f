"""Running rate of change of a level per key and window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rigstream.functions.drilling import time_to_limit
from rigstream.operators.aggregates import stamp
from rigstream.operators.panes import duration_ms, pane_ms, pane_start, window_starts
from rigstream.operators.skew import ordering


def running_rate(
    df: DataFrame, key: str, value: str, ts: str, window: str, tie: list[str] | None = None, slices: int = 64,
    slide: str | None = None,
) -> DataFrame:
    """Rate per second, last usable time and last usable level of each key and window.

    Adjacent readings give rates; the running average starts with the first rate and then is the
    mean of itself and each next rate. So the k-th of n rates weighs 2^-(n-k+1), the first twice
    that. Readings of one instant give no rate among themselves: the first of them closes the pair
    before, the last opens the pair after. They are merged before the shuffle, and windows are cut
    into ``slices`` whose partial sums are combined, so no series is sorted in one task. Windows that
    overlap (``slide``) are combined from the slices of the panes they share; these are folded once.
    """
    order = ordering(tie or [value])
    if slide is not None:
        pane = pane_ms(window, slide)
        width = max(1, pane // max(1, slices * pane // duration_ms(window)))
        rows = df.withColumn("_pane", pane_start(F.col(ts), pane)).where(F.col("_pane").isNotNull())
        # slices are numbered by their start, so that they follow each other in every window
        rows = rows.withColumn("_slice", F.col("_pane") + F.floor((F.col(ts) - F.col("_pane")) / width) * width)
        parts = _slice_parts(rows, [key, "_pane"], value, ts, order)
        placed = parts.withColumn("window_start", F.explode(window_starts(F.col("_pane"), window, slide))).drop("_pane")
        return _linked(placed, [key, "window_start"])
    slot = F.window(stamp(F.col(ts)), window)
    rows = df.withColumns({"window_start": F.unix_millis(slot["start"]), "_end": F.unix_millis(slot["end"])})
    width = F.greatest((F.col("_end") - F.col("window_start")) / slices, F.lit(1))
    rows = rows.withColumn("_slice", F.floor((F.col(ts) - F.col("window_start")) / width))
    group = [key, "window_start"]
    return _linked(_slice_parts(rows, group, value, ts, order), group)


def _slice_parts(rows: DataFrame, group: list[str], value: str, ts: str, order: Column) -> DataFrame:
    """The rates inside each slice of a group, summed up, with the slice's first and last reading."""
    instants = rows.groupBy(*group, "_slice", ts).agg(
        F.min_by(value, order).alias("_opening"), F.max_by(value, order).alias("_closing")
    )

    inside = Window.partitionBy(*group, "_slice").orderBy(ts)
    rates = instants.withColumns(
        {
            "_rate": _rate(F.col(ts), F.col("_opening"), F.lag(ts).over(inside), F.lag("_closing").over(inside)),
            "_at": F.row_number().over(inside),
            "_after": F.count(F.lit(1)).over(Window.partitionBy(*group, "_slice")) - F.row_number().over(inside),
        }
    )
    # a slice's second reading closes its first rate, which is kept apart from the sum of the rest
    return rates.groupBy(*group, "_slice").agg(
        F.sum(F.when(F.col("_at") > 2, F.col("_rate") * _half_to(F.col("_after") + 1))).alias("_rest"),
        F.max(F.when(F.col("_at") == 2, F.col("_rate"))).alias("_first"),
        F.count("_rate").alias("_n"),
        F.min_by(F.struct(F.col(ts).alias("ts"), "_opening", "_closing"), ts).alias("_head"),
        F.max_by(F.struct(F.col(ts).alias("ts"), "_opening", "_closing"), ts).alias("_tail"),
    )


def _linked(parts: DataFrame, group: list[str]) -> DataFrame:
    """Rate, last usable time and level of each group, from its slices in order."""
    # a slice's opening reading pairs with the closing one of the slice before it
    along = Window.partitionBy(*group).orderBy("_slice")
    last = F.lag("_tail").over(along)
    linked = parts.withColumn(
        "_link", _rate(F.col("_head.ts"), F.col("_head._opening"), last["ts"], last["_closing"])
    )
    has_link = F.col("_link").isNotNull()
    own_first = F.when(has_link, F.coalesce(F.col("_first") * _half_to(F.col("_n")), F.lit(0.0))).otherwise(F.lit(0.0))
    counted = linked.withColumns(
        {
            "_rest": F.coalesce("_rest", F.lit(0.0)) + own_first,
            "_lead": F.coalesce("_link", "_first"),
            "_n": F.col("_n") + has_link.cast("bigint"),
        }
    )
    before = F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    later = F.coalesce(F.sum("_n").over(along.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    opens_window = (before == 0).cast("bigint")
    lead = F.coalesce(F.col("_lead") * _half_to(F.col("_n") - F.col("_opens")), F.lit(0.0))
    weighted = counted.withColumns({"_later": later, "_opens": opens_window})
    whole = weighted.groupBy(*group).agg(
        F.sum((F.col("_rest") + lead) * _half_to(F.col("_later"))).alias("rate"),
        F.max_by("_tail", "_slice").alias("_tail"),
    )
    return whole.select(
        *group, F.col("_tail.ts").alias("ts"), "rate", F.col("_tail._opening").alias("level")
    )


def _rate(ts: Column, level: Column, ts_before: Column, level_before: Column) -> Column:
    return (level - level_before) * 1000 / (ts - ts_before)


def _half_to(power: Column) -> Column:
    return F.pow(F.lit(2.0), -power)


def time_to_fill(rates: DataFrame, limit: float) -> DataFrame:
    """Add ``eta``: the seconds until the level reaches ``limit``."""
    return rates.withColumn("eta", time_to_limit(F.col("rate"), F.col("level"), limit))
