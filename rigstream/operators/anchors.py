"""Compare each reading of a device with an earlier one, its anchor."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rigstream.functions import drilling
from rigstream.operators.skew import join_per_key, ordering, time_slice, with_slice

# ---------------------------------------------------------------- first reading as anchor


def first_reading(df: DataFrame, key: str, ts: str, tie: list[str], value: str) -> DataFrame:
    """One row per device: its first reading in (ts, tie) order and its number of rows."""
    first = F.min(F.struct(F.struct(ts, *tie).alias("at"), F.col(value).alias("value")))
    found = df.groupBy(key).agg(first.alias("first"), F.count(F.lit(1)).alias("anchor_rows"))
    return found.select(
        key, F.col("first.at").alias("anchor_at"), F.col("first.value").alias("anchor_value"), "anchor_rows"
    )


def with_first_reading(
    df: DataFrame, key: str = "id", ts: str = "ts", tie: list[str] | None = None, value: str = "bitDepth"
) -> DataFrame:
    """Every reading but the device's first, with the first one's ``value`` as ``anchor_value``.

    Only one reading is the first; others of the same instant and tie are compared with it.
    """
    tie = tie or []
    anchors = first_reading(df, key, ts, tie, value)
    joined = join_per_key(df, anchors, [key], "anchor_rows")
    return without_first(joined, key, [ts, *tie], value, F.col("anchor_at")).drop("anchor_at")


def without_first(paired: DataFrame, key: str, order: list[str], value: str, first: Column) -> DataFrame:
    """All rows but one per key: of those whose ``order`` columns equal ``first``, one of the lowest ``value``.

    Other readings of that instant are readings like any other. Equal rows are counted before they
    meet, so copies do not travel.
    """
    at_first = F.struct(*order).eqNullSafe(first)
    rest = [value, *[c for c in paired.columns if c not in (key, value, *order)]]
    same = paired.where(at_first).groupBy(*paired.columns).agg(F.count(F.lit(1)).alias("_copies"))
    lowest = same.groupBy(key).agg(F.min(F.struct(*rest)).alias("_lowest"))
    left = F.col("_copies") - F.struct(*rest).eqNullSafe(F.col("_lowest")).cast("int")
    again = same.join(lowest, key).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), left.cast("int"))))
    return paired.where(~at_first).unionByName(again.select(*paired.columns))


def with_previous_reading(df: DataFrame, key: str, ts: str, tie: list[str], value: str, slice_ms: int) -> DataFrame:
    """Every reading but the first, with the previous one's ``value`` as ``anchor_value``."""
    sliced = with_slice(df, [key], time_slice(F.col(ts), slice_ms))
    order = ordering([ts, *tie])
    # values go in structs, so that a value that is null is told from a reading that is missing
    last = sliced.groupBy(key, "_slice").agg(F.max_by(F.struct(F.col(value).alias("v")), order).alias("_last"))
    handed_on = last.select(
        key, "_slice", F.lag("_last").over(Window.partitionBy(key).orderBy("_slice")).alias("_handed_on")
    )
    inside = Window.partitionBy(key, "_slice").orderBy(ts, *tie)
    numbered = sliced.withColumns({"_at": F.row_number().over(inside), "_before": F.lag(F.struct(F.col(value).alias("v"))).over(inside)})
    joined = numbered.join(handed_on, [key, "_slice"])
    anchored = joined.withColumn("anchor_value", F.when(F.col("_at") == 1, F.col("_handed_on")).otherwise(F.col("_before")))
    found = anchored.where(F.col("anchor_value").isNotNull()).withColumn("anchor_value", F.col("anchor_value.v"))
    return found.drop("_slice", "_at", "_before", "_handed_on")


def rig_statuses(paired: DataFrame) -> DataFrame:
    """Pipe, pump, top-drive and bottom status of readings that carry ``anchor_value``."""
    return paired.withColumns(
        {
            "pipe_direction": drilling.pipe_direction(F.col("anchor_value"), F.col("bitDepth")),
            "pump_status": drilling.pump_status(F.col("totalPumpOutput"), F.col("standpipePressure")),
            "top_drive_status": drilling.top_drive_status(F.col("rotaryRpm")),
            "bit_on_bottom": drilling.bit_on_bottom(F.col("bitDepth"), F.col("holeDepth")),
        }
    )


def rig_labels(paired: DataFrame) -> DataFrame:
    """The activity label of readings that carry ``anchor_value``, as ``RIGSTATE``."""
    statuses = rig_statuses(paired)
    names = ("bitDepth", "holeDepth", "pipe_direction", "pump_status", "top_drive_status", "inSlipStatus", "bit_on_bottom")
    return statuses.withColumn("RIGSTATE", drilling.rig_state(*[F.col(n) for n in names]))


def rig_state(
    df: DataFrame, tie: list[str] | None = None, reference: str = "first", slice_ms: int = 86_400_000
) -> DataFrame:
    """Label every reading against the device's first one, or against the previous one."""
    if reference == "first":
        paired = with_first_reading(df, tie=tie)
    elif reference == "previous":
        paired = with_previous_reading(df, "id", "ts", tie or [], "bitDepth", slice_ms)
    else:
        raise ValueError(f"reference is 'first' or 'previous', not {reference!r}")
    return rig_labels(paired)


# ---------------------------------------------------------------- moving anchor
#
# A reading more than `max_ms` after the anchor becomes the next anchor. That chain is a
# sequence per device, but it can be cut into time segments: where a segment is left depends
# only on where it is entered, and that is one of the readings in its first `max_ms`. So each
# segment is summarised as steps (entry bound -> anchor on exit), the summaries are walked in
# order per device, and then every segment lists its own anchors. Entered later, a segment is
# never left earlier, so entries that share an exit collapse into one step.


GROUP = ["id", "segment"]
NOT_ENTERED = np.iinfo("int64").min


def _starts(pdf: pd.DataFrame) -> np.ndarray:
    """Where a new (device, segment) group begins in sorted rows."""
    ids, segments = pdf["id"].to_numpy(), pdf["segment"].to_numpy()
    change = (ids[1:] != ids[:-1]) | (segments[1:] != segments[:-1])
    return np.concatenate([[0], np.flatnonzero(change) + 1])


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, bool, bool]]:
    """Cut sorted batches into (rows, begins, ends): whole groups, many at once, or a part of one group that spans batches.

    At most two batches are held, however large a group is.
    """
    held: pd.DataFrame | None = None
    begun = False
    for batch in batches:
        if batch.empty:
            continue
        if held is not None:
            goes_on = (held[GROUP].iloc[-1] == batch[GROUP].iloc[0]).all()
            yield held, not begun, not goes_on
            begun = bool(goes_on)
        starts = _starts(batch)
        if begun and len(starts) > 1:
            yield batch.iloc[: starts[1]], False, True
            batch, starts, begun = batch.iloc[starts[1] :], starts[1:] - starts[1], False
        if len(starts) > 1:
            yield batch.iloc[: starts[-1]], True, True
            batch = batch.iloc[starts[-1] :]
        held = batch
    if held is not None:
        yield held, not begun, True


def _layout(pdf: pd.DataFrame, max_ms: int, segment_ms: int):
    """Group bounds of each row, its offset in the segment, and the reading that would follow it as anchor.

    Offsets of different groups are moved apart by more than a segment and a reach, so that one
    search over all rows stays within each row's group.
    """
    starts = _starts(pdf)
    sizes = np.diff(np.append(starts, len(pdf)))
    group = np.repeat(np.arange(len(starts)), sizes)
    offset = pdf["ts"].to_numpy() - pdf["segment"].to_numpy() * segment_ms
    spread = group * (segment_ms + max_ms + 1) + offset
    follower = np.searchsorted(spread, spread + max_ms, side="right")
    return starts, starts + sizes, group, offset, spread, follower


def _segment_steps(pdf: pd.DataFrame, max_ms: int, segment_ms: int) -> pd.DataFrame:
    """Entry bounds and exits of whole segments; rows are distinct instants in time order."""
    starts, stops, group, offset, _, follower = _layout(pdf, max_ms, segment_ms)
    exits = np.where(follower < stops[group], follower, np.arange(len(pdf)))
    # doubling: each round follows twice as many anchors, until all stand on their last one
    while not np.array_equal(further := exits[exits], exits):
        exits = further
    # readings that can be a segment's first anchor: an earlier anchor reaches at most max_ms in
    is_entry = offset < max_ms
    is_entry[1:] |= is_entry[:-1]
    is_entry[starts] = True
    entries = np.flatnonzero(is_entry)
    ends_step = np.append((exits[entries][1:] != exits[entries][:-1]), True)
    at = entries[ends_step]
    ts = pdf["ts"].to_numpy()
    return pd.DataFrame({"id": pdf["id"].to_numpy()[at], "segment": pdf["segment"].to_numpy()[at], "entry_ts": ts[at], "exit_ts": ts[exits[at]]})


def _settled(follower: np.ndarray) -> np.ndarray:
    """The last anchor among these rows that each row leads to, as anchors follow one another."""
    rows = np.arange(len(follower))
    exits = np.where(follower < len(follower), follower, rows)
    while not np.array_equal(further := exits[exits], exits):
        exits = further
    return exits


class _StepCursor:
    """The steps of one segment, read a batch at a time.

    Held are the ways through the segment so far: entry bounds and the anchors they have led to.
    There are no more of them than readings in the segment's first ``max_ms``, and fewer as ways meet.
    """

    def __init__(self, max_ms: int, segment_ms: int):
        self.max_ms, self.segment_ms = max_ms, segment_ms
        self.entry = self.anchor = np.zeros(0, dtype="int64")
        self.after_entry = True

    def add(self, pdf: pd.DataFrame) -> None:
        ts = pdf["ts"].to_numpy()
        exits = ts[_settled(np.searchsorted(ts, ts + self.max_ms, side="right"))]
        following = np.searchsorted(ts, self.anchor + self.max_ms, side="right")
        moved = following < len(ts)
        led = np.where(moved, exits[np.minimum(following, len(ts) - 1)], self.anchor)
        early = ts - pdf["segment"].to_numpy() * self.segment_ms < self.max_ms
        is_entry = early | np.append(self.after_entry, early[:-1])
        self.after_entry = bool(early[-1])
        entry, anchor = np.append(self.entry, ts[is_entry]), np.append(led, exits[is_entry])
        ends_step = np.append(anchor[1:] != anchor[:-1], True)
        self.entry, self.anchor = entry[ends_step], anchor[ends_step]


class _AnchorCursor:
    """The anchors of one segment, read a batch at a time; held is the current one."""

    def __init__(self, entered: int, max_ms: int):
        self.current = None if entered == NOT_ENTERED else entered
        self.max_ms = max_ms

    def add(self, pdf: pd.DataFrame) -> pd.DataFrame:
        ts = pdf["ts"].to_numpy()
        follower = np.searchsorted(ts, ts + self.max_ms, side="right")
        at = 0 if self.current is None else int(np.searchsorted(ts, self.current + self.max_ms, side="right"))
        found = []
        while at < len(ts):
            found.append(at)
            self.current = int(ts[at])
            at = int(follower[at])
        return _named_anchors(pdf.iloc[found])


def _named_anchors(found: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"id": found["id"], "anchor_ts": found["ts"], "anchor_value": found["value"]})


def _all_steps(batches: Iterator[pd.DataFrame], max_ms: int, segment_ms: int) -> Iterator[pd.DataFrame]:
    cursor = None
    for pdf, begins, ends in _parts(batches):
        if begins and ends:
            yield _segment_steps(pdf, max_ms, segment_ms)
            continue
        cursor = _StepCursor(max_ms, segment_ms) if begins else cursor
        cursor.add(pdf)
        if ends:
            yield pd.DataFrame({"id": pdf["id"].iloc[0], "segment": pdf["segment"].iloc[0], "entry_ts": cursor.entry, "exit_ts": cursor.anchor})


def _all_anchors(batches: Iterator[pd.DataFrame], max_ms: int, segment_ms: int) -> Iterator[pd.DataFrame]:
    cursor = None
    for pdf, begins, ends in _parts(batches):
        if begins and ends:
            yield _segment_anchors(pdf, max_ms, segment_ms)
            continue
        cursor = _AnchorCursor(int(pdf["entered_ts"].iloc[0]), max_ms) if begins else cursor
        yield cursor.add(pdf)


def _walk_steps(batches: Iterator[pd.DataFrame], max_ms: int) -> Iterator[pd.DataFrame]:
    """Walk the segments of each device in order, passing the anchor's time on.

    Rows come sorted by device, segment and entry; the state is the current anchor, and how the present
    segment was entered and is left.
    """
    device, anchor, entered, leave = None, None, NOT_ENTERED, None
    for pdf, begins, _ in _parts(batches):
        starts = _starts(pdf)
        stops = np.append(starts[1:], len(pdf))
        ids, entry, exits = pdf["id"].to_numpy(), pdf["entry_ts"].to_numpy(), pdf["exit_ts"].to_numpy()
        told = np.full(len(starts), NOT_ENTERED)
        for number, (lo, hi) in enumerate(zip(starts, stops)):
            if begins or number:
                anchor = leave if leave is not None else anchor
                if ids[lo] != device:
                    device, anchor = ids[lo], None
                entered, leave = NOT_ENTERED if anchor is None else anchor, None
            if leave is None:
                first = lo if anchor is None else lo + int(np.searchsorted(entry[lo:hi], anchor + max_ms, side="right"))
                leave = int(exits[first]) if first < hi else None
            told[number] = entered
        fresh = starts if begins else starts[1:]
        yield pd.DataFrame({"id": ids[fresh], "segment": pdf["segment"].to_numpy()[fresh], "entered_ts": told[len(starts) - len(fresh) :]})


def _segment_anchors(pdf: pd.DataFrame, max_ms: int, segment_ms: int) -> pd.DataFrame:
    """The anchors that lie in whole segments, each entered with the anchor in ``entered_ts``."""
    starts, stops, _, _, spread, follower = _layout(pdf, max_ms, segment_ms)
    entered = pdf["entered_ts"].to_numpy()[starts]
    reach = np.maximum(entered, NOT_ENTERED + segment_ms) + max_ms - pdf["segment"].to_numpy()[starts] * segment_ms
    base = np.arange(len(starts)) * (segment_ms + max_ms + 1)
    # an anchor left long ago reaches no reading here, nor does a missing one
    current = np.searchsorted(spread, base + np.maximum(reach, -1), side="right")
    current = np.where(entered == NOT_ENTERED, starts, current)
    is_anchor = np.zeros(len(pdf), dtype=bool)
    while len(current):
        inside = current < stops
        current, stops = current[inside], stops[inside]
        is_anchor[current] = True
        current = follower[current]
    return _named_anchors(pdf[is_anchor])


def anchors(
    df: DataFrame, max_ms: int, key: str = "id", ts: str = "ts", value: str = "blockPosition",
    tie: list[str] | None = None, segment_windows: int = 128, partitions: int | None = None,
) -> DataFrame:
    """The readings of each device that serve as anchors: (id, anchor_ts, anchor_value).

    Whole segments are kept together by an explicit partition count (``partitions``, else
    ``spark.sql.shuffle.partitions``), which adaptive execution neither splits nor merges. Both
    passes over the segments share one shuffle. A segment is read by a cursor, so a task holds two
    batches and the ways through the segment it is in, not the segment.
    """
    instants = df.groupBy(F.col(key).alias("id"), F.col(ts).alias("ts")).agg(
        F.min_by(value, ordering(tie or [value])).alias("value")
    )
    segment_ms = max_ms * segment_windows
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind, number = dict(df.dtypes)[key], dict(df.dtypes)[value]
    cut = with_slice(instants, ["id"], time_slice(F.col("ts"), segment_ms), "segment").repartition(parts, *GROUP)

    steps = cut.sortWithinPartitions(*GROUP, "ts").mapInPandas(
        lambda batches: _all_steps(batches, max_ms, segment_ms), f"id {kind}, segment bigint, entry_ts bigint, exit_ts bigint"
    )
    entered = (
        steps.repartition(parts, "id")
        .sortWithinPartitions(*GROUP, "entry_ts")
        .mapInPandas(lambda batches: _walk_steps(batches, max_ms), f"id {kind}, segment bigint, entered_ts bigint")
    )
    placed = cut.join(entered.repartition(parts, *GROUP).hint("merge"), GROUP)
    return placed.sortWithinPartitions(*GROUP, "ts").mapInPandas(
        lambda batches: _all_anchors(batches, max_ms, segment_ms), f"id {kind}, anchor_ts bigint, anchor_value {number}"
    )


def with_moving_anchor(
    df: DataFrame, min_ms: int, max_ms: int, key: str = "id", ts: str = "ts", value: str = "blockPosition",
    tie: list[str] | None = None, segment_windows: int = 128, partitions: int | None = None,
) -> DataFrame:
    """Readings between ``min_ms`` and ``max_ms`` after their anchor, with its time and value.

    A reading is never more than ``max_ms`` after its anchor, so time buckets of that length hold
    at most one anchor each and a reading's anchor lies in its own bucket or the one before.
    """
    if min_ms <= 0 or max_ms < min_ms:
        raise ValueError("needs 0 < min_ms <= max_ms")
    return paired_with(df, anchors(df, max_ms, key, ts, value, tie, segment_windows, partitions), min_ms, max_ms, key, ts)


def paired_with(df: DataFrame, found: DataFrame, min_ms: int, max_ms: int, key: str = "id", ts: str = "ts") -> DataFrame:
    """Readings between ``min_ms`` and ``max_ms`` after their anchor in ``found``, as ``anchors`` lists them."""
    bucket = time_slice(F.col("anchor_ts"), max_ms)
    anchor = F.struct("anchor_ts", "anchor_value")
    reach = found.select("id", anchor.alias("anchor"), F.explode(F.array(bucket, bucket + 1)).alias("bucket"))
    per_bucket = reach.groupBy(F.col("id").alias(key), "bucket").agg(
        F.max("anchor").alias("latest"), F.min("anchor").alias("earliest")
    )
    rows = df.withColumn("bucket", time_slice(F.col(ts), max_ms))
    joined = rows.join(per_bucket, [key, "bucket"])
    chosen = F.when(F.col("latest.anchor_ts") <= F.col(ts), F.col("latest")).otherwise(F.col("earliest"))
    paired = joined.withColumn("anchor", chosen).select(*df.columns, "anchor.*")
    gap = F.col(ts) - F.col("anchor_ts")
    return paired.where((gap >= min_ms) & (gap <= max_ms))


def block_movement(paired: DataFrame, ts: str = "ts", value: str = "blockPosition") -> DataFrame:
    """Direction, its name and velocity of readings paired with an anchor."""
    before, after = F.col("anchor_value"), F.col(value)
    return paired.withColumns(
        {
            "BDIR": drilling.direction(before, after),
            "BDIRTEXT": drilling.direction_text(before, after),
            "BVEL": drilling.velocity(before, after, F.col("anchor_ts"), F.col(ts)),
        }
    )
