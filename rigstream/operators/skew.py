"""Joins and ordered passes that hold when one key owns a large share of the rows.

A device's rows are never sent whole to one task. Ordered work is cut into time
slices: each slice is handled on its own, and a small table with one row per
device and slice carries the boundary values from slice to slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rigstream.session import materialised

BROADCAST_BYTES = 64 * 1024 * 1024
# a key is hot when it owns more than 1/HOT_SHARE of the rows, so there are fewer than HOT_SHARE of them
HOT_SHARE = 1000


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    row_count: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner-join ``rows`` to a table with one row per key; ``row_count`` is the key's number of rows.

    The per-key table is computed once and measured. When it is small it is broadcast and
    ``rows`` do not move. Otherwise only the hot keys, fewer than ``HOT_SHARE``, are broadcast
    and the remaining keys, none of them large, are joined by a shuffle.
    """
    per_key = materialised(per_key)
    width = sum((F.length(F.col(c).cast("string")) for c in keys), F.lit(64 + 16 * len(per_key.columns)))
    for name, kind in per_key.dtypes:
        if kind.startswith(("array", "struct", "map")):
            width = width + F.length(F.to_json(F.struct(name)))
    size, total = per_key.agg(F.sum(width), F.sum(row_count)).first()
    if (size or 0) <= broadcast_bytes:
        return rows.join(F.broadcast(per_key.drop(row_count)), keys)
    is_hot = F.col(row_count) * HOT_SHARE > F.lit(total)
    hot = per_key.where(is_hot).drop(row_count)
    cold = per_key.where(~is_hot).drop(row_count)
    by_broadcast = rows.join(F.broadcast(hot), keys)
    by_shuffle = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold.hint("merge"), keys)
    return by_broadcast.unionByName(by_shuffle)


def time_slice(ts: Column, slice_ms: int) -> Column:
    """The number of the time slice ``ts`` falls in."""
    return F.call_function("floor", ts / F.lit(slice_ms)).cast("bigint")


def with_slice(df: DataFrame, keys: list[str], number: Column, into: str = "_slice") -> DataFrame:
    """Add the slice number and keep the rows that have keys and a slice.

    A join on them asks for that anyway. Said here, it holds on every branch of a plan, so that
    branches over the same slices share one shuffle.
    """
    known = F.col(into).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    return df.withColumn(into, number).where(known)


def ordering(columns: list[str]) -> Column:
    """What rows are ordered by: one column as it is, several as a struct.

    A struct makes Spark aggregate by sorting, a number lets it aggregate by hashing.
    """
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def one_per_instant(df: DataFrame, keys: list[str], ts: str, tie: list[str], values: list[str]) -> DataFrame:
    """The last row of each key and instant, copies being merged before the shuffle."""
    latest = F.max_by(ordering(values), ordering(tie or values)).alias("_kept")
    grouped = df.groupBy(*keys, ts).agg(latest)
    if len(values) == 1:
        return grouped.withColumnRenamed("_kept", values[0])
    return grouped.select(*keys, ts, *[f"_kept.{v}" for v in values])


def with_lags(df: DataFrame, keys: list[str], ts: str, value: str, lags: int, slice_ms: int, into: str = "lags") -> DataFrame:
    """Add the ``lags`` previous values of each row, latest first; null before the series starts.

    ``df`` holds one row per key and instant.
    """
    sliced = with_slice(df, keys, time_slice(F.col(ts), slice_ms))
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(ts)
    numbered = sliced.withColumns(
        {
            "_at": F.row_number().over(in_slice),
            "_left": F.count(F.lit(1)).over(Window.partitionBy(*keys, "_slice")) - F.row_number().over(in_slice),
            # lists leave nulls out, so values go in structs
            "_near": F.collect_list(F.struct(F.col(value).alias("v"))).over(in_slice.rowsBetween(-lags, -1)),
        }
    )
    # the first row and the last `lags` rows of every slice are enough to hand values on
    edges = numbered.where((F.col("_at") == 1) | (F.col("_left") < lags)).select(*keys, "_slice", ts, "_at", value)
    over_edges = Window.partitionBy(*keys).orderBy(ts).rowsBetween(-lags, -1)
    carried = (
        edges.withColumn("_far", F.collect_list(F.struct(F.col(value).alias("v"))).over(over_edges))
        .where(F.col("_at") == 1)
        .select(*keys, "_slice", "_far")
    )
    joined = numbered.join(carried, [*keys, "_slice"])
    # within a slice the nearest values come from the slice, the rest from what was carried in
    before = F.transform(F.reverse(F.concat("_far", "_near")), lambda x: x["v"])
    padded = F.concat(before, F.array_repeat(F.lit(None).cast(df.schema[value].dataType), lags))
    return joined.withColumn(into, F.slice(padded, 1, lags)).drop("_slice", "_at", "_left", "_near", "_far")
