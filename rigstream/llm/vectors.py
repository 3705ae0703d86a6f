"""Vectors of whole numbers, packed for the way between tasks, and their exact inner products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

LEAST, MOST = np.iinfo("int64").min, np.iinfo("int64").max
#: Whole numbers up to this size are exact as floating point numbers.
EXACT = 2.0**53


def packed(rows: DataFrame, scale: int, vector: str) -> DataFrame:
    """``rows`` with ``dims`` and ``v``, the whole numbers floor(scale * x) as bytes, in place of ``vector``.

    Rows whose vector is null or empty, has a null or non-finite component, or one that is not finite
    once scaled, are left out. Small numbers take two bytes, others eight.
    """
    sound = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    others = [c for c in rows.columns if c != vector]
    known = rows.select(*others, F.col(vector).cast("array<double>").alias("_v")).where((F.size("_v") > 0) & sound)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_v")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                whole = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            ends = np.cumsum(sizes)
            parts, keep = [], np.ones(len(sizes), bool)
            for i, (end, size) in enumerate(zip(ends, sizes)):
                v = whole[end - size : end]
                largest = np.abs(v).max()
                keep[i] = np.isfinite(largest)
                parts.append((v.astype("<i2") if largest < 2**15 else v).tobytes())
            made = [*(batch.column(c) for c in others), pa.array(sizes, pa.int32()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=[*others, "dims", "v"]).filter(pa.array(keep))

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes if name != vector)
    return known.mapInArrow(pack, f"{kinds}, dims int, v binary")


def unpacked(values: pa.ChunkedArray, dims: int) -> np.ndarray:
    """The rows of a column of packed vectors of one length."""
    parts = values.to_pylist()
    out = np.empty((len(parts), dims))
    short = np.array([len(p) == 2 * dims for p in parts], bool)
    for mine, kind in ((short, "<i2"), (~short, "<f8")):
        at = np.flatnonzero(mine)
        if len(at):
            out[at] = np.frombuffer(b"".join(parts[i] for i in at), kind).reshape(len(at), dims)
    return out


def are_small(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all sums of products of rows of both are exact as floating point numbers."""
    return bool(np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT)


def products(a: np.ndarray, b: np.ndarray, small: bool | None = None) -> np.ndarray:
    """Exact inner products of rows of whole numbers, cut to 64 bits; ``small`` as ``are_small`` says, if known."""
    if are_small(a, b) if small is None else small:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(a) @ whole(b).T, int(LEAST), int(MOST)).astype(np.int64)
