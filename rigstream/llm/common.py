"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any, TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from rigstream.session import materialised

T = TypeVar("T")
#: Fixed values of the contracts: words are what stands between these characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters of text that one step inside a task holds at once.
STEP_CHARS = 250_000
#: A table goes to every task up to this size.
BROADCAST_BYTES = 48 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def measured(df: DataFrame) -> DataFrame:
    """``df``, computed once, marked to go to every task if it is at most BROADCAST_BYTES large.

    For joins with texts: a bounded table lets the texts stay where they are, a larger one is joined
    by a shuffle.
    """
    df = materialised(df)
    widths = {"long": 8, "bigint": 8, "int": 4, "boolean": 1, "binary": 40, "string": 40}
    nested = [name for name, kind in df.dtypes if kind.startswith(("array", "struct", "map"))]
    inside = sum((F.length(F.to_json(F.struct(F.col(f"`{name}`")))) for name in nested), F.lit(0))
    count, more = df.agg(F.count(F.lit(1)), F.sum(inside)).first()
    size = count * (32 + sum(widths.get(kind, 64) for _, kind in df.dtypes)) + (more or 0)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


@contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Hand rows to Python and back in batches of ``size`` bytes meanwhile; a single longer row is a batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def once(shared: Broadcast, make: Callable[[Any], T]) -> T:
    """What ``make`` builds of a broadcast value, built once in each Python worker."""
    if "_made" not in shared.__dict__:
        shared._made = make(shared.value)
    return shared._made


def with_fields(df: DataFrame, fields: list[StructField]) -> StructType:
    """The schema of ``df`` with ``fields`` put last; input columns of their names give way."""
    new = {f.name.lower() for f in fields}
    return StructType([f for f in df.schema.fields if f.name.lower() not in new] + fields)


def map_rows(df: DataFrame, fields: list[StructField], column: str, step: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """Add ``fields``, which ``step`` makes of the values of one column, some megabytes at a time.

    Other columns pass through as Arrow arrays; input columns with the names of ``fields`` are replaced.
    """
    schema = with_fields(df, fields)
    kept = [f.name for f in schema.fields[: len(schema.fields) - len(fields)]]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, column):
                made = step(part.column(column))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], names=names)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds one row or at most STEP_CHARS bytes (or items) of a column."""
    values = batch.column(column)
    kind = values.type
    count = pc.list_value_length if pa.types.is_list(kind) or pa.types.is_large_list(kind) else pc.binary_length
    sizes = pc.fill_null(count(values), 0).to_pylist()
    begin = total = 0
    for i, n in enumerate(sizes):
        if total + n > STEP_CHARS and i > begin:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield batch.slice(begin)
