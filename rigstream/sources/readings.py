"""Stored telemetry by day, so that retention and time ranges open only the days they need.

Rows lie in folders ``_day=<days since 1970>``. Before they are written they are rebalanced by day and a hash of
the device, so that a batch writes a few files of even size for each day, however many tasks it came from and
however much of it one device has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rigstream.operators.skew import time_slice

DAY = "_day"
DAY_MS = 86_400_000


@dataclass(frozen=True)
class ReadingTable:
    """Telemetry of one layout (``ddl``): its place, time in epoch milliseconds and device."""

    path: str
    ddl: str
    ts: str = "ts"
    device: str = "id"
    #: parts that a day's rows of one batch are dealt to at most
    parts: int = 8

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Store a batch; writing the same batch again replaces it. Rows without a time are left out."""
        named = rows.withColumns({DAY: time_slice(F.col(self.ts), DAY_MS), "_part": F.pmod(F.hash(self.device), F.lit(self.parts))})
        even = named.where(F.col(DAY).isNotNull()).hint("rebalance", F.col(DAY), F.col("_part")).drop("_part")
        even.write.mode("overwrite").partitionBy(DAY).parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession, first_ms: int | None = None, last_ms: int | None = None) -> DataFrame:
        """The readings from ``first_ms`` on up to ``last_ms``; other days' files are not opened."""
        # of a batch that was empty there is only its folder
        found = spark.read.schema(f"{self.ddl}, batch_id bigint, {DAY} bigint").option("basePath", self.path).parquet(self.path)
        if first_ms is not None:
            found = found.where((F.col(DAY) >= first_ms // DAY_MS) & (F.col(self.ts) >= first_ms))
        if last_ms is not None:
            found = found.where((F.col(DAY) <= last_ms // DAY_MS) & (F.col(self.ts) <= last_ms))
        return found.drop("batch_id", DAY)

    def retained(self, spark: SparkSession, as_of_ms: int, days: int = 365) -> DataFrame:
        """The readings that are not older than ``days`` days."""
        return self.read(spark, first_ms=as_of_ms - days * DAY_MS)
