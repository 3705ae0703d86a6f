"""Counts per batch, taken while the batch runs.

``observed`` adds aggregates to a plan that are computed as its rows pass by; ``BatchCounts`` gathers them from the
progress of running queries, so no second query is run for them. Batches without rows are noted as well, with zeros.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from rigstream.operators import decode


def observed(df: DataFrame, name: str, **counts: Column) -> DataFrame:
    """``df`` unchanged; ``rows`` and further ``counts`` (aggregates, such as ``F.count_if(...)``) are observed under ``name``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])


def observed_decode(records: DataFrame, name: str = "decode") -> DataFrame:
    """What ``decode.decode_record`` gave, with the rows ``read`` and ``quarantined`` observed; only the others stay."""
    bad = F.coalesce(F.count_if(F.col(decode.ERROR).isNotNull()), F.lit(0))
    return decode.decoded(observed(records, name, quarantined=bad))


class BatchCounts(StreamingQueryListener):
    """Listener that keeps the observed counts of every batch: ``counts`` by query name, name of the counts and batch."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str | None, str, int], dict[str, int]] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            for name, row in progress.observedMetrics.items():
                found = {k: v or 0 for k, v in row.asDict().items()}
                self.counts[progress.name, name, progress.batchId] = found

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, query: str | None, name: str, count: str = "rows") -> int:
        """The sum of one count over the batches of a query."""
        with self._lock:
            return sum(row.get(count, 0) for (q, n, _), row in self.counts.items() if (q, n) == (query, name))


def gather(spark: SparkSession) -> BatchCounts:
    """A listener that is already listening; ``spark.streams.removeListener`` ends it."""
    listener = BatchCounts()
    spark.streams.addListener(listener)
    return listener
