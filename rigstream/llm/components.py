"""Connected components of a table of links, by smallest labels and jumps along them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rigstream.llm.common import BROADCAST_BYTES
from rigstream.session import materialised

#: What a node and its label take of a broadcast table.
NODE_BYTES = 48
#: Links or nodes that one task handles at least.
TASK_ROWS = 100_000


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for each node of ``links`` (a, b).

    A round sends labels over the links and then replaces a label by the label of that label, so
    rounds grow with the logarithm of a component's width. Each round is cut by a checkpoint.
    Rounds have as many tasks as their rows need, and labels go to every task while they are small.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = _dealt(materialised(both))
    labels = materialised(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    nodes = labels.count()
    labels, small = _dealt(labels, nodes), nodes * NODE_BYTES <= BROADCAST_BYTES
    while True:
        known = F.broadcast(labels) if small else labels
        sent = edges.join(known.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("sent"))
        met = sent.join(known, "node").select("node", "label", F.least("label", "sent").alias("new"))
        ahead = known.select(F.col("node").alias("new"), F.col("label").alias("ahead"))
        moved = met.join(ahead, "new").select("node", "label", F.least("new", "ahead").alias("new"))
        moved = materialised(_dealt(moved, nodes))
        labels = moved.select("node", F.col("new").alias("label"))
        if moved.where("new < label").isEmpty():
            return labels


def _dealt(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in no more partitions than its rows need."""
    return df.coalesce(-(-(df.count() if rows is None else rows) // TASK_ROWS) or 1)
