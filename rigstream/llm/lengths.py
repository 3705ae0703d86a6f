"""Token counts: an exact histogram of encoded lengths and its suffix sums.

Documents are counted by encoded length; every later question is a sum over the histogram, which
has at most as many rows as the longest document has tokens. Suffix sums run in two steps, inside
spans of lengths and over the spans, so that no task orders all lengths.

A null text is empty and has length 0. Empty input gives no rows, repeated rows count each.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField

from rigstream.llm.common import map_rows, once
from rigstream.session import materialised

#: Lengths that one step of the suffix sums orders together.
SPAN = 1024


def _encoding(rank_file: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def step(texts: pa.Array) -> list[pa.Array]:
        encoding = once(shared, lambda data: _encoding(data, pattern))
        return [pa.array([len(encoding.encode_ordinary(t)) if t else 0 for t in texts.to_pylist()], pa.int64())]

    return map_rows(docs, [StructField(into, LongType())], text, step)


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """Documents per encoded length; combined before the shuffle."""
    return lengths.groupBy(F.col(column).cast("long").alias("length")).agg(F.count(F.lit(1)).alias("docs"))


def limits(hist: DataFrame) -> DataFrame:
    """One row per length that occurs, read as a context limit.

    ``docs`` and ``tokens`` of that length, ``docs_longer`` and ``tokens_longer`` of greater ones,
    ``tokens_kept`` when every document is cut at the limit, ``share_fitting`` of the documents that
    need no cut. Between two lengths that occur, ``tokens_kept`` grows by ``docs_longer`` a step.
    """
    # computed once, as rows and spans both come from it
    hist = materialised(hist)
    rows = hist.withColumns({"tokens": F.col("length") * F.col("docs"), "_span": F.floor(F.col("length") / SPAN)})
    spans = rows.groupBy("_span").agg(F.sum("docs").alias("_d"), F.sum("tokens").alias("_t"))
    beyond = Window.orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = spans.select(
        "_span",
        *[F.coalesce(F.sum(c).over(beyond), F.lit(0)).alias(f"{c}_beyond") for c in ("_d", "_t")],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in ("_d", "_t")],
    )
    inside = Window.partitionBy("_span").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    longer = {c: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"{k}_beyond") for c, k in (("docs", "_d"), ("tokens", "_t"))}
    joined = rows.join(spans, "_span").withColumns({"docs_longer": longer["docs"], "tokens_longer": longer["tokens"]})
    return joined.select(
        "length", "docs", "tokens", "docs_longer", "tokens_longer",
        (F.col("_t_all") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")).alias("tokens_kept"),
        ((F.col("_d_all") - F.col("docs_longer")) / F.col("_d_all")).alias("share_fitting"),
    )


def quantile(answers: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of the documents do not exceed."""
    return answers.where(F.col("share_fitting") >= share).agg(F.min("length").alias("length"))


def totals_at(answers: DataFrame, limit: int) -> DataFrame:
    """Tokens kept and documents cut at any limit, also one that no document has as its length."""
    kept = F.when(F.col("length") <= limit, F.col("tokens")).otherwise(F.col("docs") * limit)
    cut = F.when(F.col("length") > limit, F.col("docs")).otherwise(0)
    return answers.agg(F.coalesce(F.sum(kept), F.lit(0)).alias("tokens_kept"), F.coalesce(F.sum(cut), F.lit(0)).alias("docs_cut"))
