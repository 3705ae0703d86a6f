"""Mixing sources to target weights by the cube method.

Every document has an expected number of copies, its source's target over its source's size. The
whole part is taken; the fraction is an inclusion probability that is rounded to 0 or 1. Vectors of
probabilities are points of a cube. In the flight, steps along the null space of the constraints
(words and documents of the source) move three fractional documents at a time until one of them
lands on a face, so both totals stay exact. At most two documents per block stay fractional. They
meet those of other blocks of the source in further flights. At last the two that a source has left
land together with RESERVE documents held back from the last flight: of all ways to round these, the
one whose totals are nearest is taken.

Documents of a source fly in blocks of about ``BLOCK``, dealt by a hash, so a source with a third of
all rows is many tasks, and a step of the next level joins ``FAN`` blocks. The draws come from a hash
of source and block, so reruns agree. Only identifiers and sizes are shuffled.

Size: words of the text; a null or empty text has size 0 and stays in the mix as it is drawn. Null
sources are a source, last in order. Of n identical rows (id, source, text) with a fraction f, floor(n f) are
taken once more, and one further row is drawn for the rest; so a row that is often repeated
misses its target by less than one copy. Without rows or words every target is 0. Input columns named like a result
column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rigstream.llm.common import WORD, measured
from rigstream.session import materialised

BLOCK = 2_000
FAN = 1_000
RESERVE = 12
#: Fixed values of the contract: weights repeat over the sources in order; the mix's size against
#: all sizes; a source's target against its size at most.
WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0
EDGE = 1e-9
_UNIT_SCHEMA = "_key binary, _source string, _size double, _part double, _extra int"


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size).

    The total is dealt by weight; a target stops at ``most`` times its source's size, and the excess
    is dealt again. Sources fill in the order of their limits over their weights, so running sums
    over that order say which ones are full and what level the others reach.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    known = sizes.withColumn("_w", F.element_at(pattern, (F.row_number().over(order) - 1) % len(weights) + 1))
    known = known.withColumn("_cap", most * F.col("source_size"))
    rising = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    below = rising.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(below), F.lit(0.0))
    open_weight = F.sum("_w").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # the level that all sources from here on would reach; the first one that holds everywhere counts
    known = known.withColumn("_level", left / open_weight)
    known = known.withColumn("_level", F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level")))
    level = F.first("_level", ignorenulls=True).over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    full = F.col("_cap")
    return known.withColumn("_level", level).select(
        "source", "source_size", F.coalesce(F.least(F.col("_level") * F.col("_w"), full), full).alias("target")
    )


def _seed(source: str | None, block: int, level: int) -> np.random.Generator:
    import zlib

    name = zlib.crc32(("\0" if source is None else "s" + source).encode("utf-8"))
    return np.random.default_rng([name, block, level])


def flight(sizes: list[float], parts: list[float], draw: np.random.Generator) -> list[float]:
    """Move ``parts`` along the null space of (size, 1) until at most two are neither 0 nor 1."""
    done = list(parts)
    held: list[int] = []
    chances = draw.random(len(parts) + 3).tolist()
    for i, part in enumerate(parts):
        if part <= EDGE or part >= 1 - EDGE:
            done[i] = float(round(part))
            continue
        held.append(i)
        while len(held) == 3:
            a, b, c = held
            step = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
            if not any(step):
                step = (1.0, -1.0, 0.0)
            _move(done, held, step, chances)
            held = [k for k in held if EDGE < done[k] < 1 - EDGE]
    if len(held) == 2 and sizes[held[0]] == sizes[held[1]]:
        _move(done, held, (1.0, -1.0), chances)
        held = [k for k in held if EDGE < done[k] < 1 - EDGE]
    kept = set(held)
    return [v if k in kept or v in (0.0, 1.0) else float(round(v)) for k, v in enumerate(done)]


def _move(done: list[float], held: list[int], step: Sequence[float], chances: list[float]) -> None:
    """One step up or down to a face of the cube, each as likely as keeps the expectation."""
    up = min((1 - done[k]) / s if s > 0 else -done[k] / s for k, s in zip(held, step) if s)
    down = min(done[k] / s if s > 0 else (done[k] - 1) / s for k, s in zip(held, step) if s)
    by = up if chances.pop() * (up + down) < down else -down
    for k, s in zip(held, step):
        done[k] += by * s


def landing(sizes: list[float], parts: list[float]) -> list[float]:
    """Round the at most RESERVE + 2 parts that are left so that words and documents miss least."""
    open_ = [k for k, v in enumerate(parts) if EDGE < v < 1 - EDGE]
    rounded = [float(round(v)) for v in parts]
    if open_:
        size, part = np.array(sizes)[open_], np.array(parts)[open_]
        choices = np.arange(1 << len(open_))[:, None] >> np.arange(len(open_)) & 1
        words, count = choices @ size - size @ part, choices.sum(1) - part.sum()
        best = choices[np.argmin(np.abs(words) / max(1.0, size.mean()) + np.abs(count) / len(open_))]
        for k, chosen in zip(open_, best.tolist()):
            rounded[k] = float(chosen)
    return rounded


def last_flight(sizes: list[float], parts: list[float], draw: np.random.Generator) -> list[float]:
    """The flight and the landing of a source's last block.

    Two documents alone could miss the totals by half a long text, so RESERVE documents of all
    sizes wait for the landing, whose every outcome is tried.
    """
    open_ = [k for k, v in enumerate(parts) if EDGE < v < 1 - EDGE]
    waiting = {open_[i * len(open_) // RESERVE] for i in range(RESERVE)} if len(open_) > RESERVE + 2 else set(open_)
    flying = [k for k in range(len(parts)) if k not in waiting]
    done = list(parts)
    for k, v in zip(flying, flight([sizes[k] for k in flying], [parts[k] for k in flying], draw)):
        done[k] = v
    return landing(sizes, done)


def _fly(level: int, last: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # the largest first, so that what is left for the landing is small
        rows = rows.sort_values(["_size", "_key"], ascending=False, kind="stable")
        source, block = (None if pd.isna(key[0]) else key[0]), int(key[1])
        sizes = rows["_size"].tolist()
        fly = last_flight if last else flight
        parts = fly(sizes, rows["_part"].tolist(), _seed(source, block, level))
        settled = np.array([v in (0.0, 1.0) for v in parts], bool)
        values = np.array(parts)
        rows["_part"] = np.where(settled, 0.0, values)
        rows["_extra"] = np.where(settled, values, -1).astype(np.int32)
        return rows[["_key", "_source", "_size", "_part", "_extra"]]

    return run


def round_parts(units: DataFrame, most_rows: int, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Round the fractions of ``units`` (_key, _source, _size, _part) to ``_extra``, 0 or 1."""
    blocks = -(-most_rows // block)
    units = units.withColumn("_block", F.pmod(F.xxhash64("_key"), F.lit(max(1, blocks))))
    settled, level = [], 0
    while True:
        last = blocks <= 1
        flown = units.groupBy("_source", "_block").applyInPandas(_fly(level, last), _UNIT_SCHEMA)
        if last:
            settled.append(flown)
            break
        flown = materialised(flown)
        settled.append(flown.where(F.col("_extra") >= 0))
        blocks, level = -(-blocks // fan), level + 1
        units = flown.where(F.col("_extra") < 0).drop("_extra").withColumn("_block", F.pmod(F.xxhash64("_key"), F.lit(blocks)))
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    return found.select("_key", "_extra")


def _key(doc_id: str, source: str, text: str) -> Column:
    """A digest that tells rows apart by id, source and text."""
    parts = [F.coalesce(F.hex(F.col(c).cast("string")), F.lit("null")) for c in (doc_id, source)]
    content = F.coalesce(F.sha1(F.col(text).cast("binary")), F.lit("null"))
    return F.unhex(F.sha1(F.concat_ws("|", *parts, content).cast("binary")))


def sized(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Identifier, source, size and key of each row."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), _key(doc_id, source, text).alias("_key"))


def _placed(rows: DataFrame) -> DataFrame:
    """Add ``_place``, a row's number among those of its ``_key``, from 0.

    ``rows`` are stored and have ``_part``, the number of their partition, so that no key comes to one task.
    """
    inside = Window.partitionBy("_key", "_part").orderBy(F.lit(1))
    held = rows.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_held"))
    before = F.sum("_held").over(Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.select("_key", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_nth", F.row_number().over(inside)).join(starts, ["_key", "_part"])
    return numbered.withColumn("_place", F.col("_before") + F.col("_nth") - 1).drop("_before", "_nth", "_part")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of each row of ``docs``.

    ``_key`` tells the row, for ``apply``.
    """
    rows = materialised(sized(docs).withColumn("_part", F.spark_partition_id()))
    units = rows.groupBy("_key").agg(
        F.first("source").alias("_source"), F.first("size").alias("_one"), F.count(F.lit(1)).alias("_n")
    )
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    most_rows = sums.agg(F.max("_rows")).first()[0] or 0
    goal = targets(sums.drop("_rows"), weights, share, most)
    per_source = goal.withColumn(
        "_copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    each = per_source.select(F.col("source").alias("_s"), "_copies")
    units = units.join(each, F.col("_source").eqNullSafe(F.col("_s")))
    # what n equal rows take beyond the whole part, together
    more = F.col("_n") * (F.col("_copies") - F.floor("_copies"))
    units = materialised(units.withColumns({"_sure": F.floor(more), "_part": more - F.floor(more)}).drop("_s", "_copies"))
    rounded = round_parts(units.select("_key", "_source", F.col("_one").cast("double").alias("_size"), "_part"), most_rows, block)
    dealt = rounded.join(units.select("_key", "_n", "_sure"), "_key").select("_key", "_n", (F.col("_sure") + F.col("_extra")).alias("_more"))
    named = rows.join(per_source.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    several = measured(units.where("_n > 1").select("_key"))
    alone = named.join(several, "_key", "left_anti").drop("_part").withColumn("_place", F.lit(0).cast("long"))
    placed = alone.unionByName(_placed(named.join(several, "_key", "left_semi")))
    copies = (F.floor("_copies") + (F.col("_place") < F.col("_more")).cast("int")).cast("long")
    return placed.join(dealt.drop("_n"), "_key").select(
        "_key", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def apply(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` takes it."""
    counted = mixed.groupBy("_key").agg(F.min("copies").alias("_least"), F.sum("copies").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    taken = materialised(counted.where("_sum > 0").withColumn("_more", F.col("_sum") - F.col("_n") * F.col("_least")))
    keyed = docs.withColumn("_key", _key("doc_id", "source", "text"))
    even = keyed.join(measured(taken.where("_more = 0").select("_key", "_least")), "_key").withColumn("_copies", F.col("_least"))
    out = even.select(*docs.columns, "_copies")
    uneven = measured(taken.where("_more > 0").select("_key", "_least", "_more"))
    if not uneven.isEmpty():
        # equal rows of which some are taken once more; only their texts are put together
        rows = materialised(keyed.withColumn("_part", F.spark_partition_id()).join(uneven, "_key"))
        copies = F.col("_least") + (F.col("_place") < F.col("_more")).cast("int")
        out = out.unionByName(_placed(rows).withColumn("_copies", copies).select(*docs.columns, "_copies"))
    often = F.when(F.col("_copies") > 0, F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return out.withColumn("_copy", F.explode(often)).select(*docs.columns)
