"""Hard-negative mining by clustered shared lists (MAXIMUS).

Anchors that point in similar directions form a cluster. For a cluster the candidates are sorted once by
the angular bound |v| cos(max(0, angle(v, centre) - radius)), which no member's product with v exceeds
but for the member's own length. Every member walks that list, scoring a piece at a time, until its
next bound is below what it still looks for: below its k-th best score, or below the window of scores that
its negatives must lie in. What it has then is certified to be exact. Members of a cluster that still walk score a
piece together, as a product of matrices.

Candidates are dealt into shards of bounded size and anchors into blocks of whole or partial clusters; a
block meets a shard in a co-group. The first shards tell each anchor a k-th score, by which the walks through
all other shards end early and hand on little. Positives are mined first, as they say in which
window an anchor's negatives lie; then negatives by the same walk, one window for each positive.

Centres are fitted on at most SAMPLE anchors, chosen by a hash; they decide the order of work and never the
result. No table is broadcast beside the centres, and no anchor's candidates are collected.

A row takes no part if its label, vector or id is null, or if the vector is empty, has a null or non-finite
component, or one that is not finite once scaled. Vectors are compared with those of their own length. Rows of the
anchor's id are neither its positives nor its negatives; other repeated rows count each. Of several rows of
one anchor id that of the smallest label, and then of the first packed vector, is the anchor. Scores are exact whole numbers; beyond 64
bits they are cut to the largest or smallest one. Empty tables, and anchors without positives, give no rows.
Columns beside those three do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from rigstream.llm import vectors
from rigstream.llm.common import once
from rigstream.session import materialised

#: Rows of a shard of candidates, anchors of a block, rows scored at once.
SHARD, BLOCK, PIECE = 4_096, 16_384, 256
#: One of so many shards is walked first.
FIRST = 16
#: Anchors that the centres are fitted on, and anchors for each centre.
SAMPLE, MEMBERS, ROUNDS = 4_096, 64, 8
LEAST, MOST = vectors.LEAST, vectors.MOST
FOUND = "anchor_id long, window int, vec_id long, score long"


def packed(rows: DataFrame, scale: int, vec_id: str, vector: str, label: Column, is_anchor: Column) -> DataFrame:
    """``vec_id``, ``label``, ``asks``, ``dims`` and ``v`` (``vectors.packed``) of the rows that take part."""
    named = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), is_anchor.alias("asks"), F.col(vector).alias("_v")
    )
    return vectors.packed(named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()), scale, "_v")


@dataclass
class Hunt:
    """What members look for: ``same`` or other labels, per window the ``k`` best scores from ``low`` to ``high``.

    ``low``, ``high`` and ``need``, a score that the k-th best is known to reach, have a row per member.
    """

    same: bool
    k: int
    low: np.ndarray
    high: np.ndarray
    need: np.ndarray


def _unit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        length = np.sqrt((rows * rows).sum(axis=1))
        unit = np.where(length[:, None] > 0, rows / length[:, None], 0.0)
    return unit, length


def bounds(members: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What no member's product with each of ``rows`` exceeds, but for the member's length; and these lengths."""
    unit, length = _unit(members)
    toward, reach = _unit(rows)
    if not (np.isfinite(length).all() and np.isfinite(reach).all()):
        return np.full(len(rows), np.inf), np.ones(len(members))
    centre, _ = _unit(unit.sum(axis=0, keepdims=True))
    with np.errstate(invalid="ignore"):
        radius = np.arccos(np.clip(unit[length > 0] @ centre[0], -1, 1)).max(initial=0.0)
        angle = np.arccos(np.clip(toward @ centre[0], -1, 1))
    # arccos is good to half of the digits only
    slack = 1e-6 * reach.max(initial=0.0)
    return reach * np.cos(np.maximum(0.0, angle - radius)) + slack, length


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The ``k`` best of (member, window, id, score): highest scores, then smallest ids."""
    member, window, ids, score = found
    order = np.lexsort((ids, -np.maximum(score, LEAST + 1), window, member))
    member, window, ids, score = (x[order] for x in (member, window, ids, score))
    starts = np.append(True, (member[1:] != member[:-1]) | (window[1:] != window[:-1])) if len(member) else np.zeros(0, bool)
    begin = np.flatnonzero(starts)
    nth = np.arange(len(member)) - np.repeat(begin, np.diff(np.append(begin, len(member))))
    return [x[nth < k] for x in (member, window, ids, score)]


def walk(members: np.ndarray, labels: np.ndarray, own: np.ndarray, rows: np.ndarray, theirs: np.ndarray, ids: np.ndarray, hunt: Hunt, piece: int = PIECE):
    """Let the members of a cluster walk their shared list: (member, window, id, score) of what they find; products taken."""
    bound, length = bounds(members, rows)
    order = np.argsort(-bound, kind="stable")
    bound, rows, theirs, ids = bound[order], rows[order], theirs[order], ids[order]
    need = np.maximum(hunt.need, hunt.low)
    found = [np.zeros(0, np.int64) for _ in range(4)]
    walking, taken = np.arange(len(members)), 0
    for begin in range(0, len(rows), piece):
        open_ = (need[walking] <= (bound[begin] * length[walking])[:, None]) & (need[walking] <= hunt.high[walking])
        walking = walking[open_.any(axis=1)]
        if not len(walking):
            break
        part = slice(begin, begin + piece)
        score = vectors.products(members[walking], rows[part])
        taken += score.size
        fits = ((labels[walking][:, None] == theirs[part]) == hunt.same) & (own[walking][:, None] != ids[part])
        met = []
        for window in range(hunt.low.shape[1]):
            ok = fits & (score >= need[walking, window][:, None]) & (score <= hunt.high[walking, window][:, None])
            at, place = np.nonzero(ok)
            met.append([walking[at], np.full(len(at), window), ids[part][place], score[at, place]])
        if not any(len(m[0]) for m in met):
            continue
        found = _best([np.concatenate([f, *(m[i] for m in met)]) for i, f in enumerate(found)], hunt.k)
        group = found[0] * hunt.low.shape[1] + found[1]
        full, first, count = np.unique(group, return_index=True, return_counts=True)
        whole = count == hunt.k
        kth = found[3][(first + hunt.k - 1)[whole]]
        flat = need.reshape(-1)
        flat[full[whole]] = np.maximum(flat[full[whole]], kth)
    return found, taken


def fit_centres(anchors: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Centres of the directions of a bounded sample of anchors, by vector length."""
    chosen = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("dims", "v").toArrow()
    centres = {}
    for dims in set(chosen.column("dims").to_pylist()):
        unit, _ = _unit(vectors.unpacked(chosen.filter(pc.equal(chosen.column("dims"), dims)).column("v"), dims))
        made = unit[:: max(1, min(MEMBERS, len(unit) // 2))]
        for _ in range(ROUNDS):
            nearest = np.argmax(unit @ made.T, axis=1)
            sums = np.zeros_like(made)
            np.add.at(sums, nearest, unit)
            made, _ = _unit(sums)
        centres[dims] = made
    return centres


def clustered(anchors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Add the ``cluster`` of each anchor, the nearest centre's number."""
    shared = anchors.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = once(shared, lambda x: x)
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            cluster = np.zeros(len(dims), np.int32)
            for size in np.unique(dims):
                at = np.flatnonzero(dims == size)
                if size in known:
                    unit, _ = _unit(vectors.unpacked(batch.column("v").take(pa.array(at)), size))
                    cluster[at] = np.argmax(np.nan_to_num(unit) @ known[size].T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster)], names=[*batch.schema.names, "cluster"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in anchors.dtypes)
    return anchors.mapInArrow(assign, f"{kinds}, cluster int")


def _search(
    anchors: DataFrame, rows: DataFrame, same: bool, k: int, percents: tuple[int, int], shards: int, blocks: int, first: bool
) -> DataFrame:
    """Let every anchor walk through the first shards, or through all others: what it finds there (FOUND).

    Anchors have ``block``, ``cluster``, ``positives`` (scores, null while positives are sought) and ``needs``.
    """
    lowest, highest = percents
    is_first = F.col("shard") % FIRST == 0
    mine = is_first if first else ~is_first
    held = rows.where(mine).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(mine)

    def hunt_for(part: pa.Table) -> Hunt:
        known = part.column("positives").to_pylist()
        width = max((len(p) for p in known if p is not None), default=1) or 1
        low, high, need = (np.full((len(known), width), x) for x in (LEAST, MOST, LEAST))
        for i, (scores, needs) in enumerate(zip(known, part.column("needs").to_pylist())):
            if scores is not None:
                high[i] = LEAST
                low[i] = MOST
                low[i, : len(scores)] = [-(-lowest * s // 100) for s in scores]
                high[i, : len(scores)] = [highest * s // 100 for s in scores]
            for window, value in enumerate(needs or []):
                need[i, window] = LEAST if value is None else value
        return Hunt(same, k, low, high, need)

    def meet(key: tuple, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        made: list[list[np.ndarray]] = []
        dims = key[2].as_py()
        if mine.num_rows and theirs.num_rows:
            rows, ids = vectors.unpacked(theirs.column("v"), dims), theirs.column("vec_id").to_numpy()
            labels = theirs.column("label").to_numpy()
            clusters = mine.column("cluster").to_numpy()
            for cluster in np.unique(clusters):
                part = mine.take(pa.array(np.flatnonzero(clusters == cluster)))
                own = part.column("vec_id").to_numpy()
                found, _ = walk(vectors.unpacked(part.column("v"), dims), part.column("label").to_numpy(), own, rows, labels, ids, hunt_for(part))
                made.append([own[found[0]], *found[1:]])
        columns = [np.concatenate([m[i] for m in made]) if made else np.zeros(0, np.int64) for i in range(4)]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["anchor_id", "window", "vec_id", "score"])

    keys = ["block", "shard", "dims"]
    return sent.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(meet, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id", "_row")
    numbered = found.withColumn("_row", F.monotonically_increasing_id()).withColumn("rank", F.row_number().over(order))
    return numbered.where(F.col("rank") <= k).drop("_row")


def best(anchors: DataFrame, rows: DataFrame, same: bool, k: int, percents: tuple[int, int], shards: int, blocks: int) -> DataFrame:
    """The ``k`` best of ``rows`` for every anchor and window: FOUND and ``rank``, in two rounds of shards."""
    start = materialised(_ranked(_search(anchors, rows, same, k, percents, shards, blocks, True), k))
    if shards == 1:
        return start
    kth = start.where(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("_kth"))
    windows = F.sequence(F.lit(0), F.greatest(F.coalesce(F.size("positives"), F.lit(1)), F.lit(1)) - 1)
    needs = F.when(F.col("_kth").isNotNull(), F.transform(windows, lambda n: F.try_element_at(F.col("_kth"), n)))
    told = anchors.join(kth, anchors["vec_id"] == kth["anchor_id"], "left").withColumn("needs", needs).drop("_kth", "anchor_id")
    rest = _search(told, rows, same, k, percents, shards, blocks, False)
    return materialised(_ranked(start.drop("rank").unionByName(rest), k))


def hard_negatives(
    rows: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, percents: tuple[int, int] = (30, 90),
    scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """For every anchor and each of its best rows of its label, the best rows of other labels whose score is
    within ``percents`` of the positive's: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    ``is_anchor`` and ``label`` are expressions over the columns of ``rows``.
    """
    # a row's own number deals repeated rows over the shards
    known = materialised(packed(rows, scale, vec_id, vector, label, is_anchor))
    count = known.count()
    shards = max(1, -(-count // shard))
    dealt = known.drop("asks").withColumn("shard", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    asked = known.where("asks").groupBy("vec_id").agg(F.min(F.struct("label", "dims", "v")).alias("_a")).select("vec_id", "_a.*")
    asked = materialised(asked)
    blocks = max(1, -(-asked.count() // block))
    part = F.pmod(F.xxhash64("cluster", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), F.lit(blocks)).cast("int")
    placed = clustered(asked, fit_centres(asked)).withColumn("block", part)
    seeking = placed.withColumns({"positives": F.lit(None).cast("array<bigint>"), "needs": F.lit(None).cast("array<bigint>")})
    near = best(seeking, dealt, True, positives, percents, shards, blocks)
    listed = near.groupBy("anchor_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("positives"))
    having = placed.join(listed.withColumnRenamed("anchor_id", "vec_id"), "vec_id").withColumn("needs", F.lit(None).cast("array<bigint>"))
    far = best(materialised(having), dealt, False, negatives, percents, shards, blocks)
    pairs = near.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = far.select("anchor_id", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(pairs, ["anchor_id", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
