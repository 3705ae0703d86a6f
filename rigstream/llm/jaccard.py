"""N-gram Jaccard join: linked documents by the token-group matrix, exactly.

Documents are sets of word shingles, shingles are 64-bit hashes. Two documents link when their sets
have a Jaccard likeness of at least ``percent`` / 100. Documents of one set are one class.

1. Groups. Classes that share a minimum hash are compared with those few that share most with all,
   as copies are more alike to their models than to each other; likenesses that are high enough join
   classes to groups of similar documents.
2. Matrix. Linked sets share one of their first shingles in any common order, the first being
   n - ceil(percent * n / 100) + 1. So the matrix needs a row only for each group and each of its
   first shingles, and only for shingles that several groups have. The order puts frequent shingles
   last, as far as a bounded list knows them; it decides the cost, never the result.
3. Bounds. A class meets the parts (of at most ``PART`` classes) of larger groups with which it shares
   a matrix row. Every class has a parity sketch; where two sketches differ in more bits than linked
   sets of these sizes may differ in shingles, no link is possible, and no text needs to move. A set cannot be more alike to a member than its share of the part's union of shingles
   says; only parts that qualify are opened, until the first link to the group, since the members of a
   group are connected already.

Links between groups, taken together, give the components. No group is gathered in one task: parts
and the queries of a part have bounded numbers, texts of a large group are spread over its parts.

Words are what stands between white space, A-Z lower-cased. A document of fewer words than a shingle
has one shingle, its whole sequence; one without words, or null, has none and links with nothing.
Copies link whatever their ids. A class that only has null ids takes no part in links between
different sets; of several texts of one id each counts with its own set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rigstream.llm.common import measured, pieces
from rigstream.llm.components import components
from rigstream.session import materialised

WORDS, PERCENT = 5, 80
#: Classes of a part, and queries that meet a part together.
PART, QUERIES = 64, 512
#: Minimum hashes of a class, how many of them bring classes together for the groups, and models of a meeting.
BANDS, MEETING, MODELS = 16, 4, 8
#: Bits of a parity sketch, and of the wider one that sets of WIDE_FROM shingles have as well.
BITS, WIDE_BITS, WIDE_FROM = 1_024, 8_192, 1_000
#: Frequent shingles that are known: the most frequent HOT of those met HOT_TIMES in so many shingles.
HOT, HOT_TIMES, HOT_STEP = 300_000, 2, 500_000
STEP_BYTES = 1_000_000

_U = np.uint64
_BREAKS = np.zeros(256, bool)
_BREAKS[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (splitmix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_OF_BYTE = _mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, _U)
    done = 1
    while done < n:
        out[done : 2 * done] = out[: min(done, n - done)] * _U(pow(_BASE, done, 1 << 64))
        done *= 2
    return out


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > STEP_BYTES:
            out += _sets(texts[begin : i + 1], k)
            begin, size = i + 1, 0
    return out + _sets(texts[begin:], k)


def _sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    data = [(t or "").encode("utf-8").lower() for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data])
    buffer = np.frombuffer(b" ".join([*data, b""]), np.uint8)
    inside = ~_BREAKS[buffer]
    change = np.diff(inside.astype(np.int8), prepend=0)
    starts = np.nonzero(change == 1)[0]
    if not len(starts):
        return [np.zeros(0, _U)] * len(texts)
    at = np.nonzero(inside)[0]
    lengths = np.diff(np.append(np.nonzero(np.append(True, np.diff(at) > 1))[0], len(at)))
    first = np.cumsum(lengths) - lengths
    powers = _powers(int(lengths.max()))
    offset = np.arange(len(at)) - np.repeat(first, lengths)
    words = _mix(np.add.reduceat(_OF_BYTE[buffer[at]] * powers[offset], first) + lengths.astype(_U))
    # a run of k words is hashed from its words, in order
    factors = _powers(k + 1)[1:]
    runs = words * factors[0]
    for j in range(1, min(k, len(words))):
        runs[: len(words) - j] += words[j:] * factors[j]
    runs = _mix(runs)
    bounds = np.searchsorted(starts, np.append(0, ends))
    out = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            short = (words[a:b] * factors[: b - a]).sum(dtype=_U) + _U(b - a)
            out.append(_mix(np.array([short], _U)))
        else:
            out.append(np.zeros(0, _U))
    return out


def class_of(shingles: np.ndarray) -> int:
    """A hash of a set."""
    both = np.array([_mix(shingles ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) + _U(len(shingles))], _U)
    return int(_mix(both).view(np.int64)[0])


def parity(shingles: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bit i is set if an odd number of shingles fall to i, so two sketches differ in no more bits than the sets in shingles."""
    odd = np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_link(percent: int) -> Column:
    """Whether sets of sizes n, n2 with sketches sketch, sketch2 may link at all."""
    def apart(a: str, b: str) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)

    both_wide = (F.col("n") >= WIDE_FROM) & (F.col("n2") >= WIDE_FROM)
    differing = F.when(both_wide, apart("wide", "wide2")).otherwise(apart("sketch", "sketch2"))
    sizes = 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")
    return sizes & ((100 + percent) * differing <= (100 - percent) * (F.col("n") + F.col("n2")))


def first_shingles(shingles: np.ndarray, percent: int, hot: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first n - ceil(percent * n / 100) + 1 of a set: unknown ones in order, then the known, rarest first."""
    n = len(shingles)
    need = n - -(-percent * n // 100) + 1
    if not len(hot):
        return shingles[:need]
    place = np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)
    known = hot[place] == shingles
    cold = shingles[~known]
    if len(cold) >= need:
        return cold[:need]
    rest = shingles[known]
    return np.concatenate([cold, rest[np.argsort(rank[place[known]])[: need - len(cold)]]])


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def profiles(docs: DataFrame, k: int) -> DataFrame:
    """Of each row of ``docs`` (doc_id, text): ``n``, ``cls``, ``keys`` and ``sketch``; rows with ``hot`` list frequent shingles."""
    odd = _mix(np.arange(101, 101 + BANDS, dtype=_U)) | _U(1)
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, seen = [], 0, set()
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = shingle_sets(part.column("text").to_pylist(), k)
                ids, rows = part.column("doc_id"), len(sets)
                classes = [class_of(s) for s in sets]
                keys = [np.array([(s * m).min() for m in odd]).view(np.int64) if len(s) else [] for s in sets]
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.int64()),
                    pa.array(keys, longs), pa.array([parity(s) for s in sets], longs),
                    pa.array([parity(s, WIDE_BITS) if len(s) >= WIDE_FROM else None for s in sets], longs), *[pa.nulls(rows, longs)] * 2,
                ], names=names)
                for c, s in zip(classes, sets):
                    if c not in seen:
                        seen.add(c)
                        held.append(s)
                        count += len(s)
                if count > HOT_STEP:
                    yield frequent(held)
                    held, count, seen = [], 0, set()
        if held:
            yield frequent(held)

    def frequent(sets: list[np.ndarray]) -> pa.RecordBatch:
        found = np.concatenate(sets)
        found.sort()
        starts = np.flatnonzero(np.append(True, found[1:] != found[:-1])[: len(found)])
        times = np.diff(np.append(starts, len(found)))
        often = times >= HOT_TIMES
        listed = [pa.array([x[often].astype(np.int64, copy=False)], longs) for x in (found[starts].view(np.int64), times)]
        return pa.RecordBatch.from_arrays([*[pa.nulls(1, pa.int64())] * 3, *[pa.nulls(1, longs)] * 3, *listed], names=names)

    names = ["doc_id", "n", "cls", "keys", "sketch", "wide", "hot", "times"]
    schema = "doc_id long, n long, cls long, keys array<long>, sketch array<long>, wide array<long>, hot array<long>, times array<long>"
    return materialised(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema))


def _with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (doc_id, ...) with the texts of its documents."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(measured(wanted), "doc_id")


def _compare(rows: DataFrame, keys: list[str], k: int, percent: int, compare: Callable) -> DataFrame:
    """Links found by ``compare(members, queries)`` in each group of ``keys``; rows: keys, cls, asks, text."""
    def run(found: pd.DataFrame) -> pd.DataFrame:
        sets = shingle_sets(found["text"].tolist(), k)
        mine, theirs = {}, {}
        for cls, asks, shingles in zip(found["cls"].tolist(), found["asks"].tolist(), sets):
            if class_of(shingles) == cls:
                (theirs if asks else mine)[cls] = shingles
        return pd.DataFrame(compare(mine, theirs, percent), columns=["a", "b"], dtype=np.int64)

    return rows.groupBy(*keys).applyInPandas(run, "a long, b long")


def _to_centre(members: dict, queries: dict, percent: int) -> list[tuple[int, int]]:
    """Links of the queries to the one member."""
    return [(q, c) for c, s in members.items() for q, t in queries.items() if _linked(s, t, percent)]


def open_parts(members: dict, queries: dict, percent: int) -> list[tuple[int, int]]:
    """One link of each query to the members, if the union of their shingles leaves room for any."""
    if not members:
        return []
    union = np.unique(np.concatenate(list(members.values())))
    links = []
    for q, shingles in queries.items():
        at = np.minimum(np.searchsorted(union, shingles), len(union) - 1)
        if 100 * int((union[at] == shingles).sum()) >= percent * len(shingles):
            hit = next((m for m, s in members.items() if _linked(s, shingles, percent)), None)
            if hit is not None:
                links.append((q, hit))
    return links


def _seconds(classes: DataFrame, name: str) -> DataFrame:
    """What ``may_link`` needs of the second class of a pair."""
    return classes.select(F.col("cls").alias(name), *[F.col(c).alias(f"{c}2") for c in ("n", "sketch", "wide")])


def _groups(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``cls`` and ``grp`` of the classes that are in a group of several."""
    keyed = classes.select("cls", F.posexplode("keys").alias("band", "key"))
    sizes = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    met = materialised(keyed.join(sizes, ["band", "key"]))
    weights = met.groupBy("cls").agg(F.sum("_size").alias("_weight"))
    near = met.where(F.col("band") < MEETING).join(weights, "cls")
    # the heaviest class of each of MODELS shares of a meeting
    share = F.pmod(F.xxhash64("cls"), F.lit(MODELS)).alias("_share")
    centres = near.groupBy("band", "key", share).agg(F.max(F.struct("_weight", "cls")).alias("_best"))
    pairs = near.join(centres, ["band", "key"]).select("cls", F.col("_best.cls").alias("centre")).where("cls <> centre").distinct()
    sketches = classes.select("cls", "doc_id", "n", "sketch", "wide")
    theirs = _seconds(classes, "centre")
    known = pairs.join(sketches, "cls").join(theirs, "centre").where(may_link(percent))
    pairs = materialised(known.select("centre", "cls", "doc_id"))
    salts = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("_salts"))
    salts = materialised(salts)
    asks = pairs.join(salts, "centre").select(
        "doc_id", "cls", F.lit(True).alias("asks"), "centre", F.pmod(F.xxhash64("cls"), F.col("_salts")).cast("int").alias("salt")
    )
    centres = salts.join(classes.select(F.col("cls").alias("centre"), "doc_id"), "centre").select(
        "doc_id", F.col("centre").alias("cls"), F.lit(False).alias("asks"), "centre",
        F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt"),
    )
    rows = _with_texts(docs, asks.unionByName(centres))
    found = components(_compare(rows, ["centre", "salt"], k, percent, _to_centre))
    return found.select(F.col("node").alias("cls"), F.col("label").alias("grp"))


def _matrix(docs: DataFrame, hot: np.ndarray, groups: DataFrame, k: int, percent: int, least: int) -> DataFrame:
    """``token``, ``cls``, ``n``, ``grp`` of first shingles that several groups have.

    ``room`` is the number of the set's shingles from this one on.
    """
    order = np.argsort(hot)
    # ranks grow with frequency; `hot` has the most frequent first
    shared = docs.sparkSession.sparkContext.broadcast((hot[order], -order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, rank = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = [s for s in shingle_sets(part.column("text").to_pylist(), k) if len(s) >= least]
                firsts = [first_shingles(s, percent, tokens, rank) for s in sets]
                each = [len(f) for f in firsts]
                columns = [
                    np.concatenate(firsts).view(np.int64) if firsts else np.zeros(0, np.int64),
                    np.repeat(np.array([class_of(s) for s in sets], np.int64), each),
                    np.repeat(np.array([len(s) for s in sets], np.int64), each),
                    np.concatenate([len(s) - np.arange(len(f)) for s, f in zip(sets, firsts)] or [np.zeros(0, np.int64)]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "cls", "n", "room"])

    rows = docs.select("text").mapInArrow(run, "token long, cls long, n long, room long").repartition("token")
    # asks for all columns, so that both uses of the rows share one exchange
    several = rows.groupBy("token").agg(F.min("cls").alias("_a"), F.max("cls").alias("_b"), F.max("n").alias("_n"), F.max("room").alias("_r"))
    several = several.where((F.col("_a") < F.col("_b")) & (F.col("_n") > 0) & (F.col("_r") > 0)).select("token")
    met = materialised(rows.join(several, "token").distinct())
    grouped = met.join(groups, "cls", "left").withColumn("grp", F.coalesce("grp", "cls"))
    apart = grouped.groupBy("token").agg(F.min("grp").alias("_a"), F.max("grp").alias("_b")).where("_a < _b").select("token")
    return materialised(grouped.join(apart, "token"))


def _between(docs: DataFrame, classes: DataFrame, matrix: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between classes of different groups."""
    nodes = matrix.select("cls", "grp").distinct()
    sizes = nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("gsize"))
    parts = nodes.join(sizes, "grp").withColumn("part", F.pmod(F.xxhash64("cls"), F.ceil(F.col("gsize") / PART)).cast("int"))
    parts = materialised(parts)
    placed = matrix.select("token", "cls", "n", "room").join(parts, "cls")
    rows = placed.groupBy("token", "grp", "part", "gsize").agg(
        F.min("n").alias("_least"), F.max("n").alias("_most"), F.max("room").alias("_room")
    )
    asked = placed.select("token", "cls", "n", "room", F.col("grp").alias("_grp"), F.col("gsize").alias("_gsize"))
    smaller = (F.col("_gsize") < F.col("gsize")) | ((F.col("_gsize") == F.col("gsize")) & (F.col("_grp") < F.col("grp")))
    fits = (100 * F.col("_most") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("_least"))
    # at their first common shingle, both sets must have as many left as linked sets share
    roomy = (100 + percent) * F.least("room", "_room") >= percent * (F.col("n") + F.col("_least"))
    shared = asked.join(rows, "token").where(smaller & fits & roomy).select("cls", "grp", "part").distinct()
    own = classes.select("cls", "n", "sketch", "wide")
    members = parts.select(F.col("cls").alias("member"), "grp", "part").join(_seconds(classes, "member"), "member")
    possible = shared.join(own, "cls").join(members, ["grp", "part"]).where(may_link(percent))
    possible = materialised(possible.select("cls", "member", "grp", "part"))
    met = materialised(possible.select("cls", "grp", "part").distinct())
    salts = met.groupBy("grp", "part").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("_salts"))
    asks = met.join(salts, ["grp", "part"]).select(
        "cls", F.lit(True).alias("asks"), "grp", "part", F.pmod(F.xxhash64("cls"), F.col("_salts")).cast("int").alias("salt")
    )
    members = possible.select("member", "grp", "part").distinct().join(salts, ["grp", "part"]).select(
        F.col("member").alias("cls"), F.lit(False).alias("asks"), "grp", "part", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt")
    )
    wanted = asks.unionByName(members).join(classes.select("cls", "doc_id"), "cls")
    return _compare(_with_texts(docs, wanted), ["grp", "part", "salt"], k, percent, open_parts)


def linked_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest id reachable by links, the document's own included.
    """
    found = profiles(docs, words)
    rows = found.where(F.col("hot").isNull())
    listed = found.where(F.col("hot").isNotNull()).select(F.explode(F.arrays_zip("hot", "times")).alias("x"))
    often = listed.groupBy(F.col("x.hot").alias("token")).agg(F.sum("x.times").alias("times"))
    hot = often.orderBy(F.desc("times"), "token").limit(HOT).select("token").toArrow().column(0).to_numpy().view(_U)
    # sets so small that a shingle more or less is too much link with their copies alone
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    every = rows.where(F.col("n") > 0).groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.max(F.struct("n", "keys", "sketch", "wide")).alias("x"))
    every = materialised(every.select("cls", "doc_id", "x.*"))
    classes = every.where((F.col("n") >= least) & F.col("doc_id").isNotNull())
    groups = _groups(docs, classes, words, percent)
    matrix = _matrix(docs, hot, groups, words, percent, least)
    joined = matrix.select("cls", "grp").distinct()
    links = _between(docs, classes, matrix, words, percent)
    of = lambda side: joined.select(F.col("cls").alias(side), F.col("grp").alias(f"_{side}"))
    merged = components(links.join(of("a"), "a").join(of("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    labelled = every.select("cls", "doc_id").join(groups, "cls", "left").withColumn("grp", F.coalesce("grp", "cls"))
    labelled = labelled.join(merged.withColumnRenamed("node", "grp"), "grp", "left").withColumn("label", F.coalesce("label", "grp"))
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_class = labelled.join(smallest, "label").select("cls", "component_id")
    linked = rows.where(F.col("n") > 0).join(of_class, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where(F.col("n") == 0).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
