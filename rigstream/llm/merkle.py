"""Merkle manifest of a dataset, its proofs spread by a butterfly exchange.

Rows become leaves; leaves of a group stand in order, and runs of FANOUT nodes become their parent
until one is left, the group's subroot. Subroots, in the order of their groups, are the leaves of a
second tree, whose top is the root.

Leaves are numbered by a range partitioning and cut into blocks, aligned subtrees of FANOUT ** HEIGHT
leaves. A block knows its own root, but not the siblings above it. These it learns round by round: in
round r the FANOUT blocks whose numbers differ only in digit r (to the base FANOUT) meet and swap the
roots of the subtrees they stand in, and each of them hashes their parent. So after a logarithmic number
of rounds every block holds the group's subroot and all siblings on its way there, and nothing is
sent down again. Where the last subtree of a level has fewer blocks than the others, its blocks
stand in for the missing ones. A round moves one small row for each block. The second tree is made by the same steps.

Null values and groups: a null encodes as ``-``, a null group is a group of its own and comes first,
null ids come first in their group. Rows of one id are ordered by their leaves, so equal rows, which have equal
leaves and differ in their place, may swap their proofs. Empty texts are values of length 0. An empty
table gives no rows. Columns beside those that are encoded do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from rigstream.llm.common import measured
from rigstream.session import materialised

FANOUT = 3
#: Levels of the subtree that one task handles as a whole.
HEIGHT = 7
#: What a node meets on its way up: the siblings to its left and right, level by level.
PATH = "array<struct<left:string,right:string>>"
STEP = pa.struct([("left", pa.string()), ("right", pa.string())])


def encoded(value: Column) -> Column:
    """UTF-8 byte count, ``:`` and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(value) for value in values]), 256)


def _parent(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def subtree(nodes: list[str], levels: int | None, fanout: int) -> tuple[str, list[list[str]]]:
    """The root over ``nodes`` and the nodes of every level below it; without ``levels`` up to a single node."""
    below = []
    while len(nodes) > 1 if levels is None else len(below) < levels:
        below.append(nodes)
        nodes = [_parent(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], below


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add the place ``_at`` of each row in its ``_group``, from 0, and the group's size ``_n``.

    Rows are dealt by ranges over all of their order, down to a number of their own, so neither a large
    group nor an id or a row that is often repeated comes to one task.
    """
    by = ["_group", *order, "leaf", "_row"]
    cut = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column("_group").to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero(groups[1:] != groups[:-1]) + 1)
            sizes = np.diff(np.append(starts, len(groups)))
            nth = np.arange(len(groups)) - np.repeat(starts, sizes)
            if groups[0] == last:
                nth[: sizes[0]] += seen
            last, seen = groups[-1], int(nth[-1]) + 1
            made = [pa.array(nth, pa.int64()), pa.array(np.full(len(groups), part, np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "_nth", "_part"])

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in cut.dtypes)
    placed = materialised(cut.mapInArrow(count, f"{kinds}, _nth long, _part int"))
    held = placed.groupBy("_group", "_part").agg(F.count(F.lit(1)).alias("_held"))
    whole = Window.partitionBy("_group")
    before = F.sum("_held").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.select("_group", "_part", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_held").over(whole).alias("_n"))
    joined = placed.join(measured(starts), ["_group", "_part"])
    return joined.withColumn("_at", F.col("_before") + F.col("_nth")).drop("_before", "_nth", "_part", "_row")


def exchange(blocks: DataFrame, rounds: int, fanout: int = FANOUT) -> DataFrame:
    """Let blocks (``_group``, ``_block``, ``_blocks``, ``digest``) learn their way to the top: ``digest``, ``path``."""
    state = blocks.withColumn("path", F.array().cast(PATH))
    for number in range(rounds):
        state = _swap(state, fanout**number, fanout)
    return state


def _swap(state: DataFrame, width: int, fanout: int) -> DataFrame:
    """One round: blocks of subtrees ``width`` wide meet the blocks at the same offset of the sibling subtrees."""
    node, offset = F.floor(F.col("_block") / width), F.col("_block") % width
    last = F.floor((F.col("_blocks") - 1) / width)
    in_last = F.col("_blocks") - last * width
    # the narrow last subtree has no block at some offsets, so its blocks are dealt out to them
    stands_in = (node == last) & (in_last < width) & (last % fanout != 0)
    slots = F.when(stands_in, F.sequence(offset, F.lit(width - 1).cast("long"), in_last)).otherwise(F.array(offset))
    sent = state.select(
        "*", F.floor(node / fanout).alias("_up"), (node % fanout).alias("_digit"), offset.alias("_own"), F.explode(slots).alias("_slot")
    )
    member = F.struct("_block", "_blocks", "_digit", "path")
    met = sent.groupBy("_group", "_up", "_slot").agg(
        F.sort_array(F.collect_list(F.struct("_digit", "digest"))).alias("_nodes"),
        F.collect_list(F.when(F.col("_slot") == F.col("_own"), member)).alias("_members"),
    )
    each = met.select("_group", "_nodes", F.explode("_members").alias("_m"))

    def told(keep: Column) -> Column:
        return F.array_join(F.transform(keep, lambda n: n["digest"]), "")

    left = told(F.filter("_nodes", lambda n: n["_digit"] < F.col("_m._digit"))).alias("left")
    right = told(F.filter("_nodes", lambda n: n["_digit"] > F.col("_m._digit"))).alias("right")
    goes_on = F.col("_m._blocks") > width
    return each.select(
        "_group", "_m._block", "_m._blocks",
        F.when(goes_on, F.sha2(told(F.col("_nodes")), 256)).otherwise(F.col("_nodes")[0]["digest"]).alias("digest"),
        F.when(goes_on, F.concat("_m.path", F.array(F.struct(left, right)))).otherwise(F.col("_m.path")).alias("path"),
    )


def tree(rows: DataFrame, order: list[str], fanout: int = FANOUT, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Rows (``_group``, ``leaf``, ``order``) with their places and blocks, and the blocks with ``digest`` and ``path``."""
    if fanout < 2 or height < 1:
        raise ValueError("a tree needs a fanout of 2 and blocks of one level at least")
    size = fanout**height
    placed = _numbered(rows, order).withColumns(
        {"_block": F.floor(F.col("_at") / size), "_blocks": F.ceil(F.col("_n") / size)}
    )

    def root(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by("_at")
        blocks = part.column("_blocks")[0].as_py()
        digest, _ = subtree(part.column("leaf").to_pylist(), None if blocks == 1 else height, fanout)
        return pa.table({"_group": [key[0].as_py()], "_block": [key[1].as_py()], "_blocks": [blocks], "digest": [digest]})

    blocks = placed.select("_group", "_block", "_blocks", "_at", "leaf").groupBy("_group", "_block").applyInArrow(
        root, "_group string, _block long, _blocks long, digest string"
    )
    blocks = materialised(blocks)
    widest = blocks.agg(F.max("_blocks")).first()[0] or 0
    rounds = 0
    while fanout**rounds < widest:
        rounds += 1
    return placed, materialised(exchange(blocks, rounds, fanout))


def with_paths(placed: DataFrame, blocks: DataFrame, keep: list[str], fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """Join rows to their blocks and add ``path``: the siblings inside the block, then those above it.

    ``blocks`` has ``path`` and whatever else is to come with the rows.
    """
    beside = [c for c in blocks.columns if c not in ("_group", "_block", "_blocks", "path")]
    kinds = dict(placed.dtypes) | dict(blocks.dtypes)
    names = ["_group", *keep, "leaf", *beside]

    def join(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows = rows.sort_by("_at")
        nodes = rows.column("leaf").to_pylist()
        _, levels = subtree(nodes, None if rows.column("_blocks")[0].as_py() == 1 else height, fanout)
        upper = above.column("path")[0].as_py()
        left: list[str] = []
        right: list[str] = []
        for place in range(len(nodes)):
            at = place
            for level in levels:
                run = at - at % fanout
                left.append("".join(level[run:at]))
                right.append("".join(level[at + 1 : run + fanout]))
                at //= fanout
            left += [step["left"] for step in upper]
            right += [step["right"] for step in upper]
        steps = len(levels) + len(upper)
        ends = pa.array(np.arange(len(nodes) + 1, dtype=np.int32) * steps)
        path = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(v, pa.string()) for v in (left, right)], fields=list(STEP)))
        columns = {name: rows.column(name) for name in ["_group", *keep, "leaf"]}
        first = pa.array(np.zeros(len(nodes), np.int32))
        columns |= {name: above.column(name).take(first) for name in beside}
        return pa.table(columns | {"path": path})

    schema = ", ".join(f"`{name}` {kinds[name]}" for name in names) + f", path {PATH}"
    wanted = placed.select("_group", "_block", "_blocks", "_at", "leaf", *keep)
    return wanted.groupBy("_group", "_block").cogroup(blocks.drop("_blocks").groupBy("_group", "_block")).applyInArrow(join, schema)


def manifest(rows: DataFrame, group: str, order: list[str], keep: list[str], fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """The proof of every row: ``keep``, ``leaf``, ``subroot``, ``root`` and ``path`` up to the root.

    ``rows`` has a column ``leaf`` with the rows' digests. They are computed once, as the numbering needs them twice.
    """
    known = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("+"), F.col(group).cast("string")))
    columns = list(dict.fromkeys([*order, *keep]))
    named = rows.select(known.alias("_group"), "leaf", *[F.col(c) for c in columns])
    placed, blocks = tree(materialised(named), order, fanout, height)
    # the second tree: one leaf for each group, all in one group
    subroots = blocks.where("_block = 0").select(F.lit("").alias("_group"), F.col("_group").alias("_name"), F.col("digest").alias("leaf"))
    tops, top_blocks = tree(subroots, ["_name"], fanout, height)
    top = with_paths(tops, top_blocks.withColumnRenamed("digest", "root"), ["_name"], fanout, height)
    above = measured(top.select(F.col("_name").alias("_group"), F.col("leaf").alias("subroot"), "root", F.col("path").alias("_top")))
    whole = blocks.drop("digest").join(above, "_group").withColumn("path", F.concat("path", "_top")).drop("_top")
    return with_paths(placed, whole, keep, fanout, height).select(*keep, "leaf", "subroot", "root", "path")


def siblings(path: Column) -> Column:
    """All digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def document_proofs(docs: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """Proofs of documents by source, and what they say of texts whose line breaks are lost.

    Documents whose id's crc32 is even are checked with all line breaks deleted, the others as they are;
    a null id counts as odd.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    rows = docs.select(
        "doc_id", "source", leaf(*fields, F.col("text")).alias("leaf"),
        F.when(hit & F.contains(F.col("text"), F.lit("\n")), leaf(*fields, bare)).alias("_shown"),
    )
    proved = manifest(rows, "source", ["doc_id"], ["doc_id", "_shown"], fanout, height)
    root = folded(F.coalesce("_shown", "leaf"), F.col("path"))
    found = proved.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), root.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
