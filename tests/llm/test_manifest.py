"""The Merkle manifest against a plain recursive one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rigstream.llm import merkle, queries

DDL = "doc_id long, source string, lang string, n_chars int, text string"


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    values = [row[0], row[1], row[2], row[3], text]
    return _hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _climb(nodes, fanout):
    """The root and each node's siblings, level by level."""
    ways, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, wider = [], []
        for lo in range(0, len(nodes), fanout):
            run = nodes[lo : lo + fanout]
            for k in range(len(run)):
                for i in spans[lo + k]:
                    ways[i].append((run[:k], run[k + 1 :]))
            above.append(_hash(*run))
            wider.append([i for span in spans[lo : lo + fanout] for i in span])
        nodes, spans = above, wider
    return nodes[0], ways


def plain_proofs(rows, fanout=3):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found, subroots = [], []
    for name in names:
        held = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r, r[4])))
        subroot, ways = _climb([_leaf(r, r[4]) for r in held], fanout)
        subroots.append(subroot)
        found.append((held, ways))
    root, tops = _climb(subroots, fanout)
    out = []
    for (held, ways), subroot, top in zip(found, subroots, tops):
        for row, way in zip(held, ways):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            node = _leaf(row, row[4].replace("\n", "") if hit and row[4] is not None else row[4])
            for left, right in way + top:
                node = _hash(*left, node, *right)
            proof = _hash(*[d for left, right in way + top for d in left + right])
            out.append((row[0], _leaf(row, row[4]), subroot, root, proof, node, node == root))
    return out


def _rows(seed=3):
    draw = random.Random(seed)
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "ä": 10, None: 5, "": 9, "hot": 130, "e": 27, "f": 28, "g": 82}
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            at += draw.randrange(1, 9)
            text = draw.choice([None, "", "x\ny\n", "plain", "é\n" * 3, "\n"])
            rows.append((at, source, draw.choice([None, "en"]), draw.choice([None, 3]), text))
    rows += [(None, "hot", None, None, "x\n"), (None, "hot", "en", 2, None), rows[40], (rows[50][0], rows[50][1], "fr", 1, "other")]
    draw.shuffle(rows)
    return rows


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("fanout, height", [(3, 1), (3, 2), (3, 7), (2, 2)])
def test_proofs_equal_the_plain_tree(spark, fanout, height):
    rows = _rows()
    docs = spark.createDataFrame(rows, DDL).repartition(5).withColumn("_group", F.lit("clash")).withColumn("leaf", F.lit(1))
    found = merkle.document_proofs(docs, fanout, height).collect()
    assert _sorted(found) == _sorted(plain_proofs(rows, fanout))
    assert {r.verified for r in found} == {True, False}


def test_a_proof_holds_what_it_claims(spark):
    rows = merkle.leaf(F.col("text"))
    docs = spark.createDataFrame([(i, "s", f"t{i}") for i in range(40)], "doc_id long, source string, text string")
    proved = merkle.manifest(docs.withColumn("leaf", rows), "source", ["doc_id"], ["doc_id", "text"], height=2)
    checked = proved.select((merkle.folded(rows, F.col("path")) == F.col("root")).alias("ok"), (F.col("subroot") == F.col("root")).alias("alone"))
    assert {tuple(r) for r in checked.collect()} == {(True, True)}
    wrong = proved.select((merkle.folded(merkle.leaf(F.lit("t0")), F.col("path")) == F.col("root")).alias("ok"), "doc_id")
    assert [r.doc_id for r in wrong.where("ok").collect()] == [0]


def test_tables_without_rows_and_with_one(spark):
    assert merkle.document_proofs(spark.createDataFrame([], DDL)).collect() == []
    row = (7, None, None, None, None)
    (found,) = merkle.document_proofs(spark.createDataFrame([row], DDL)).collect()
    assert tuple(found) == plain_proofs([row])[0] and found.verified and found.root == found.leaf
    assert found.proof_sha256 == hashlib.sha256(b"").hexdigest()


def test_one_large_group_of_equal_rows(spark):
    rows = [(1, "s", "en", 2, "x\n")] * 400 + [(i, "t", None, None, "y" * 50_000) for i in range(3)]
    found = merkle.document_proofs(spark.createDataFrame(rows, DDL), height=2).collect()
    assert _sorted(found) == _sorted(plain_proofs(rows))


def test_registered_manifest(spark):
    df = queries.op11_merkle_manifest(spark, "/root/testdata/sf0.001")
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    assert _sorted(df.collect()) == _sorted(plain_proofs([tuple(r) for r in docs.collect()]))
