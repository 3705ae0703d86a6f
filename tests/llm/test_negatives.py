"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigstream.llm import negatives, queries

DDL = "vec_id long, embedding array<double>, label int"


def plain_negatives(rows, positives, wanted, percents=(30, 90), scale=256):
    known = []
    for vec_id, vector, label in rows:
        if vec_id is not None and label is not None and vector and all(x is not None and np.isfinite(x) for x in vector):
            known.append((vec_id, [int(np.floor(scale * x)) for x in vector], label))
    out = []
    for anchor in sorted({k[0] for k in known if k[0] % 10 == 0}):
        label, vector = min((k[2], k[1]) for k in known if k[0] == anchor)
        scored = []
        for vec_id, other, theirs in known:
            if vec_id != anchor and len(other) == len(vector):
                score = sum(a * b for a, b in zip(vector, other))
                scored.append((-min(max(score, -(2**63)), 2**63 - 1), vec_id, theirs))
        scored.sort()
        for minus, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and percents[0] * -minus <= 100 * -s[0] <= percents[1] * -minus]
            out += [(anchor, positive, n, s[1], -minus, -s[0]) for n, s in enumerate(fit[:wanted], 1)]
    return sorted(out)


def _found(spark, rows, **options):
    vectors = spark.createDataFrame(rows, DDL).repartition(3).withColumn("dims", F.lit("clash")).withColumn("v", F.lit(0))
    return sorted(tuple(r) for r in negatives.hard_negatives(vectors, F.col("vec_id") % 10 == 0, F.col("label"), **options).collect())


@pytest.mark.parametrize("shard, block", [(20, 7), (150, 1000), (10_000, 3)])
def test_negatives_equal_brute_force(spark, shard, block):
    draw = np.random.default_rng(shard)
    rows = [(i, draw.normal(size=4).round(1).tolist(), int(draw.integers(0, 3))) for i in range(400)]
    rows += [(400 + i, rows[30][1], i % 3) for i in range(60)]  # copies, so that scores tie
    rows += [(900, None, 1), (901, [1.0, None, 0.0, 0.0], 1), (902, [float("nan")] * 4, 1), (903, [float("inf")] * 4, 1), (904, [], 1)]
    rows += [(None, [1.0] * 4, 1), (905, [1.0] * 4, None), (910, [0.0] * 4, 1), (920, [1.0, 2.0], 1), (921, [2.0, 2.0], 1), (922, [1.0, 0.5], 2)]
    rows += [(20, rows[20][1], rows[20][2]), (21, rows[21][1], rows[21][2]), (30, [5.0] * 4, 2), (930, [3.0], 7)]
    got = _found(spark, rows, shard=shard, block=block, positives=4, negatives=6)
    assert len(got) > 300 and got == plain_negatives(rows, 4, 6)


def test_large_components_are_exact(spark):
    draw = np.random.default_rng(1)
    rows = [(i, (draw.normal(size=3) * 10.0 ** draw.integers(0, 13)).tolist(), int(draw.integers(0, 2))) for i in range(60)]
    rows += [(100, [1e9, 3e9, 1.0], 0), (101, [1e9, 3e9, 1.5], 0), (102, [1e9, 1e9, 0.5], 1), (110, [1e305, 1.0, 1.0], 0), (111, [1.7e308] * 3, 0)]
    got = _found(spark, rows, shard=25, positives=3, negatives=5)
    assert got == plain_negatives([r for r in rows if r[0] != 111], 3, 5)
    assert max(r[4] for r in got) > 2**53


def test_empty_tables_and_anchors_without_positives(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(10, [1.0], 1), (11, [1.0], 2)]) == []
    assert _found(spark, [(11, [1.0], 1), (12, [1.0], 2)]) == []


def test_bounds_hold_and_walks_end_early():
    draw = np.random.default_rng(3)
    rows = draw.integers(-300, 300, size=(4000, 3)).astype(float)
    members = rows[:1] + draw.integers(-10, 10, size=(20, 3))
    bound, length = negatives.bounds(members, rows)
    assert (members @ rows.T <= bound[None, :] * length[:, None]).all()
    one = np.full((20, 1), 0)
    hunt = negatives.Hunt(True, 5, one + negatives.LEAST, one + negatives.MOST, one + negatives.LEAST)
    ids, labels = np.arange(4000), np.ones(4000, int)
    found, taken = negatives.walk(members, np.ones(20, int), np.full(20, -1), rows, labels, ids, hunt, 50)
    assert taken < members.shape[0] * len(rows) / 4
    for member in range(20):
        score = members[member] @ rows.T
        want = np.lexsort((ids, -score))[:5]
        assert found[2][found[0] == member].tolist() == want.tolist()


def test_one_label_and_vector_on_a_third_of_the_rows(spark):
    draw = np.random.default_rng(9)
    rows = [(i, [1.0, 0.5] if i % 3 else draw.normal(size=2).round(1).tolist(), 0 if i % 3 else int(draw.integers(0, 3))) for i in range(600)]
    assert _found(spark, rows, shard=64) == plain_negatives(rows, 5, 10)


def test_registered_negatives(spark):
    df = queries.op13_hard_negatives(spark, "/root/testdata/sf0.001")
    assert dict(df.dtypes) == {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint",
    }
