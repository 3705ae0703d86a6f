"""Connected components of small and of larger link tables."""

import pytest

from rigstream.llm import components as c


@pytest.mark.parametrize("task_rows, broadcast", [(100_000, 1 << 20), (10, 0)])
def test_rounds_have_as_many_tasks_as_their_rows_need(spark, monkeypatch, task_rows, broadcast):
    monkeypatch.setattr(c, "TASK_ROWS", task_rows)
    monkeypatch.setattr(c, "BROADCAST_BYTES", broadcast)
    links = [(i, i + 1) for i in range(40)] + [(101, 100), (101, 102), (102, 101), (200, 200)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 31)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        found = c.components(spark.createDataFrame(links, "a long, b long"))
        assert found.rdd.getNumPartitions() <= -(-45 // task_rows)
        got = dict(map(tuple, found.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200}
