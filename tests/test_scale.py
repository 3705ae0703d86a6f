"""What large inputs ask of the keyed tables and the forecasts: rows travel once, series are computed once."""

import datetime

import pytest
from pyspark.sql import functions as F

from rigstream.plans import queries
from rigstream.sources import tables
from rigstream.sources.tables import KeyedTable, few_repeated, latest_rows

ROWS = "k string, seq bigint, v string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _all(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rows_equal_in_recency_are_told_apart_in_any_order(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("b", 2, None)]
    for some in (rows, rows[::-1]):
        found = latest_rows(spark.createDataFrame(some, ROWS).coalesce(1), ["k"], ["seq"])
        assert _all(found) == [("a", 1, "y"), ("b", 2, None)]
        assert "max_by" not in _plan(found)  # so seq is not sent twice


def test_maps_have_no_order_and_travel_all_the_same(spark):
    rows = spark.createDataFrame([("a", 1, {"m": 1}), ("a", 2, {"m": 2})], "k string, seq bigint, v map<string,int>")
    assert _all(latest_rows(rows, ["k"], [F.col("seq")])) == [("a", 2, {"m": 2})]


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_few_repeated_keys_are_combined_and_the_others_stay(spark, monkeypatch, most):
    monkeypatch.setattr(tables, "MOST_REPEATED", most)
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "p"), (None, 1, "n"), (None, 2, "m"), ("c", None, None)]
    df = spark.createDataFrame(rows, ROWS)
    assert _all(few_repeated(df, ["k"], ["seq"])) == _all(latest_rows(df, ["k"], ["seq"])) and df.count() == 7
    once = df.where("k = 'b'")
    assert _all(few_repeated(once, ["k"], ["seq"])) == [("b", 1, "p")]


def test_a_table_of_one_part_is_read_without_a_shuffle(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("k",), ("k",), 2, ("seq",), ROWS)
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], ROWS)
    table.write_batch(df, 5, stored=True)
    table.write_batch(df.limit(0), 6, stored=True)
    want = [("a", 2, "y"), ("b", 1, "z")]
    assert _all(table.read(spark)) == want and "Exchange" not in _plan(table.read(spark))
    assert table.compact(spark) == 6 and "Exchange" not in _plan(table.read(spark))
    table.write_batch(spark.createDataFrame([("b", 0, "new")], ROWS), 7)
    assert _all(table.read(spark)) == [("a", 2, "y"), ("b", 0, "new")]
    assert table.compact(spark) == 7 and _all(table.read(spark)) == [("a", 2, "y"), ("b", 0, "new")]
    assert _all(table.read_before(spark, 7)) == want


def test_series_that_are_read_several_times_are_computed_once(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start + datetime.timedelta(hours=i), i % 3, "e", float(i * i % 7), "{}") for i in range(60)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    lagged = queries._tank_series(spark, str(tmp_path), 1, 2)
    assert lagged.count() == 60 and "Window" not in _plan(lagged)
