"""Sliced operators against plain folds, on random series."""

import numpy as np
import pandas as pd
import pytest
from folds import moving_anchor, running_rate
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rigstream.operators import aggregates, anchors, forecast, rate, skew
from rigstream.operators.panes import duration_ms, pane_ms

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DDL = "id string, ts bigint, seq bigint, level double"

points = st.lists(
    st.tuples(st.sampled_from(["a", "b", "hot"]), st.integers(-500, 3000), st.integers(-4, 4)), min_size=1, max_size=150
)


def _rows(found):
    return [(key, ts, seq, float(level)) for seq, (key, ts, level) in enumerate(found)]


def _by_key(rows):
    groups = {}
    for key, ts, seq, level in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(key, []).append((ts, level))
    return groups


@SLOW
@given(points, st.integers(1, 40), st.integers(0, 200), st.sampled_from([1, 2, 7]))
def test_moving_anchor(spark, found, min_ms, extra, segment_windows):
    rows, max_ms = _rows(found), min_ms + extra
    df = spark.createDataFrame(rows, DDL)
    paired = anchors.with_moving_anchor(
        df, min_ms, max_ms, value="level", tie=["seq"], segment_windows=segment_windows
    )
    got = sorted((r.id, r.ts, r.level, r.anchor_ts, r.anchor_value) for r in paired.collect())
    want = sorted((k, *r) for k, series in _by_key(rows).items() for r in moving_anchor(series, min_ms, max_ms))
    assert got == want


@pytest.mark.parametrize("segment_windows", [3, 128])
def test_moving_anchor_on_a_dense_hot_device(spark, segment_windows):
    draw = np.random.default_rng(7)
    ts = np.cumsum(draw.integers(1, 9, 20_000))
    rows = [("hot", int(t), i, float(i % 17)) for i, t in enumerate(ts)] + [("cold", 5, 0, 1.0), ("cold", 9, 1, 2.0)]
    df = spark.createDataFrame(rows, DDL)
    paired = anchors.with_moving_anchor(df, 2, 50, value="level", tie=["seq"], segment_windows=segment_windows)
    got = sorted((r.id, r.ts, r.level, r.anchor_ts, r.anchor_value) for r in paired.collect())
    want = sorted((k, *r) for k, series in _by_key(rows).items() for r in moving_anchor(series, 2, 50))
    assert got == want


@pytest.mark.parametrize("batch", [1, 7, 100])
def test_segments_that_span_batches(batch):
    """The passes over cut batches against a plain chain, without holding a segment."""
    draw = np.random.default_rng(batch)
    max_ms, segment_ms = 20, 100
    series = {key: np.unique(draw.integers(-300, 900, n)) for key, n in {"a": 1, "b": 5, "hot": 2_000, "z": 30}.items()}
    rows = pd.DataFrame([(k, t // segment_ms, t, t / 2) for k, ts in series.items() for t in ts.tolist()], columns=["id", "segment", "ts", "value"])

    def cut(df):
        return iter([df.iloc[i : i + batch] for i in range(0, len(df), batch)] + [df.iloc[:0]])

    steps = pd.concat(anchors._all_steps(cut(rows), max_ms, segment_ms)).sort_values(["id", "segment", "entry_ts"])
    entered = pd.concat(anchors._walk_steps(cut(steps), max_ms))
    assert len(entered) == len(rows[["id", "segment"]].drop_duplicates())
    found = pd.concat(anchors._all_anchors(cut(rows.merge(entered, on=["id", "segment"])), max_ms, segment_ms))
    want = []
    for key, ts in series.items():
        current = None
        for t in ts.tolist():
            if current is None or t - current > max_ms:
                current = t
                want.append((key, t, t / 2))
    assert sorted(found.itertuples(index=False, name=None)) == sorted(want)


def test_a_cursor_holds_no_more_ways_than_readings_of_one_reach():
    cursor = anchors._StepCursor(60, 128 * 60)
    for begin in range(0, 128 * 60, 500):
        ts = np.arange(begin, min(begin + 500, 128 * 60))
        cursor.add(pd.DataFrame({"ts": ts, "segment": 0}))
        assert len(cursor.entry) <= 62


def test_moving_anchor_over_small_arrow_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    size = spark.conf.get(name)
    draw = np.random.default_rng(8)
    rows = [("hot", int(t), i, float(i % 17)) for i, t in enumerate(np.cumsum(draw.integers(1, 9, 3_000)))] + [("cold", 5, 0, 1.0), ("cold", 9, 1, 2.0)]
    try:
        spark.conf.set(name, "50")
        paired = anchors.with_moving_anchor(spark.createDataFrame(rows, DDL), 2, 50, value="level", tie=["seq"])
        got = sorted((r.id, r.ts, r.level, r.anchor_ts, r.anchor_value) for r in paired.collect())
    finally:
        spark.conf.set(name, size)
    assert got == sorted((k, *r) for k, series in _by_key(rows).items() for r in moving_anchor(series, 2, 50))


WINDOWS = [("300 milliseconds", "100 milliseconds"), ("250 milliseconds", "100 milliseconds"), ("1 second", "1 second"), ("70 milliseconds", "30 milliseconds")]


@SLOW
@given(points, st.sampled_from(WINDOWS), st.sampled_from([1, 5, 64]))
def test_overlapping_windows(spark, found, windows, slices):
    rows, (window, slide) = _rows(found), windows
    length, step = duration_ms(window), duration_ms(slide)
    df = spark.createDataFrame(rows, DDL)
    series, levels = {}, {}
    for key, group in _by_key(rows).items():
        for ts, level in group:
            for start in range((ts - length) // step * step + step, ts + 1, step):
                series.setdefault((key, start), []).append((ts, level))
                levels.setdefault(start, []).append((ts, key, level))
    got = aggregates.window_series(df, "id", "level", "ts", window, tie=["seq"], slices=slices, slide=slide).collect()
    numbered = {(k, start, n): point for (k, start), points_ in series.items() for n, point in enumerate(points_, 1)}
    assert {(r.id, r.window_start, r.position): (r.ts, r.level) for r in got} == numbered and len(got) == len(numbered)
    for r in rate.running_rate(df, "id", "level", "ts", window, tie=["seq"], slices=slices, slide=slide).collect():
        last, average, level = running_rate(series[r.id, r.window_start])
        assert (r.ts, r.level) == (last, level) and r.rate == pytest.approx(average, rel=1e-9, abs=1e-9)
    got = aggregates.window_extrema(df, "level", "ts", window, slide=slide).collect()
    assert {r.window_start for r in got} == set(levels)
    for r in got:
        here = levels[r.window_start]
        assert (r.ts, r.id) == min(here)[:2] and (r.max, r.min) == (max(x[2] for x in here), min(x[2] for x in here))
        assert (r.window.end - r.window.start).total_seconds() * 1000 == length


def test_durations():
    assert [duration_ms(t) for t in ("5 milliseconds", "1 second", "90 Minutes", "1 hour 30 minutes", "1 week")] == [5, 1_000, 5_400_000, 5_400_000, 604_800_000]
    for text in ("", "hour", "1 month", "5 parsecs", "1 hour and"):
        with pytest.raises(ValueError):
            duration_ms(text)
    with pytest.raises(ValueError):
        pane_ms("1 hour", "2 hours")


@SLOW
@given(points, st.sampled_from([1, 5, 64]))
def test_running_rate(spark, found, slices):
    rows = _rows(found)
    df = spark.createDataFrame(rows, DDL)
    out = rate.running_rate(df, "id", "level", "ts", "1 second", tie=["seq"], slices=slices)
    got = {(r.id, r.window_start): (r.ts, r.rate, r.level) for r in out.collect()}
    groups = {}
    for key, series in _by_key(rows).items():
        for ts, level in series:
            groups.setdefault((key, ts // 1000 * 1000), []).append((ts, level))
    assert set(got) == set(groups)
    for key, series in groups.items():
        ts, average, level = running_rate(series)
        assert got[key][0] == ts and got[key][2] == level
        assert got[key][1] == pytest.approx(average, rel=1e-9, abs=1e-9)


@SLOW
@given(points)
def test_window_series_and_running_extrema(spark, found):
    rows = _rows(found)
    df = spark.createDataFrame(rows, DDL)
    series = aggregates.window_series(df, "id", "level", "ts", "1 second", tie=["seq"], slices=7)
    got = sorted((r.id, r.window_start, r.position, r.ts, r.level) for r in series.collect())
    want, at = [], {}
    for key, pts in _by_key(rows).items():
        for ts, level in pts:
            window = ts // 1000 * 1000
            at[key, window] = at.get((key, window), 0) + 1
            want.append((key, window, at[key, window], ts, level))
    assert got == sorted(want)

    extrema = aggregates.running_extrema(aggregates.window_extrema(df, "level", "ts", "100 milliseconds"), block="second")
    high, low, expected, windows = -1e9, 1e9, [], {}
    for _, ts, _, level in rows:
        windows.setdefault(ts // 100 * 100, []).append(level)
    for window in sorted(windows):
        high, low = max(high, *windows[window]), min(low, *windows[window])
        expected.append((window, high, low))
    assert sorted((r.window_start, r["max"], r["min"]) for r in extrema.collect()) == expected


@SLOW
@given(points, st.integers(1, 4), st.sampled_from([10, 400, 10_000]))
def test_lags(spark, found, lags, slice_ms):
    latest = {(key, ts): level for key, ts, _, level in _rows(found)}
    df = spark.createDataFrame(_rows(found), DDL)
    one = skew.one_per_instant(df, ["id"], "ts", ["seq"], ["level"])
    got = {(r.id, r.ts): (r.level, list(r.lags)) for r in skew.with_lags(one, ["id"], "ts", "level", lags, slice_ms).collect()}
    want = {}
    for key, ts in latest:
        earlier = [latest[k, t] for k, t in sorted(latest) if k == key and t < ts][::-1][:lags]
        want[key, ts] = (latest[key, ts], earlier + [None] * (lags - len(earlier)))
    assert got == want


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_join_per_key_with_a_hot_key(spark, broadcast_bytes):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    per_key = rows.groupBy("k").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    joined = skew.join_per_key(rows, per_key, ["k"], "n", broadcast_bytes)
    assert joined.columns == ["k", "id", "first"]
    got = {r.id: (r.k, r.first) for r in joined.collect()}
    assert got == {i: ((0, 0) if i % 3 == 0 else (i, i)) for i in range(5000)}


def test_previous_reading(spark):
    draw = np.random.default_rng(3)
    rows = [(str(k), int(t), i, float(v)) for i, (k, t, v) in enumerate(draw.integers(0, 400, (600, 3)) % [3, 400, 50])]
    df = spark.createDataFrame(rows, DDL)
    out = anchors.with_previous_reading(df, "id", "ts", ["seq"], "level", slice_ms=30)
    got = sorted((r.id, r.ts, r.level, r.anchor_value) for r in out.collect())
    want = [(k, ts, level, before[1]) for k, s in _by_key(rows).items() for before, (ts, level) in zip(s, s[1:])]
    assert got == sorted(want)


def test_null_values_keep_their_place(spark):
    rows = [("a", 1, 0, 5.0), ("a", 2, 1, None), ("a", 3, 2, 7.0), ("a", 40, 3, 8.0)]
    df = spark.createDataFrame(rows, DDL)
    before = anchors.with_previous_reading(df, "id", "ts", ["seq"], "level", slice_ms=30)
    assert sorted((r.ts, r.anchor_value) for r in before.collect()) == [(2, 5.0), (3, None), (40, 7.0)]
    lagged = skew.with_lags(df.drop("seq"), ["id"], "ts", "level", 2, slice_ms=30)
    assert {r.ts: r.lags for r in lagged.collect()} == {1: [None, None], 2: [5.0, None], 3: [None, 5.0], 40: [7.0, None]}


def _hannan_rissanen(x, p, q):
    """The same estimate by plain least squares."""
    y, order = np.diff(x), forecast.long_order(p, q)
    lag = lambda s, k, at: s[at - k]
    at = np.arange(order, len(y))
    left = np.column_stack([np.ones(len(at))] + [lag(y, k, at) for k in range(1, order + 1)])
    long_ar = np.linalg.lstsq(left, y[at], rcond=None)[0]
    e = np.full(len(y), np.nan)
    e[at] = y[at] - left @ long_ar
    at = np.arange(order + q, len(y))
    left = np.column_stack(
        [np.ones(len(at))] + [lag(y, k, at) for k in range(1, p + 1)] + [lag(e, k, at) for k in range(1, q + 1)]
    )
    beta = np.linalg.lstsq(left, y[at], rcond=None)[0]
    recent, errors, level, path = list(y[::-1][:p]), list(e[::-1][:q]), x[-1], []
    for _ in range(5):
        step = beta[0] + beta[1 : p + 1] @ recent + beta[p + 1 :] @ errors
        level += step
        path.append(level)
        recent, errors = ([step] + recent)[:p], ([0.0] + errors)[:q]
    return beta, path


def test_arima(spark):
    draw = np.random.default_rng(11)
    series = {}
    for key in ("a", "b"):
        noise, y = draw.normal(size=400), np.zeros(400)
        for t in range(2, 400):
            y[t] = 0.1 + 0.6 * y[t - 1] + noise[t] + 0.3 * noise[t - 1] + 0.1 * noise[t - 2]
        series[key] = 100 + np.cumsum(y)
    rows = [(k, i * 100, i, float(v)) for k, s in series.items() for i, v in enumerate(s)] + [("short", 1, 0, 1.0)]
    df = spark.createDataFrame(rows, DDL)
    lagged = forecast.lagged_series(df, "id", "ts", "level", 1, 2, slice_ms=900)
    models = forecast.fit(lagged, "id", 1, 2).cache()
    fitted = {r.id: np.array([r.intercept, *r.ar, *r.ma]) for r in models.collect()}
    assert set(fitted) == {"a", "b", "short"} and fitted["short"] == pytest.approx([0, 0, 0, 0])
    paths = {}
    for r in forecast.forecast(lagged, models, "id", "ts", "level", 1, 2).collect():
        paths.setdefault(r.id, {})[r.step] = r.forecast
    for key, x in series.items():
        beta, path = _hannan_rissanen(x, 1, 2)
        assert fitted[key] == pytest.approx(beta, abs=1e-6)
        assert [paths[key][s] for s in range(1, 6)] == pytest.approx(path, abs=1e-5)
        assert abs(fitted[key][1] - 0.6) < 0.3

    usable = {r.id: (r.stationary, r.invertible) for r in forecast.is_usable(models).collect()}
    assert usable == {"a": (True, True), "b": (True, True), "short": (True, True)}
    # a stored explosive model is fitted anew, a good one is kept as it is
    stored = models.withColumn("ar", F.when(F.col("id") == "a", F.array(F.lit(1.5))).otherwise(F.col("ar"))).withColumn("n", F.lit(-1).cast("bigint"))
    renewed = {r.id: (r.n, list(r.ar)) for r in forecast.fit_or_reuse(lagged, stored, "id", 1, 2).collect()}
    assert renewed["b"][0] == -1 and renewed["a"][0] > 0
    assert renewed["a"][1] == pytest.approx([fitted["a"][1]])


@pytest.mark.parametrize("p, q", [(1, 0), (1, 2), (0, 0), (2, 1)])
def test_every_device_with_a_value_gets_a_forecast(spark, p, q):
    draw = np.random.default_rng(5)
    series = {
        "idle": [7.0] * 40, "rising": [2.0 + 3.0 * i for i in range(40)], "pair": [1.0, 2.5], "single": [4.0],
        "free": draw.normal(size=40).tolist(), "gap": [*draw.normal(size=38).tolist(), None, 6.0], "empty": [None, None],
    }
    df = spark.createDataFrame([(k, i * 100, i, v) for k, s in series.items() for i, v in enumerate(s)], DDL)
    lagged = forecast.lagged_series(df, "id", "ts", "level", p, q, slice_ms=900)
    models = forecast.fit(lagged, "id", p, q)
    assert {r.id for r in models.collect()} == set(series)
    found = {(r.id, r.step): (r.forecast, r.status) for r in forecast.forecast(lagged, models, "id", "ts", "level", p, q).collect()}
    assert {i for i, _ in found} == set(series) - {"empty"}
    for step in range(1, 6):
        assert found["idle", step][0] == pytest.approx(7.0)
        assert found["rising", step][0] == pytest.approx(119.0 + 3.0 * step)
        assert found["pair", step][0] == pytest.approx(2.5 + 1.5 * step)
        assert found["single", step] == (4.0, "level")
        assert found["free", step][1] == "fitted"
        assert np.isfinite(found["gap", step][0])
    assert forecast.forecast(lagged.limit(0), models, "id", "ts", "level", p, q).collect() == []


@pytest.mark.parametrize("p, q", [(1, 0), (1, 2), (2, 1), (0, 1)])
def test_models_kept_over_batches_equal_the_fit_over_all(spark, p, q):
    draw = np.random.default_rng(p * 10 + q)
    rows, cut = [], {}
    for key, n in {"a": 150, "b": 90, "c": 14, "d": 3, "e": 1}.items():
        ts = np.cumsum(draw.integers(1, 90, n)).tolist()
        level = np.cumsum(np.convolve(draw.normal(size=n + 3), [1, 0.5, 0.2, 0.1], "valid")).tolist()
        rows += [(key, t, v) for t, v in zip(ts, level)] + [(key, ts[0], level[0])]
    rows += [("flat", t, 5.0) for t in range(0, 400, 10)]
    df = spark.createDataFrame(rows, "id string, ts bigint, level double")
    lagged = forecast.lagged_series(df, "id", "ts", "level", p, q, 500)
    want = {r.id: r for r in forecast.fit(lagged, "id", p, q).collect()}
    kept = None
    for low, high in ((-1, 700), (700, 2_000), (2_000, 10**9)):
        part = df.where((F.col("ts") > low) & (F.col("ts") <= high))
        if kept is not None:  # readings behind the last one change nothing
            part = part.unionByName(df.where(F.col("ts") <= low).withColumn("level", F.lit(99.0)).where("id <> 'flat'").limit(20))
        new = skew.materialised(forecast.advanced(kept, part, "id", "ts", "level", p, q, 500))
        kept = new if kept is None else skew.materialised(kept.join(new, "id", "left_anti").unionByName(new.select(*kept.columns)))
    got = {r.id: r for r in forecast.fit_sums(kept, "id", p, q).collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert (got[key].n, got[key].status) == (row.n, row.status)
        for name in ("intercept", "ar", "ma", "long_ar", "mean_step"):
            assert got[key][name] == (row[name] and pytest.approx(row[name], rel=1e-5, abs=1e-7)), (key, name)
    path = forecast.forecast(lagged, forecast.fit(lagged, "id", p, q), "id", "ts", "level", p, q)
    again = forecast.forecast(forecast.from_tail(kept, "id", "ts", "level", p, q), forecast.fit_sums(kept, "id", p, q), "id", "ts", "level", p, q)
    want = {(r.id, r.step): r for r in path.collect()}
    for r in again.collect():
        assert r.status == want[r.id, r.step].status and r.forecast == pytest.approx(want[r.id, r.step].forecast, rel=1e-5, abs=1e-6)
