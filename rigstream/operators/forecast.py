"""Per-device ARIMA(p, 1, q) models and forecasts, all devices at once.

Fitting follows Hannan and Rissanen: a long autoregression gives residuals, then the
differences are regressed on their own lags and on the lagged residuals. Both steps need only
sums of products per device, so the data is read by plain aggregates, and the equations that are
solved are a few numbers per device, solved for a batch of devices at once. Coefficients
therefore differ slightly from those of an iterative optimiser. A device whose equations have no
single solution is forecast by its mean difference and marked.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType

from rigstream.operators.decode import computed_once
from rigstream.operators.skew import join_per_key, one_per_instant, with_lags
from rigstream.session import materialised

FORECAST_STEPS = 5
#: Scaled equations with a larger condition number count as having no single solution.
MOST_CONDITION = 1e12
#: Columns of a model beside its key.
MODEL = ["n", "intercept", "ar", "ma", "long_ar", "mean_step", "status"]


def long_order(p: int, q: int) -> int:
    """Order of the autoregression the residuals come from."""
    return p + q + 2 if q else 0


def lagged_series(
    df: DataFrame, key: str, ts: str, value: str, p: int, q: int, slice_ms: int, tie: list[str] | None = None
) -> DataFrame:
    """(key, ts, value, diffs): each reading with its own and its preceding differences."""
    depth = max(p, long_order(p, q) + q)
    series = one_per_instant(df.where(F.col(key).isNotNull()), [key], ts, tie or [], [value])
    lagged = with_lags(series, [key], ts, value, depth + 1, slice_ms)
    chain = F.concat(F.array(value), "lags")
    pairs = F.arrays_zip(F.slice(chain, 1, depth + 1).alias("now"), F.slice(chain, 2, depth + 1).alias("before"))
    return lagged.select(key, ts, value, F.transform(pairs, lambda pair: pair["now"] - pair["before"]).alias("diffs"))


def _products(features: list[Column]) -> Column:
    """Sums of the products of all feature pairs, upper triangle by row."""
    sums = [F.sum(a * b) for i, a in enumerate(features) for b in features[i:]]
    return F.array(*sums)


def _all_known(features: list[Column]) -> Column:
    known = F.lit(True)
    for feature in features:
        known = known & feature.isNotNull()
    return known


def _solver(width: int):
    """A column function that solves least squares from packed product sums; the target comes last."""
    rows, columns = np.triu_indices(width)

    @F.pandas_udf("array<double>")
    def solve(packed: pd.Series) -> pd.Series:
        out: list[list[float] | None] = [None] * len(packed)
        if not out:
            return pd.Series(out, dtype=object)
        sums = np.array([[np.nan if x is None else x for x in row] for row in packed], dtype=float)
        full = np.empty((len(packed), width, width))
        full[:, rows, columns] = full[:, columns, rows] = sums
        left, right = full[:, :-1, :-1], full[:, :-1, -1]
        scale = np.sqrt(np.einsum("kii->ki", left))
        at = np.nonzero(np.isfinite(sums).all(axis=1) & (scale > 0).all(axis=1))[0]
        scale = scale[at]
        scaled = left[at] / (scale[:, :, None] * scale[:, None, :])
        regular = np.linalg.cond(scaled) < MOST_CONDITION
        at, scale, scaled = at[regular], scale[regular], scaled[regular]
        solved = np.linalg.solve(scaled, (right[at] / scale)[:, :, None])[:, :, 0] / scale
        for i, beta in zip(at, solved):
            out[i] = beta.tolist()
        return pd.Series(out)

    return solve


def _regress(df: DataFrame, key: str, features: list[Column], into: str, **more: Column) -> DataFrame:
    """Least-squares coefficients of every key, null where they are not determined; ``features`` end with the target.

    ``n`` counts the rows in which all features are known; ``more`` are further aggregates.
    """
    known = _all_known(features)
    named = [F.col(f"_f{i}") for i in range(len(features))]
    told = df.withColumns({f"_f{i}": F.when(known, feature) for i, feature in enumerate(features)})
    count = F.count(named[-1]).alias("n")
    sums = told.groupBy(key).agg(_products(named).alias("_sums"), count, *[c.alias(name) for name, c in more.items()])
    enough = sums.withColumn("_sums", F.when(F.col("n") >= len(features), F.col("_sums")))
    packed = F.coalesce("_sums", F.array(*[F.lit(None).cast("double")] * (len(features) * (len(features) + 1) // 2)))
    return computed_once(enough, into, _solver(len(features))(packed)).drop("_sums")


def _lag(k: int) -> Column:
    return F.get("diffs", F.lit(k))


def _residual(k: int, order: int) -> Column:
    """The long autoregression's error ``k`` readings back."""
    guess = F.get("long_ar", F.lit(0))
    for i in range(1, order + 1):
        guess = guess + F.get("long_ar", F.lit(i)) * _lag(k + i)
    return _lag(k) - guess


def fit(lagged: DataFrame, key: str, p: int, q: int) -> DataFrame:
    """One model for every key: (key, n, intercept, ar, ma, long_ar, mean_step, status).

    ``status`` is ``fitted`` where the equations have one solution. Constant or exactly linear series,
    and series too short, are modelled by their mean difference (``mean``), and a single
    reading by no change (``level``); ``n`` counts the differences that the model rests on.
    """
    ones = F.lit(1.0)
    means = {"mean_step": F.avg(_lag(0)), "_steps": F.count(_lag(0)), "_rows": F.count(F.lit(1))}
    order = long_order(p, q)
    if not q:
        rows = _regress(lagged, key, [ones, *[_lag(k) for k in range(1, p + 1)], _lag(0)], "_beta", **means)
        rows = rows.withColumn("long_ar", F.array().cast("array<double>"))
    else:
        plain = _regress(lagged, key, [ones, *[_lag(k) for k in range(1, order + 1)], _lag(0)], "long_ar", **means)
        first = materialised(plain)
        determined = first.where(F.col("long_ar").isNotNull()).select(key, "_rows", "long_ar")
        with_long = join_per_key(lagged, determined, [key], "_rows")
        errors = [_residual(k, order) for k in range(1, q + 1)]
        features = [ones, *[_lag(k) for k in range(1, p + 1)], *errors, _lag(0)]
        rows = first.drop("n").join(_regress(with_long, key, features, "_beta"), key, "left")
    return _models(rows, key, p, q)


def _models(rows: DataFrame, key: str, p: int, q: int) -> DataFrame:
    """Models of what the two regressions gave: ``_beta``, ``n``, ``long_ar``, ``mean_step``, ``_steps``."""
    nothing, order = F.array().cast("array<double>"), long_order(p, q)
    is_fitted, step = F.col("_beta").isNotNull(), F.coalesce("mean_step", F.lit(0.0))

    def zeros(count: int) -> Column:
        return F.array_repeat(F.lit(0.0), count)

    return rows.select(
        key,
        F.when(is_fitted, F.col("n")).otherwise(F.col("_steps")).alias("n"),
        F.when(is_fitted, F.get("_beta", F.lit(0))).otherwise(step).alias("intercept"),
        (F.when(is_fitted, F.slice("_beta", 2, p)).otherwise(zeros(p)) if p else nothing).alias("ar"),
        (F.when(is_fitted, F.slice("_beta", p + 2, q)).otherwise(zeros(q)) if q else nothing).alias("ma"),
        (F.when(is_fitted, F.col("long_ar")).otherwise(F.concat(F.array(step), zeros(order))) if q else nothing).alias("long_ar"),
        "mean_step",
        F.when(is_fitted, "fitted").when(F.col("_steps") > 0, "mean").otherwise("level").alias("status"),
    )


# ---------------------------------------------------------------- models kept up to date
#
# Both regressions need sums of products only, and the residuals of the second are linear in the
# differences. So sums of products of the differences themselves, which add up over batches, are all
# that a refit needs; the second regression's equations follow from them by the long autoregression.

#: What a device's sums consist of, beside its key and the readings its next differences need.
SUMS = ["first", "first_n", "second", "second_n", "steps", "total"]


def readings_needed(p: int, q: int) -> int:
    """How many of a device's last readings the next differences and the forecast need."""
    return max(p, long_order(p, q) + q) + 2


def product_sums(lagged: DataFrame, key: str, p: int, q: int) -> DataFrame:
    """The sums (SUMS) over the rows of each key, which ``merged_sums`` adds up and ``fit_sums`` solves."""
    depth = max(p, long_order(p, q) + q)
    stages = {"first": [*range(1, (long_order(p, q) if q else p) + 1), 0], "second": range(depth + 1) if q else []}
    aggregates = []
    told = lagged
    for name, lags in stages.items():
        features = [F.lit(1.0), *[_lag(k) for k in lags]]
        known = _all_known(features)
        told = told.withColumns({f"_{name}{i}": F.when(known, f) for i, f in enumerate(features)})
        named = [F.col(f"_{name}{i}") for i in range(len(features))]
        aggregates += [F.transform(_products(named), lambda x: F.coalesce(x, F.lit(0.0))).alias(name), F.count(named[-1]).alias(name + "_n")]
    total = F.coalesce(F.sum(_lag(0)), F.lit(0.0)).alias("total")
    return told.groupBy(key).agg(*aggregates, F.count(_lag(0)).alias("steps"), total)


def merged_sums(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The sums over the rows of both; one row per key and table."""
    both = old.select(key, *[F.col(c).alias(f"_{c}") for c in SUMS]).join(new, key, "full")

    def added(name: str) -> Column:
        a, b = F.col(f"_{name}"), F.col(name)
        whole = F.zip_with(a, b, lambda x, y: x + y) if name in ("first", "second") else a + b
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(whole).alias(name)

    rest = [c for c in new.columns if c not in (key, *SUMS)]
    return both.select(key, *[added(c) for c in SUMS], *rest)


def _residual_products(p: int, q: int):
    """A column function that turns sums over differences into those of the second regression."""
    order = long_order(p, q)
    width = max(p, order + q) + 2
    upper = np.triu_indices(width)
    wanted = np.triu_indices(p + q + 2)

    @F.pandas_udf("array<double>")
    def turn(packed: pd.Series, long_ar: pd.Series) -> pd.Series:
        out: list[list[float] | None] = [None] * len(packed)
        for i, (sums, beta) in enumerate(zip(packed, long_ar)):
            if sums is None or beta is None:
                continue
            full = np.empty((width, width))
            full[upper] = full[upper[::-1]] = np.asarray(sums, dtype=float)
            # rows of this matrix: 1, the lagged differences, the lagged residuals, the difference
            by = np.zeros((p + q + 2, width))
            by[0, 0] = by[-1, 1] = 1.0
            for k in range(1, p + 1):
                by[k, 1 + k] = 1.0
            for k in range(1, q + 1):
                by[p + k, 0] = -beta[0]
                by[p + k, 1 + k] += 1.0
                by[p + k, 2 + k : 2 + k + order] -= np.asarray(beta[1:], dtype=float)
            out[i] = (by @ full @ by.T)[wanted].tolist()
        return pd.Series(out, dtype=object)

    return turn


def fit_sums(sums: DataFrame, key: str, p: int, q: int) -> DataFrame:
    """The models that ``fit`` makes of the rows that ``sums`` were taken of, without those rows."""
    order = long_order(p, q)

    def enough(column: str, count: str, width: int) -> Column:
        nothing = F.array(*[F.lit(None).cast("double")] * (width * (width + 1) // 2))
        return F.coalesce(F.when(F.col(count) >= width, F.col(column)), nothing)

    rows = sums.withColumns({"mean_step": F.when(F.col("steps") > 0, F.col("total") / F.col("steps")), "_steps": F.col("steps")})
    if not q:
        rows = computed_once(rows, "_beta", _solver(p + 2)(enough("first", "first_n", p + 2)))
        rows = rows.withColumns({"long_ar": F.array().cast("array<double>"), "n": F.col("first_n")})
    else:
        rows = computed_once(rows, "long_ar", _solver(order + 2)(enough("first", "first_n", order + 2)))
        rows = computed_once(rows, "_turned", _residual_products(p, q)("second", "long_ar"))
        rows = rows.withColumn("n", F.col("second_n"))
        rows = computed_once(rows, "_beta", _solver(p + q + 2)(enough("_turned", "n", p + q + 2)))
    return _models(rows, key, p, q)


def last_readings(series: DataFrame, key: str, ts: str, value: str, p: int, q: int) -> DataFrame:
    """``tail``: each key's last readings, latest first, as many as its next differences need."""
    latest = Window.partitionBy(key).orderBy(F.desc(ts))
    few = series.withColumn("_at", F.row_number().over(latest)).where(F.col("_at") <= readings_needed(p, q))
    tail = F.sort_array(F.collect_list(F.struct(F.col(ts).alias("ts"), F.col(value).alias("value"))), asc=False)
    return few.groupBy(key).agg(tail.alias("tail"))


def from_tail(kept: DataFrame, key: str, ts: str, value: str, p: int, q: int) -> DataFrame:
    """The last row of ``lagged_series`` of each key, from its ``tail``."""
    depth = readings_needed(p, q) - 2
    padded = F.concat(F.transform("tail", lambda r: r["value"]), F.array_repeat(F.lit(None).cast("double"), depth + 2))
    pairs = F.arrays_zip(F.slice(padded, 1, depth + 1).alias("now"), F.slice(padded, 2, depth + 1).alias("before"))
    diffs = F.transform(pairs, lambda pair: pair["now"] - pair["before"])
    return kept.select(key, F.col("tail")[0]["ts"].alias(ts), F.col("tail")[0]["value"].alias(value), diffs.alias("diffs"))


def advanced(kept: DataFrame | None, readings: DataFrame, key: str, ts: str, value: str, p: int, q: int, slice_ms: int) -> DataFrame:
    """What is kept of each device (``key``, ``tail``, SUMS, ``last_ts``) after further readings.

    Readings without a device or value are left out, and so are those at or before the device's last one, as
    the differences around them are already counted.
    """
    known = readings.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(key, ts, F.col(value).cast("double").alias(value))
    mine = None
    if kept is not None:
        counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        mine = materialised(counts.join(kept, key, "left"))
        later = _after_last(known, mine, key, ts)
        old = mine.select(key, F.explode("tail").alias("_r")).select(key, F.col("_r.ts").alias(ts), F.col("_r.value").alias(value))
        known = later.unionByName(old)
    known = materialised(one_per_instant(known, [key], ts, [], [value]))
    lagged = lagged_series(known, key, ts, value, p, q, slice_ms)
    if mine is not None:
        lagged = _after_last(lagged, mine, key, ts)
    new = product_sums(lagged, key, p, q).join(last_readings(known, key, ts, value, p, q), key)
    new = new.withColumn("last_ts", F.col("tail")[0]["ts"])
    if mine is None:
        return new
    return merged_sums(mine.where(F.col("last_ts").isNotNull()).join(new.select(key), key, "left_semi"), new, key)


def _after_last(rows: DataFrame, mine: DataFrame, key: str, ts: str) -> DataFrame:
    """The rows behind their device's last reading so far."""
    told = join_per_key(rows, mine.select(key, "_rows", F.col("last_ts").alias("_last")), [key], "_rows")
    return told.where(F.col("_last").isNull() | (F.col(ts) > F.col("_last"))).select(*rows.columns)


@F.pandas_udf(BooleanType())
def roots_outside(coefficients: pd.Series) -> pd.Series:
    """Whether all roots of 1 - c1 z - c2 z^2 - ... lie outside the unit circle."""

    def outside(values: np.ndarray) -> bool:
        polynomial = np.append(-np.asarray(values, dtype=float)[::-1], 1.0)
        return bool((np.abs(np.roots(polynomial)) > 1.0).all())

    return coefficients.map(outside)


def is_usable(models: DataFrame) -> DataFrame:
    """Add ``stationary`` and ``invertible``."""
    return models.withColumns(
        {
            "stationary": roots_outside("ar"),
            "invertible": roots_outside(F.transform("ma", lambda c: -c)),
        }
    )


def fit_or_reuse(lagged: DataFrame, stored: DataFrame, key: str, p: int, q: int) -> DataFrame:
    """Keep stored models that were fitted and are stationary and invertible; model the other keys anew."""
    is_good = F.col("stationary") & F.col("invertible") & (F.col("status") == "fitted")
    good = is_usable(stored).where(is_good).select(key, *MODEL)
    keys = lagged.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    stale = keys.join(good, key, "left_anti")
    fresh = fit(join_per_key(lagged, stale, [key], "_rows"), key, p, q)
    return good.join(keys, key, "left_semi").unionByName(fresh.select(key, *MODEL))


def _predictor(p: int, q: int, steps: int):
    order = long_order(p, q)

    @F.pandas_udf("array<double>")
    def predict(level: pd.Series, diffs: pd.Series, intercept: pd.Series, ar: pd.Series, ma: pd.Series, long_ar: pd.Series) -> pd.Series:
        if not len(level):
            return pd.Series([], dtype=object)
        # row k of these tables belongs to device k
        x, past, c = level.to_numpy(float), np.array(diffs.tolist(), dtype=float), intercept.to_numpy(float)
        phi, theta, long = (np.array(v.tolist(), dtype=float).reshape(len(x), -1) for v in (ar, ma, long_ar))
        recent = past[:, :p]
        errors = np.empty((len(x), q))
        for k in range(q):
            errors[:, k] = past[:, k] - long[:, 0] - (long[:, 1:] * past[:, k + 1 : k + 1 + order]).sum(axis=1)
        path = np.empty((len(x), steps))
        for i in range(steps):
            step = c + (phi * recent).sum(axis=1) + (theta * errors).sum(axis=1)
            x = x + step
            path[:, i] = x
            recent = np.column_stack([step, recent])[:, :p]
            errors = np.column_stack([np.zeros(len(x)), errors])[:, :q]
        return pd.Series(list(path))

    return predict


def forecast(lagged: DataFrame, models: DataFrame, key: str, ts: str, value: str, p: int, q: int, steps: int = FORECAST_STEPS) -> DataFrame:
    """The next ``steps`` values of each modelled key with a known value: (key, step, forecast, status).

    Where the last differences are not all known, the model's mean difference continues the series.
    """
    needed = max(p, long_order(p, q) + q)
    reading = F.struct(F.col(value).alias("level"), F.slice("diffs", 1, needed).alias("diffs") if needed else "diffs")
    last = lagged.where(F.col(value).isNotNull()).groupBy(key).agg(F.max_by(reading, ts).alias("last"))
    joined = last.join(models, key)
    is_fitted = F.col("status") == "fitted"
    if needed:
        is_fitted = is_fitted & F.forall("last.diffs", lambda d: d.isNotNull())
    step = F.coalesce("mean_step", F.lit(0.0))

    def fallback(column: str, count: int) -> Column:
        return F.when(is_fitted, F.col(column)).otherwise(F.array_repeat(F.lit(0.0), count))

    ready = joined.select(
        key, "last.level", F.transform("last.diffs", lambda d: F.coalesce(d, F.lit(0.0))).alias("diffs"),
        F.when(is_fitted, F.col("intercept")).otherwise(step).alias("intercept"),
        fallback("ar", p).alias("ar"), fallback("ma", q).alias("ma"),
        fallback("long_ar", long_order(p, q) + 1 if q else 0).alias("long_ar"),
        F.when(is_fitted, "fitted").when(F.col("mean_step").isNotNull(), "mean").otherwise("level").alias("status"),
    )
    path = _predictor(p, q, steps)("level", "diffs", "intercept", "ar", "ma", "long_ar")
    return ready.select(key, "status", F.posexplode(path).alias("step", "forecast")).select(
        key, (F.col("step") + 1).alias("step"), "forecast", "status"
    )
