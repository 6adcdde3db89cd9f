"""Fits by moments and likelihood, distribution functions, empirical percentiles and quantile matching."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainfold.operators.climatology import linear_quantile, quantile_of, sliding, with_fields


def fit(df: DataFrame, keys: list[str], value: str, dist: str) -> DataFrame:
    """Parameters of a family for each group, native where they have a closed form."""
    x, mean, std = F.col(value), F.avg(value), F.stddev_samp(value)
    log = F.log(x + 1)
    var0 = F.var_pop(value)
    common = mean * (1 - mean) / var0 - 1
    closed = {
        "norm": {"loc": mean, "scale": std},
        "t": {"loc": mean, "scale": std, "df": (F.count(value) - 1).cast("double")},
        "norm_inf": {"loc": mean, "scale": std * 1.04},
        "lognorm": {"s": F.stddev_pop(log), "loc": F.lit(-1.0), "scale": F.exp(F.avg(log))},
        "gamma": {"shape": mean * mean / (std * std), "loc": F.lit(0.0), "scale": std * std / mean},
        "beta": {"a": mean * common, "b": (1 - mean) * common, "loc": F.lit(0.0), "scale": F.lit(1.0)},
    }
    if dist == "empirical":
        return df.where(x.isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("ref_values"))
    if dist in closed:
        return df.where(x.isNotNull()).groupBy(*keys).agg(*(v.alias(k) for k, v in closed[dist].items()))
    solve = {"weibull": fit_weibull, "gev": fit_gev}[dist]
    rows = df.where(x.isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(x.cast("double"))).alias("_values"))
    names = ("shape", "loc", "scale")

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                found = solve(part.column("_values").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), *(pa.array(c, from_pandas=True) for c in found)], names=[*keys, *names])

    return rows.mapInArrow(batches_of, with_fields(rows, keys, *(f"{c} double" for c in names)))


#: Groups fitted at a time.
TOGETHER = 512


def _padded(values: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """The lists as rows of one table, and which of its places are theirs."""
    known = np.arange(max(map(len, values), default=0))[None, :] < np.array([len(v) for v in values])[:, None]
    x = np.zeros(known.shape)
    x[known] = [v for own in values for v in own]
    return x, known


def fit_weibull(values: list[list[float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximum likelihood with location 0 for each list: Newton's method on the shapes of all lists at once. NaN without two different positive values."""
    x, known = _padded([[v for v in own if v > 0] for own in values])
    n = known.sum(axis=1)
    log = np.log(np.where(known, x, 1.0))
    top = np.where(known, log, -np.inf).max(axis=1, initial=-np.inf)
    fit_ = np.flatnonzero((n > 1) & (np.where(known, log, np.inf).min(axis=1, initial=np.inf) < top))
    shape, scale = np.full(len(values), np.nan), np.full(len(values), np.nan)
    log, known, n, top = log[fit_], known[fit_], n[fit_], top[fit_]
    total = lambda v: np.where(known, v, 0.0).sum(axis=1)
    mean = total(log) / n
    k = 1.2 / np.maximum(np.sqrt(total((log - mean[:, None]) ** 2) / n), 1e-9)
    for _ in range(100):
        p = np.exp(k[:, None] * (log - top[:, None]))
        a, b, c = total(p), total(p * log), total(p * log * log)
        step = (b / a - 1 / k - mean) / ((c * a - b * b) / a**2 + 1 / k**2)
        k = np.maximum(k - step, k / 10)
        if (np.abs(step) < 1e-12 * k).all():
            break
    shape[fit_] = k
    scale[fit_] = np.exp(top) * (total(np.exp(k[:, None] * (log - top[:, None]))) / n) ** (1 / k)
    return shape, np.zeros(len(values)), scale


def gev_loss(p: np.ndarray, x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Negative log likelihood of each row of ``x`` under its parameters (shape, location, logarithm of the scale)."""
    k, z = p[:, :1], (x - p[:, 1:2]) / np.exp(p[:, 2:])
    with np.errstate(all="ignore"):
        y = 1 - k * z
        log = np.log(np.where(known & (y > 0), y, 1.0))
        each = np.where(np.abs(k) < 1e-9, z + np.exp(-z), (1 - 1 / k) * log + np.exp(log / k))
        out = known.sum(axis=1) * p[:, 2] + np.where(known, each, 0.0).sum(axis=1)
    return np.where((known & (y <= 0) & (np.abs(k) >= 1e-9)).any(axis=1) | np.isnan(out), np.inf, out)


def fit_gev(values: list[list[float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximum likelihood for each sorted list, by simplex searches from L-moments, all lists moving at once. The sign of the shape is that of c = -xi. NaN without three
    values that differ."""
    out = np.full((len(values), 3), np.nan)
    left = np.array([i for i, own in enumerate(values) if len(own) > 2 and own[0] < own[-1]], int)
    if not len(left):
        return tuple(out.T)
    x, known = _padded([values[i] for i in left])
    n, i = known.sum(axis=1), np.arange(x.shape[1])
    b0, b1, b2 = x.sum(axis=1) / n, (i * x).sum(axis=1) / n / (n - 1), (i * (i - 1) * x).sum(axis=1) / n / (n - 1) / (n - 2)
    l2, t3 = 2 * b1 - b0, (6 * b2 - 6 * b1 + b0) / (2 * b1 - b0)
    c = 2 / (3 + t3) - math.log(2) / math.log(3)
    k = 7.859 * c + 2.9554 * c * c
    k = np.where(np.abs(k) > 1e-6, k, 1e-6)
    gamma = np.array([math.gamma(1 + v) for v in k])
    scale = l2 * k / ((1 - 2**-k) * gamma)
    start = np.stack([k, b0 - scale * (1 - gamma) / k, np.log(scale)], axis=1)
    points = np.repeat(start[:, None, :], 4, axis=1)
    for j, step in enumerate((0.05, 0.1 * scale, 0.1)):
        points[:, j + 1, j] += step
    loss = lambda p: gev_loss(p, x, known)
    costs = np.stack([loss(points[:, j]) for j in range(4)], axis=1)
    for _ in range(2000):
        order = np.argsort(costs, axis=1, kind="stable")
        points, costs = np.take_along_axis(points, order[:, :, None], 1), np.take_along_axis(costs, order, 1)
        open_ = ~(np.abs(costs[:, 3] - costs[:, 0]) < 1e-12 * (1 + np.abs(costs[:, 0])))
        out[left[~open_]] = points[~open_, 0]
        left, points, costs, x, known = (v[open_] for v in (left, points, costs, x, known))
        if not len(left):
            break
        centre = points[:, :3].mean(axis=1)
        away = centre - points[:, 3]
        to, far, near = centre + away, centre + 2 * away, centre - 0.5 * away
        at, at_far, at_near = loss(to), loss(far), loss(near)
        best, fine, inner = at < costs[:, 0], at < costs[:, 2], at_near < costs[:, 3]
        pick = lambda of_far, of_to, of_near, else_: np.select([best & (at_far < at), fine, ~best & ~fine & inner], [of_far, of_to, of_near], else_)  # noqa: B023, E731
        points[:, 3] = np.stack([pick(far[:, j], to[:, j], near[:, j], points[:, 3, j]) for j in range(3)], axis=1)
        costs[:, 3] = pick(at_far, at, at_near, costs[:, 3])
        if len(shrink := np.flatnonzero(~best & ~fine & ~inner)):
            points[shrink, 1:] = points[shrink, :1] + 0.5 * (points[shrink, 1:] - points[shrink, :1])
            costs[shrink, 1:] = np.stack([gev_loss(points[shrink, j], x[shrink], known[shrink]) for j in (1, 2, 3)], axis=1)
    out[left] = points[:, 0]
    return out[:, 0], out[:, 1], np.exp(out[:, 2])


def _lgamma(x: np.ndarray) -> np.ndarray:
    own, at = np.unique(x, return_inverse=True)  # a parameter is the same for all rows of a group
    return np.array([math.lgamma(v) if v > 0 else math.nan for v in own])[at].reshape(np.shape(x))


def gamma_p(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma function: a series below a + 1, a continued fraction above."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    y = np.where(x > 0, x, 1.0)
    front = np.exp(-y + a * np.log(y) - _lgamma(a))
    low, total, term = np.where(y < a + 1, y, 0.0), 1 / a, 1 / a
    terms = 1000 + 12 * math.isqrt(int(np.nanmax(np.where(np.isfinite(a), a, 0.0), initial=0.0)))  # near its mean, terms fall within some deviations
    for i in range(1, terms):
        term = term * low / (a + i)
        total = total + term
        if not (np.abs(term) > 1e-16 * np.abs(total)).any():
            break
    high = np.where(y < a + 1, a + 1, y)
    b, c = high + 1 - a, np.full(y.shape, 1e300)
    d = 1 / b
    h = d
    for i in range(1, terms):
        an = -i * (i - a)
        b = b + 2
        d, c = an * d + b, b + an / c
        d, c = 1 / np.where(d == 0, 1e-300, d), np.where(c == 0, 1e-300, c)
        h = h * d * c
        if not (np.abs(d * c - 1) > 1e-15).any():
            break
    return np.where(x <= 0, 0.0, np.where(y < a + 1, total * front, 1 - front * h))


def beta_i(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by a continued fraction, mirrored where that converges faster."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    inside = (x > 0) & (x < 1)
    y = np.where(inside, x, 0.5)
    swap = y > (a + 1) / (a + b + 2)
    a, b, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - y, y)
    front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(y) + b * np.log1p(-y)) / a
    c, d = np.ones(y.shape), 1 / (1 - (a + b) * y / (a + 1))
    h = d
    for m in range(1, 500):
        for an in (m * (b - m) * y / (a + 2 * m - 1) / (a + 2 * m), -(a + m) * (a + b + m) * y / (a + 2 * m) / (a + 2 * m + 1)):
            d, c = 1 + an * d, 1 + an / c
            d, c = 1 / np.where(d == 0, 1e-300, d), np.where(c == 0, 1e-300, c)
            h = h * d * c
        if not (np.abs(d * c - 1) > 1e-15).any():
            break
    out = np.where(swap, 1 - front * h, front * h)
    return np.where(inside, out, (x >= 1).astype(float))


def _normal(z: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.sign(z) * gamma_p(np.full(np.shape(z), 0.5), z * z / 2)


def cdf_of(dist: str, x, p: dict) -> np.ndarray:
    """Distribution function at ``x`` for arrays of values and parameters; NaN for a group of one, whose scale isn't positive."""
    p = {k: np.asarray(v, float) for k, v in p.items()}
    scale = np.where(p["scale"] > 0, p["scale"], np.nan)
    z = (np.asarray(x, float) - p["loc"]) / scale
    above = np.where(z > 0, z, 1.0)
    with np.errstate(all="ignore"):
        if dist in ("norm", "norm_inf"):
            out = _normal(z)
        elif dist == "t":
            tail = beta_i(p["df"] / 2, 0.5, p["df"] / (p["df"] + z * z)) / 2
            out = np.where(z > 0, 1 - tail, tail)
        elif dist == "lognorm":
            out = np.where(z > 0, _normal(np.log(above) / p["s"]), 0.0)
        elif dist == "gamma":
            out = gamma_p(p["shape"], z)
        elif dist == "beta":
            out = beta_i(p["a"], p["b"], z)
        elif dist == "weibull":
            out = np.where(z > 0, -np.expm1(-(above ** p["shape"])), 0.0)
        elif dist == "gev":
            k = p["shape"]
            y = 1 - k * z
            bent = np.where(y > 0, np.exp(-(np.where(y > 0, y, 1.0) ** (1 / np.where(k == 0, 1.0, k)))), (k > 0).astype(float))
            out = np.where(np.abs(k) < 1e-12, np.exp(-np.exp(-z)), bent)
        else:
            raise ValueError(f"no distribution {dist!r}")
        return np.where(np.isnan(z), np.nan, out)


def ppf_of(dist: str, q, p: dict) -> np.ndarray:
    """Inverse of the distribution function, all values at once, by bisection of brackets that are widened first."""
    p = {k: np.asarray(v, float) for k, v in p.items()}
    low, high = np.broadcast_arrays(p["loc"] - p["scale"], p["loc"] + p["scale"] + np.zeros(np.shape(q)))
    low, high = low.copy(), high.copy()
    for _ in range(600):
        far = (cdf_of(dist, low, p) > q) & (low > -1e300)
        if not far.any():
            break
        low = np.where(far, low - 2 * (high - low), low)
    for _ in range(600):
        far = (cdf_of(dist, high, p) < q) & (high < 1e300)
        if not far.any():
            break
        high = np.where(far, high + 2 * (high - low), high)
    for _ in range(120):
        mid = (low + high) / 2
        less = cdf_of(dist, mid, p) < q
        low, high = np.where(less, mid, low), np.where(less, high, mid)
    return high


def _applied(function, dist: str, value: Column, names: list[str], places: int) -> Column:
    """``function`` on Arrow batches: arrays of values and parameters; NULL where a value or parameter is."""

    @F.pandas_udf("double")
    def apply(x: pd.Series, params: pd.DataFrame) -> pd.Series:
        out = function(dist, x.to_numpy(float), {c: params[c].to_numpy(float) for c in params})
        return pd.Series(np.round(np.where(x.isna() | params.isna().any(axis=1), np.nan, out), places))

    return F.nanvl(apply(value.cast("double"), F.struct(*names)), F.lit(None).cast("double"))


def with_cdf(df: DataFrame, model: DataFrame, keys: list[str], value: str, dist: str, out: str = "percentile", places: int = 4) -> DataFrame:
    """Adds the fitted distribution function at ``value``, rounded."""
    names = [c for c in model.columns if c not in keys]
    joined = df.join(model, keys, "left")
    if dist == "empirical":
        found = F.round(empirical_cdf(F.col(value), F.col("ref_values")), places)
    else:
        found = _applied(cdf_of, dist, F.col(value), names, places)
    return joined.withColumn(out, found).drop(*names)


def with_ppf(model: DataFrame, keys: list[str], q: str, dist: str, out: str = "trigger_value", places: int = 4) -> DataFrame:
    """Adds the quantile at level ``q`` of each row's own parameters, rounded."""
    names = [c for c in ("ref_values", "shape", "s", "a", "b", "loc", "scale", "df") if c in model.columns]
    found = F.round(linear_quantile(F.col("ref_values"), F.col(q)), places) if dist == "empirical" else _applied(ppf_of, dist, F.col(q), names, places)
    return model.withColumn(out, found).drop(*names)


def empirical_cdf(value: Column, ref: Column) -> Column:
    """Interpolated position of ``value`` among the sorted ``ref`` values, clamped to 0 and 1; the last of tied values counts."""
    n = F.size(ref)
    j = F.size(F.filter(ref, lambda r: r <= value))
    low, high = F.get(ref, j - 1), F.get(ref, j)
    inner = ((j - 1) + (value - low) / (high - low)) / (n - 1)
    return F.when(value.isNull() | ref.isNull(), None).when((j == 0) | (n == 1), 0.0).when(j == n, 1.0).otherwise(inner)


def cdf_matching(source: DataFrame, base: DataFrame, keys: list[str], date: str, value: str, w: int, least: int = 5) -> DataFrame:
    """Maps ``value`` to the base's quantile at its position in its own pool; pools hold the days within ``w`` of the year, over all years.

    A group's rows of both sides meet in one task, where the window slides over them and each day's rows are placed at once, so no pool leaves its group. NULL
    for a NULL value, and where either pool has under ``least`` values; every row of ``source`` stays.
    """
    doy = F.dayofyear(date).cast("long")
    own, other = source.withColumn("doy", doy), base.select(*(F.col(k).alias(f"_{k}") for k in keys), doy.alias("doy"), F.col(value).cast("double").alias(value))
    schema = with_fields(own, own.columns, "matched double")

    def cell(rows: pa.Table, reference: pa.Table) -> pa.Table:
        numbers = lambda t, c: t.column(c).cast(pa.float64()).to_numpy()
        days, values = numbers(rows, "doy"), numbers(rows, value)
        order = np.argsort(days, kind="stable")
        targets, starts = np.unique(days[order], return_index=True)
        targets, groups = targets[~np.isnan(targets)], np.split(order, starts[1:]) if len(order) else []
        matched = np.full(len(values), np.nan)
        for at, a, b in zip(groups, sliding(days, values, targets, w), sliding(numbers(reference, "doy"), numbers(reference, value), targets, w)):
            if min(len(a), len(b)) >= max(least, 1):
                at = at[~np.isnan(values[at])]
                matched[at] = quantile_of(b, np.searchsorted(a, values[at], side="right") / len(a))
        return rows.append_column("matched", pa.array(matched, from_pandas=True))

    return own.groupBy(*keys).cogroup(other.groupBy(*(f"_{k}" for k in keys))).applyInArrow(cell, schema)
