"""Composite peril plans: from cleaned observations to anomalies or episodes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainfold.functions import scalars
from rainfold.operators import climatology, distributions, episodes, spatial
from rainfold.sources.scratch import written


#: Names of the components of wind. Fixed values.
COMPONENTS = {"u10": ["u10", "u10m"], "v10": ["v10", "v10m"]}


def prepared(raw: DataFrame, variable: str, keys: list[str], time: str, params: dict) -> DataFrame:
    """A peril's own columns from a raw table of any of its names, cleaned: ``(keys, lon, lat, time, variable)``.

    In this order, each step only if ``params`` asks for it: the speed of wind from its components, the variable's and coordinates' registered names, ``box`` (west, south, east,
    north, both ends included), ``res`` (regridding; the keys then are those of the new cells), ``missing`` (the value that stands for none), ``period`` (first and last day),
    ``daily_max`` with ``factor``, and ``offset``, which is subtracted; twelve decimals are left, so that a value comes back as it was before the offset was added.
    """
    df = raw
    have = {c: next((n for n in names if n in df.columns), None) for c, names in COMPONENTS.items()}
    if variable in ("windspeed", "windgust", "wind") and all(have.values()):
        df = df.withColumn(scalars.ALIASES[variable][0], F.hypot(*have.values())).drop(*have.values())
    df = scalars.canonical(df, variable).select(*(k for k in keys if k in df.columns), "lon", "lat", time, variable)
    if box := params.get("box"):
        df = df.where(F.col("lon").between(box[0], box[2]) & F.col("lat").between(box[1], box[3]))
    if "missing" in params:
        df = df.withColumn(variable, F.nullif(variable, F.lit(params["missing"])))
    if res := params.get("res"):
        df = spatial.regridded(df, [time], variable, res, params.get("linear", True))
    first, last = params.get("period", (None, None))
    df = scalars.time_slice(df, time, first, last)
    if params.get("daily_max"):
        df = df.groupBy(*(c for c in df.columns if c not in (time, variable)), F.to_date(time).alias(time)).agg((F.max(variable) * params.get("factor", 1.0)).alias(variable))
    return df.withColumn(variable, F.round(F.col(variable) - params["offset"], 12)) if "offset" in params else df


def _anomalies(obs: DataFrame, key: str, date: str, value: str, p: dict) -> DataFrame:
    """Anomaly from the smoothed climatology of full years, with its negative and positive part."""
    clim = climatology.full_year_climatology(obs, [key], date, value, p.get("least", 360))
    clim = climatology.smooth_circular(clim, [key], "dayofyear", "clim", p.get("smooth", 0)).select(key, "dayofyear", "clim")
    out = obs.withColumn("dayofyear", F.dayofyear(date).cast("long")).join(clim, [key, "dayofyear"], "left").withColumn("anomaly", F.col(value) - F.col("clim"))
    negative, positive = climatology.anomaly_parts(F.col("anomaly"))
    return out.withColumns({"negative": negative, "positive": positive})


def _extremes(obs: DataFrame, key: str, date: str, value: str, p: dict) -> DataFrame:
    """Flags, intensities and runs beyond a quantile of the days around each day of the year; ``hourly``: of those days' same hour.
    ``hard``: a limit that the threshold doesn't fall short of."""
    keys = [key, "hour"] if p.get("hourly") else [key]
    own = obs.withColumns({"dayofyear": F.dayofyear(date).cast("long")} | ({"hour": F.hour(date).cast("long")} if p.get("hourly") else {}))
    name = f"p{round(100 * p['quantile']):02d}"
    limits = climatology.windowed_climatology(own.select(*keys, "dayofyear", value), keys, "dayofyear", value, p["window"], [p["quantile"]]).select(*keys, "dayofyear", F.col(name).alias("threshold"))
    flags = episodes.flag_intensity(own.join(limits, [*keys, "dayofyear"], "left"), F.col(value), F.col("threshold"), p.get("tail", "upper"))
    return episodes.runs(flags, [key], date)


def _margins(obs: DataFrame, key: str, date: str, value: str, p: dict) -> DataFrame:
    """Flags and intensities beyond the climatology plus a multiple of its deviation, rounded so that an equal value counts alike on any plan."""
    clim = climatology.full_year_climatology(obs, [key], date, value, p.get("least", 360))
    own = obs.withColumn("dayofyear", F.dayofyear(date).cast("long")).join(clim, [key, "dayofyear"], "left")
    return episodes.flag_intensity(own, F.col(value), F.round(F.col("clim") + p["margin"] * F.col("std"), 6), p.get("tail", "upper"))


PERILS: dict[str, Callable] = {"swc": _anomalies, "prcp": _anomalies, "tmin": _extremes, "tmax": _extremes, "windgust": _extremes, "wind": _margins, "windspeed": _margins}


def process(peril: str, obs: DataFrame, key: str, date: str, value: str, params: dict) -> DataFrame:
    """The plan registered for a peril."""
    if peril not in PERILS:
        raise KeyError(f"no peril {peril!r}; there are {', '.join(sorted(PERILS))}")
    return PERILS[peril](obs, key, date, value, params)


def blended(base: DataFrame, other: DataFrame, cut: str, key: str, date: str, value: str, params: dict) -> DataFrame:
    """``other`` mapped onto the distribution of ``base`` before ``cut``, ``base`` from then on; then its anomalies."""
    matched = distributions.cdf_matching(other.select(key, date, value), base.select(key, date, value), [key], date, value, params["match"])
    earlier = matched.where(F.col(date) < F.lit(cut).cast("date")).select(key, date, F.col("matched").alias(value))
    return _anomalies(earlier.unionByName(base.where(F.col(date) >= F.lit(cut).cast("date")).select(key, date, value)), key, date, value, params)


def located(obs: DataFrame, polygons: DataFrame, time: str, value: str) -> DataFrame:
    """``(location_id, time, value)``: the mean over the cells of ``obs(lon, lat, time, value)`` strictly inside each of ``polygons(polygon_id, ring)``. Only the cells' places meet
    the polygons. Means are rounded to nine places, so that ties are ties on any plan."""
    places = spatial.within(obs.select("lon", "lat").distinct(), polygons.select("polygon_id", "ring")).select("lon", "lat", F.col("polygon_id").alias("location_id"))
    return obs.join(places, ["lon", "lat"]).groupBy("location_id", time).agg(F.round(F.avg(value), 9).alias(value))


def harmonized(recent: DataFrame, gap: DataFrame, polygons: DataFrame, variable: str, time: str, params: dict) -> DataFrame:
    """One series of a location from two raw sources: ``recent`` from when it begins, and before that ``gap``, finer gridded and brought onto its distribution; then anomalies.

    Both come from raw names to daily means of each polygon. The recent source is smoothed over ``fill`` rows, the gap matched to it within ``match`` days of the year, its ``early`` and ``late``
    periods are put in front of the recent one, and the whole is smoothed over ``time_smooth`` rows. ``params`` also has what ``prepared`` and the anomalies take: ``recent`` and ``gap`` for each source,
    ``smooth`` and ``least``. Returns the columns of the anomalies, with ``original``, the value before the last smoothing.
    """
    of = lambda raw, own: located(prepared(raw, variable, [], time, own), polygons, time, variable)
    smooth = lambda df, column, n: episodes.rolling(df, ["location_id"], time, column, n - 1)
    base = of(recent, params["recent"])
    base = base.select("location_id", time, smooth(base, variable, params["fill"]).alias(variable))
    base = written(base, "recent")
    matched = distributions.cdf_matching(of(gap, params["gap"]), base, ["location_id"], time, variable, params["match"])
    matched = written(matched.select("location_id", time, F.col("matched").alias(variable)), "matched")
    parts = [scalars.time_slice(matched, time, *params[period]) for period in ("early", "late")]
    whole = parts[0].unionByName(parts[1]).unionByName(base).withColumnRenamed(variable, "original")
    # What follows reads the series several times.
    whole = written(whole.withColumn(variable, smooth(whole, "original", params["time_smooth"])), "harmonized")
    return _anomalies(whole, "location_id", time, variable, params)


def updated(history: DataFrame, new: DataFrame, key: str, date: str, value: str, n: int) -> DataFrame:
    """Rows after the history's last day, with the trailing mean of ``n`` rows; of the history only what the mean needs is read."""
    last = history.agg(F.max(date)).first()[0]
    fresh = new if last is None else new.where(F.col(date) > F.lit(last))
    order = Window.partitionBy(key).orderBy(F.desc(date))
    context = history.withColumn("_n", F.row_number().over(order)).where(F.col("_n") < n).select(key, date, value, F.lit(False).alias("_new"))
    both = context.unionByName(fresh.select(key, date, value, F.lit(True).alias("_new")))
    return both.withColumn("smooth", episodes.rolling(both, [key], date, value, n - 1)).where("_new").drop("_new")


def summarized_nearest(obs: DataFrame, cells: DataFrame, points: DataFrame, date: str, value: str, k: int = 1) -> DataFrame:
    """Mean over the ``k`` nearest cells that have any value, for each of ``points(location_id, lon, lat)``."""
    valid = cells.join(obs.where(F.col(value).isNotNull()).select("pixel_id").distinct(), "pixel_id", "left_semi")
    near = spatial.nearest(points, valid, "location_id", k).select("location_id", "pixel_id")
    return obs.select("pixel_id", date, value).join(near, "pixel_id").groupBy("location_id", date).agg(F.avg(value).alias(value))


def summarized_within(obs: DataFrame, cells: DataFrame, polygons: DataFrame, date: str, value: str, k: int = 1) -> DataFrame:
    """Mean over the cells strictly inside each of ``polygons(polygon_id, ring)``; a polygon without a cell that has a value takes the ``k`` nearest to its corners' mean."""
    inside = spatial.within(cells, polygons).select("pixel_id", F.col("polygon_id").alias("location_id"))
    met = obs.select("pixel_id", date, value).join(inside, "pixel_id").groupBy("location_id", date).agg(F.avg(value).alias(value))
    have = met.where(F.col(value).isNotNull()).select("location_id").distinct()
    met = met.join(have, "location_id", "left_semi")
    centre = lambda c: (F.aggregate("ring", F.lit(0.0), lambda a, p: a + p[c]) / F.size("ring")).alias({"x": "lon", "y": "lat"}[c])
    rest = polygons.withColumnRenamed("polygon_id", "location_id").join(have, "location_id", "left_anti").select("location_id", centre("x"), centre("y"))
    return met.unionByName(summarized_nearest(obs, cells, rest, date, value, k))
