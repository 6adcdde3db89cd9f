"""Queries of climatologies, anomalies, episodes and the composite perils."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainfold.operators import climatology, episodes
from rainfold.operators.portfolio import trend
from rainfold.plans import perils
from rainfold.plans.catalog import query
from rainfold.sources.scratch import scratch_path
from rainfold.sources.tables import CELLS, HOURLY, OBS, cells, hourly, observations

CLIM = f"{OBS}, fy AS (SELECT year(date) AS y FROM obs GROUP BY 1 HAVING count(DISTINCT date) >= 360), clim AS (SELECT pixel_id, CAST(dayofyear(date) AS BIGINT) AS dayofyear, avg(swc) AS clim, stddev_pop(swc) AS std FROM obs WHERE year(date) IN (SELECT y FROM fy) GROUP BY ALL)"
SMOOTH = f"{CLIM}, p AS (SELECT *, row_number() OVER (PARTITION BY pixel_id ORDER BY dayofyear) AS i, count(*) OVER (PARTITION BY pixel_id) AS n FROM clim), pad AS (SELECT pixel_id, i, i AS q, clim FROM p UNION ALL SELECT pixel_id, i, i - n, clim FROM p WHERE i > n - 7 UNION ALL SELECT pixel_id, i, i + n, clim FROM p WHERE i <= 7), sm AS (SELECT pixel_id, i, q, avg(clim) OVER (PARTITION BY pixel_id ORDER BY q ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS smooth FROM pad), smooth AS (SELECT p.pixel_id, p.dayofyear, sm.smooth FROM sm JOIN p ON sm.pixel_id = p.pixel_id AND sm.i = p.i WHERE sm.q = sm.i)"
ANOM = f"{SMOOTH}, anom AS (SELECT o.pixel_id, o.date, o.swc, o.swc - s.smooth AS a FROM obs o LEFT JOIN smooth s ON o.pixel_id = s.pixel_id AND dayofyear(o.date) = s.dayofyear)"
#: Pool of days within seven of each other around a year of 365 days.
POOL = f"{OBS}, o AS (SELECT pixel_id, CAST(dayofyear(date) AS BIGINT) AS doy, swc FROM obs), t AS (SELECT DISTINCT pixel_id, doy FROM o), wide AS (SELECT DISTINCT pixel_id, doy, ((doy + k - 1 + 365) % 365) + 1 AS lv FROM t, range(-7, 8) r(k)), pool AS (SELECT w.pixel_id, w.doy, o.swc FROM wide w JOIN o ON o.pixel_id = w.pixel_id AND o.doy = w.lv)"
FLAG = f"{HOURLY}, f AS (SELECT *, CASE WHEN v IS NOT NULL THEN CASE WHEN v >= 60 THEN 1 ELSE 0 END END AS flag, CASE WHEN v IS NOT NULL THEN CASE WHEN v >= 60 THEN greatest(v - 60, 0) ELSE 0 END END AS intensity FROM hourly)"
RUNS = f"{FLAG}, isl AS (SELECT *, sum(CASE WHEN flag = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY time ROWS UNBOUNDED PRECEDING) AS g FROM f), runs AS (SELECT user_id, time, flag, intensity, CAST(sum(flag) OVER (PARTITION BY user_id, g ORDER BY time ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run, sum(intensity * flag) OVER (PARTITION BY user_id, g ORDER BY time ROWS UNBOUNDED PRECEDING) AS cum FROM isl)"


def full_year(spark, d) -> DataFrame:
    return climatology.full_year_climatology(observations(spark, d), ["pixel_id"], "date", "swc")


def smoothed(spark, d) -> DataFrame:
    return climatology.smooth_circular(full_year(spark, d), ["pixel_id"], "dayofyear", "clim", 7)


def anomalies(spark, d) -> DataFrame:
    obs = observations(spark, d).withColumn("dayofyear", F.dayofyear("date").cast("long"))
    return obs.join(smoothed(spark, d).select("pixel_id", "dayofyear", "clim"), ["pixel_id", "dayofyear"], "left").withColumn("anomaly", F.col("swc") - F.col("clim"))


def r6(c: str):
    return F.round(c, 6).alias(c)


@query("daily_climatology", f"WITH {OBS} SELECT pixel_id, CAST(dayofyear(date) AS BIGINT) AS day_of_year, round(avg(swc), 6) AS swc_mean FROM obs WHERE year(date) BETWEEN 1995 AND 2000 GROUP BY ALL")
def _(spark, d):
    return climatology.daily_climatology(observations(spark, d), "pixel_id", "date", "swc", (1995, 2000)).select("pixel_id", "day_of_year", r6("swc_mean"))


@query("full_year_climatology", f"WITH {CLIM} SELECT pixel_id, dayofyear, round(clim, 6) AS clim FROM clim")
def _(spark, d):
    return full_year(spark, d).select("pixel_id", "dayofyear", r6("clim"))


@query("climatology_incremental", f"WITH {CLIM} SELECT pixel_id, dayofyear, round(clim, 6) AS clim, round(std, 6) AS std FROM clim")
def _(spark, d):
    """The climatology of full years from kept states, which came in two parts, of which the second brought back all but the last years."""
    path, obs = scratch_path(spark, "states"), observations(spark, d)
    climatology.updated_climatology(obs.where("year(date) < 1996"), path, ["pixel_id"], "date", "swc")
    return climatology.updated_climatology(obs, path, ["pixel_id"], "date", "swc").select("pixel_id", "dayofyear", r6("clim"), r6("std"))


@query("climatology_std", f"WITH {CLIM} SELECT pixel_id, dayofyear, round(std, 6) AS std FROM clim")
def _(spark, d):
    return full_year(spark, d).select("pixel_id", "dayofyear", r6("std"))


@query("smooth_climatology", f"WITH {SMOOTH} SELECT pixel_id, dayofyear, round(smooth, 6) AS clim FROM smooth")
def _(spark, d):
    return smoothed(spark, d).select("pixel_id", "dayofyear", r6("clim"))


@query("anomaly_parts", f"WITH {ANOM} SELECT pixel_id, date, round(a, 6) AS anomaly, round(CASE WHEN a < 0 THEN -a WHEN a IS NOT NULL THEN 0 END, 6) AS negative, round(CASE WHEN a > 0 THEN a WHEN a IS NOT NULL THEN 0 END, 6) AS positive FROM anom")
def _(spark, d):
    neg, pos = climatology.anomaly_parts(F.col("anomaly"))
    return anomalies(spark, d).select("pixel_id", "date", r6("anomaly"), F.round(neg, 6).alias("negative"), F.round(pos, 6).alias("positive"))


@query("lookup_climatology_multi", f"WITH {HOURLY}, c AS (SELECT user_id, CAST(hour(time) AS BIGINT) AS hour, avg(v) AS clim FROM hourly GROUP BY ALL) SELECT h.user_id, h.time, round(h.v - c.clim, 6) AS anomaly FROM hourly h JOIN c ON h.user_id = c.user_id AND hour(h.time) = c.hour")
def _(spark, d):
    own = hourly(spark, d).withColumn("hour", F.hour("time").cast("long"))
    clim = own.groupBy("user_id", "hour").agg(F.avg("v").alias("clim"))
    return climatology.looked_up(own, clim, ["user_id", "hour"]).select("user_id", "time", F.round(F.col("v") - F.col("clim"), 6).alias("anomaly"))


@query("normalize_variable", f"WITH {CLIM} SELECT o.pixel_id, o.date, round(CASE WHEN std > 0 THEN (swc - clim) / std END, 4) AS z FROM obs o LEFT JOIN clim c ON o.pixel_id = c.pixel_id AND dayofyear(o.date) = c.dayofyear")
def _(spark, d):
    obs = observations(spark, d).withColumn("dayofyear", F.dayofyear("date").cast("long")).join(full_year(spark, d), ["pixel_id", "dayofyear"], "left")
    return obs.select("pixel_id", "date", F.round(F.when(F.col("std") > 0, (F.col("swc") - F.col("clim")) / F.col("std")), 4).alias("z"))


@query("margin_threshold", f"WITH {CLIM} SELECT pixel_id, dayofyear, round(clim + 1.5 * std, 6) AS upper, round(clim - 1.5 * std, 6) AS lower FROM clim")
def _(spark, d):
    return full_year(spark, d).select("pixel_id", "dayofyear", F.round(F.col("clim") + 1.5 * F.col("std"), 6).alias("upper"), F.round(F.col("clim") - 1.5 * F.col("std"), 6).alias("lower"))


_DOY = f"{OBS}, o AS (SELECT *, CAST(dayofyear(date) AS BIGINT) AS doy FROM obs)"


@query("circular_window_join", f"WITH {POOL} SELECT pixel_id, doy, count(*) AS n, round(sum(swc), 4) AS total FROM pool GROUP BY ALL")
def _(spark, d):
    obs = observations(spark, d).select("pixel_id", F.dayofyear("date").cast("long").alias("doy"), "swc")
    pool = climatology.circular_pool(obs.select("pixel_id", "doy").distinct(), obs, ["pixel_id"], "doy", 7)
    return pool.groupBy("pixel_id", "doy").agg(F.count("*").alias("n"), F.round(F.sum("swc"), 4).alias("total"))


@query("windowed_quantile_climatology", f"WITH {POOL} SELECT pixel_id, doy, round(quantile_cont(swc, 0.05), 6) AS p05, round(quantile_cont(swc, 0.95), 6) AS p95, count(swc) AS n FROM pool GROUP BY ALL")
def _(spark, d):
    obs = observations(spark, d).select("pixel_id", F.dayofyear("date").cast("long").alias("doy"), "swc")
    return climatology.windowed_climatology(obs, ["pixel_id"], "doy", "swc", 7, [0.05, 0.95]).select("pixel_id", "doy", r6("p05"), r6("p95"), "n")


_LEVELS = {"month": ("month(date)", F.month, 1, 12, 1), "week": ("weekofyear(date)", F.weekofyear, 2, 52, 1), "year": ("year(date)", F.year, 1, None, 1)}
for _level, (_sql, _fn, _width, _cycle, _first) in _LEVELS.items():
    _near = f"b.lv IN (SELECT ((a.lv + k - 1 + {_cycle}) % {_cycle}) + 1 FROM range(-{_width}, {_width + 1}) r(k))" if _cycle else f"abs(a.lv - b.lv) <= {_width}"

    @query(f"windowed_{_level}_climatology", f"WITH {OBS}, o AS (SELECT pixel_id, CAST({_sql} AS BIGINT) AS lv, swc FROM obs), t AS (SELECT DISTINCT pixel_id, lv FROM o), p AS (SELECT t.pixel_id, t.lv, w.lv AS other FROM t, (SELECT DISTINCT lv FROM o) w WHERE {_near.replace('a.lv', 't.lv').replace('b.lv', 'w.lv')}) SELECT p.pixel_id, p.lv AS {_level}, round(avg(swc), 6) AS mean, round(quantile_cont(swc, 0.5), 6) AS median, count(swc) AS n FROM p JOIN o ON o.pixel_id = p.pixel_id AND o.lv = p.other GROUP BY ALL")
    def _(spark, d, level=_level, fn=_fn, width=_width, cycle=_cycle, first=_first):
        own = observations(spark, d).select("pixel_id", fn("date").cast("long").alias(level), "swc")
        return climatology.windowed_climatology(own, ["pixel_id"], level, "swc", width, cycle=cycle, first=first).select("pixel_id", level, r6("mean"), r6("median"), "n")


@query("windowed_hour_climatology", f"WITH {HOURLY}, o AS (SELECT user_id, CAST(hour(time) AS BIGINT) AS hour, v FROM hourly), t AS (SELECT DISTINCT user_id, hour FROM o) SELECT t.user_id, t.hour, round(avg(o.v), 6) AS mean, count(o.v) AS n FROM t JOIN o ON o.user_id = t.user_id AND least(abs(o.hour - t.hour), 24 - abs(o.hour - t.hour)) <= 2 GROUP BY ALL")
def _(spark, d):
    own = hourly(spark, d).select("user_id", F.hour("time").cast("long").alias("hour"), "v")
    return climatology.windowed_climatology(own, ["user_id"], "hour", "v", 2, cycle=24, first=0).select("user_id", "hour", r6("mean"), "n")


@query("intensity_limits", f"WITH {RUNS}, y AS (SELECT user_id, CAST(year(time) AS BIGINT) AS year, sum(intensity) AS total FROM runs GROUP BY ALL) SELECT year, round(quantile_cont(total, 0.01), 6) AS low, round(quantile_cont(total, 0.99), 6) AS high FROM y GROUP BY ALL")
def _(spark, d):
    """Colour limits of a map of yearly intensities: their 1 and 99 %."""
    flags = episodes.flag_intensity(hourly(spark, d), F.col("v"), F.lit(60.0), "upper")
    totals = flags.groupBy("user_id", F.year("time").cast("long").alias("year")).agg(F.sum("intensity").alias("total"))
    return totals.groupBy("year").agg(F.round(F.percentile("total", F.lit(0.01)), 6).alias("low"), F.round(F.percentile("total", F.lit(0.99)), 6).alias("high"))


@query("spatial_rolling_sum", f"WITH {OBS}, g AS (SELECT pixel_id % 5 AS ix, pixel_id // 5 AS iy, date, swc FROM obs) SELECT a.ix, a.iy, a.date, CASE WHEN count(b.swc) >= 6 THEN round(sum(b.swc), 6) END AS rolled, count(b.swc) AS n FROM g a JOIN g b ON a.date = b.date AND abs(a.ix - b.ix) <= 1 AND abs(a.iy - b.iy) <= 1 GROUP BY ALL")
def _(spark, d):
    grid = observations(spark, d).select((F.col("pixel_id") % 5).alias("ix"), F.floor(F.col("pixel_id") / 5).alias("iy"), "date", "swc")
    return episodes.spatial_rolling(grid, "swc", 1, ["date"], F.sum, 6).select("ix", "iy", "date", r6("rolled"), "n")


@query("windowed_mean_climatology", f"WITH {POOL} SELECT pixel_id, doy, round(avg(swc), 9) AS mean, round(stddev_pop(swc), 9) AS std, round(min(swc), 9) AS min, round(max(swc), 9) AS max, round(quantile_cont(swc, 0.5), 9) AS median, count(swc) AS n FROM pool GROUP BY ALL")
def _(spark, d):
    obs = observations(spark, d).select("pixel_id", F.dayofyear("date").cast("long").alias("doy"), "swc")
    return climatology.windowed_climatology(obs, ["pixel_id"], "doy", "swc", 7).select("pixel_id", "doy", *(F.round(c, 9).alias(c) for c in ("mean", "std", "min", "max", "median")), "n")


@query("climatology_monthly", f"WITH {OBS} SELECT pixel_id, CAST(month(date) AS BIGINT) AS month, round(avg(swc), 6) AS clim FROM obs GROUP BY ALL")
def _(spark, d):
    return observations(spark, d).groupBy("pixel_id", F.month("date").cast("long").alias("month")).agg(F.round(F.avg("swc"), 6).alias("clim"))


@query("climatology_seasonal", f"WITH {OBS} SELECT pixel_id, CASE WHEN month(date) IN (12, 1, 2) THEN 'DJF' WHEN month(date) IN (3, 4, 5) THEN 'MAM' WHEN month(date) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season, round(avg(swc), 6) AS clim FROM obs GROUP BY ALL")
def _(spark, d):
    return observations(spark, d).groupBy("pixel_id", climatology.season("date").alias("season")).agg(F.round(F.avg("swc"), 6).alias("clim"))


@query("climatology_annual", f"WITH {OBS} SELECT pixel_id, round(avg(m), 6) AS clim FROM (SELECT pixel_id, year(date) AS y, avg(swc) AS m FROM obs GROUP BY ALL) GROUP BY pixel_id")
def _(spark, d):
    yearly = observations(spark, d).groupBy("pixel_id", F.year("date").alias("y")).agg(F.avg("swc").alias("m"))
    return yearly.groupBy("pixel_id").agg(F.round(F.avg("m"), 6).alias("clim"))


@query("interannual_variability", f"WITH {OBS} SELECT pixel_id, round(stddev_pop(m), 6) AS std FROM (SELECT pixel_id, year(date) AS y, avg(swc) AS m FROM obs GROUP BY ALL) GROUP BY pixel_id")
def _(spark, d):
    yearly = observations(spark, d).groupBy("pixel_id", F.year("date").alias("y")).agg(F.avg("swc").alias("m"))
    return yearly.groupBy("pixel_id").agg(F.round(F.stddev_pop("m"), 6).alias("std"))


@query("pixel_trend", f"WITH {OBS} SELECT pixel_id, CASE WHEN count(*) >= 3 THEN round(regr_slope(m, y) * 10, 6) END AS per_decade FROM (SELECT pixel_id, year(date) AS y, avg(swc) AS m FROM obs GROUP BY ALL) GROUP BY pixel_id")
def _(spark, d):
    yearly = observations(spark, d).groupBy("pixel_id", F.year("date").alias("y")).agg(F.avg("swc").alias("m"))
    return trend(yearly, ["pixel_id"], F.col("m"), F.col("y")).select("pixel_id", F.round(F.col("slope") * 10, 6).alias("per_decade"))


@query("cell_statistics", f"WITH {OBS} SELECT pixel_id, count(swc) AS n, round(avg(swc), 6) AS mean, round(stddev_pop(swc), 6) AS std, round(min(swc), 6) AS min, round(max(swc), 6) AS max FROM obs GROUP BY pixel_id")
def _(spark, d):
    return observations(spark, d).groupBy("pixel_id").agg(F.count("swc").alias("n"), F.round(F.avg("swc"), 6).alias("mean"), F.round(F.stddev_pop("swc"), 6).alias("std"), F.round(F.min("swc"), 6).alias("min"), F.round(F.max("swc"), 6).alias("max"))


_SUMMARY = {"mean": (F.avg, "avg(swc)"), "max": (F.max, "max(swc)"), "min": (F.min, "min(swc)"), "sum": (F.sum, "sum(swc)"), "median": (lambda c: F.percentile(c, F.lit(0.5)), "quantile_cont(swc, 0.5)")}
for _name, (_fn, _sql) in _SUMMARY.items():

    @query(f"summarize_{_name}", f"WITH {OBS} SELECT region, date, round({_sql}, 6) AS value FROM obs GROUP BY ALL")
    def _(spark, d, fn=_fn):
        return observations(spark, d).groupBy("region", "date").agg(F.round(fn("swc"), 6).alias("value"))


@query("rolling_mean", f"WITH {OBS} SELECT pixel_id, date, round(avg(swc) OVER (PARTITION BY pixel_id ORDER BY date ROWS 6 PRECEDING), 6) AS value FROM obs")
def _(spark, d):
    return observations(spark, d).select("pixel_id", "date", F.round(episodes.rolling(None, ["pixel_id"], "date", "swc", 6), 6).alias("value"))


@query("forward_fill", f"WITH {OBS} SELECT pixel_id, date, round(last_value(CASE WHEN day(date) % 3 = 0 THEN NULL ELSE swc END IGNORE NULLS) OVER (PARTITION BY pixel_id ORDER BY date ROWS UNBOUNDED PRECEDING), 6) AS value FROM obs")
def _(spark, d):
    gaps = observations(spark, d).withColumn("v", F.when(F.dayofmonth("date") % 3 != 0, F.col("swc")))
    w = Window.partitionBy("pixel_id").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return gaps.select("pixel_id", "date", F.round(F.last("v", ignorenulls=True).over(w), 6).alias("value"))


def flagged(spark, d) -> DataFrame:
    return episodes.flag_intensity(hourly(spark, d), F.col("v"), F.lit(60.0))


def with_runs(spark, d) -> DataFrame:
    return episodes.runs(flagged(spark, d), ["user_id"], "time")


@query("flag_intensity_upper", f"WITH {FLAG} SELECT user_id, time, flag, round(intensity, 6) AS intensity FROM f")
def _(spark, d):
    return flagged(spark, d).select("user_id", "time", "flag", r6("intensity"))


@query("flag_intensity_lower", f"WITH {HOURLY} SELECT user_id, time, CASE WHEN v <= 40 AND v <= 35 THEN 1 ELSE 0 END AS flag, round(CASE WHEN v <= 40 AND v <= 35 THEN greatest(40 - v, 0) ELSE 0 END, 6) AS intensity FROM hourly")
def _(spark, d):
    return episodes.flag_intensity(hourly(spark, d), F.col("v"), F.lit(40.0), "lower", F.lit(35.0)).select("user_id", "time", "flag", r6("intensity"))


@query("run_length", f"WITH {RUNS} SELECT user_id, time, run FROM runs")
def _(spark, d):
    return with_runs(spark, d).select("user_id", "time", "run")


@query("run_intensity", f"WITH {RUNS} SELECT user_id, time, round(cum, 6) AS run_intensity FROM runs")
def _(spark, d):
    return with_runs(spark, d).select("user_id", "time", r6("run_intensity"))


@query("extreme_events", f"WITH {RUNS} SELECT user_id, time, CASE WHEN run = 3 AND flag = 1 THEN 1 ELSE 0 END AS event FROM runs")
def _(spark, d):
    return episodes.events(with_runs(spark, d), 3).select("user_id", "time", "event")


@query("extreme_episodes", f"WITH {RUNS} SELECT user_id, CAST(max(run) AS BIGINT) AS longest, round(max(cum), 6) AS strongest, count(*) FILTER (run = 3 AND flag = 1) AS events FROM runs GROUP BY user_id")
def _(spark, d):
    marked = episodes.events(with_runs(spark, d), 3)
    return marked.groupBy("user_id").agg(F.max("run").alias("longest"), F.round(F.max("run_intensity"), 6).alias("strongest"), F.sum("event").alias("events"))


@query("intensity_by_window_year", f"WITH {ANOM} SELECT pixel_id, CAST(year(date) AS BIGINT) AS year, round(sum(CASE WHEN a < 0 THEN -a ELSE NULL END), 4) AS intensity FROM anom GROUP BY ALL")
def _(spark, d):
    return anomalies(spark, d).groupBy("pixel_id", F.year("date").cast("long").alias("year")).agg(F.round(F.sum(F.when(F.col("anomaly") < 0, -F.col("anomaly"))), 4).alias("intensity"))


@query("cumulate_over_window", f"WITH {OBS}, w AS (SELECT *, month(date) IN (12, 1, 2) AS inside, CASE WHEN month(date) <= 2 THEN year(date) - 1 ELSE year(date) END AS wy FROM obs) SELECT pixel_id, date, round(CASE WHEN inside THEN sum(swc) OVER (PARTITION BY pixel_id, wy, inside ORDER BY date ROWS UNBOUNDED PRECEDING) ELSE 0 END, 4) AS value FROM w")
def _(spark, d):
    inside = F.month("date").isin(12, 1, 2)
    own = observations(spark, d).withColumns({"inside": inside, "wy": F.when(F.month("date") <= 2, F.year("date") - 1).otherwise(F.year("date"))})
    w = Window.partitionBy("pixel_id", "wy", "inside").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return own.select("pixel_id", "date", F.round(F.when(F.col("inside"), F.sum("swc").over(w)).otherwise(0.0), 4).alias("value"))


@query("spatial_rolling", f"WITH {OBS}, g AS (SELECT pixel_id % 5 AS ix, pixel_id // 5 AS iy, date, swc FROM obs) SELECT a.ix, a.iy, a.date, round(avg(b.swc), 6) AS rolled, count(b.swc) AS n FROM g a JOIN g b ON a.date = b.date AND abs(a.ix - b.ix) <= 1 AND abs(a.iy - b.iy) <= 1 GROUP BY ALL")
def _(spark, d):
    grid = observations(spark, d).select((F.col("pixel_id") % 5).alias("ix"), F.floor(F.col("pixel_id") / 5).alias("iy"), "date", "swc")
    return episodes.spatial_rolling(grid, "swc", 1, ["date"]).select("ix", "iy", "date", r6("rolled"), "n")


@query("incremental_update", f"WITH {OBS}, h AS (SELECT * FROM obs WHERE date < date '2000-01-01'), u AS (SELECT pixel_id, date, swc FROM h UNION ALL SELECT pixel_id, date, swc FROM obs WHERE date > (SELECT max(date) FROM h)) SELECT pixel_id, date, round(m, 6) AS smooth FROM (SELECT pixel_id, date, avg(swc) OVER (PARTITION BY pixel_id ORDER BY date ROWS 6 PRECEDING) AS m FROM u) WHERE date >= date '2000-01-01'")
def _(spark, d):
    obs = observations(spark, d)
    return perils.updated(obs.where("date < '2000-01-01'"), obs, "pixel_id", "date", "swc", 7).select("pixel_id", "date", r6("smooth"))


@query("peril_swc", f"WITH {ANOM} SELECT pixel_id, date, round(a, 6) AS anomaly, round(CASE WHEN a < 0 THEN -a WHEN a IS NOT NULL THEN 0 END, 6) AS negative, round(CASE WHEN a > 0 THEN a WHEN a IS NOT NULL THEN 0 END, 6) AS positive FROM anom")
def _(spark, d):
    return perils.process("swc", observations(spark, d), "pixel_id", "date", "swc", {"smooth": 7}).select("pixel_id", "date", r6("anomaly"), r6("negative"), r6("positive"))


@query("peril_prcp", f"WITH {ANOM} SELECT pixel_id, date, round(a, 6) AS anomaly FROM anom")
def _(spark, d):
    return perils.process("prcp", observations(spark, d), "pixel_id", "date", "swc", {"smooth": 7}).select("pixel_id", "date", r6("anomaly"))


_HOT = f"{POOL}, thr AS (SELECT pixel_id, doy, quantile_cont(swc, {{q}}) AS t FROM pool GROUP BY ALL), f AS (SELECT b.pixel_id, b.date, CASE WHEN b.swc >= t THEN 1 ELSE 0 END AS flag, CASE WHEN b.swc >= t THEN greatest(b.swc - t, 0) ELSE 0 END AS intensity FROM obs b LEFT JOIN thr ON thr.pixel_id = b.pixel_id AND thr.doy = dayofyear(b.date)), isl AS (SELECT *, sum(CASE WHEN flag = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY pixel_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS g FROM f) SELECT pixel_id, date, flag, round(intensity, 6) AS intensity, CAST(sum(flag) OVER (PARTITION BY pixel_id, g ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM isl"


@query("peril_temperature", "WITH " + _HOT.format(q=0.95))
def _(spark, d):
    return perils.process("tmax", observations(spark, d), "pixel_id", "date", "swc", {"window": 7, "quantile": 0.95}).select("pixel_id", "date", "flag", r6("intensity"), "run")


@query("peril_windgust", "WITH " + _HOT.format(q=0.9))
def _(spark, d):
    return perils.process("windgust", observations(spark, d), "pixel_id", "date", "swc", {"window": 7, "quantile": 0.9}).select("pixel_id", "date", "flag", r6("intensity"), "run")


_HOURS = f"{HOURLY}, o AS (SELECT user_id, time, CAST(hour(time) AS BIGINT) AS hour, CAST(dayofyear(time) AS BIGINT) AS doy, v FROM hourly), t AS (SELECT DISTINCT user_id, hour, doy FROM o), thr AS (SELECT t.user_id, t.hour, t.doy, quantile_cont(b.v, 0.05) AS p FROM t JOIN o b ON b.user_id = t.user_id AND b.hour = t.hour AND abs(b.doy - t.doy) <= 3 GROUP BY ALL), f AS (SELECT o.user_id, time, CASE WHEN v <= p THEN 1 ELSE 0 END AS flag, CASE WHEN v <= p THEN greatest(p - v, 0) ELSE 0 END AS intensity FROM o JOIN thr USING (user_id, hour, doy)), isl AS (SELECT *, sum(CASE WHEN flag = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY time ROWS UNBOUNDED PRECEDING) AS g FROM f)"


@query("peril_temperature_hourly", f"WITH {_HOURS} SELECT user_id, time, flag, round(intensity, 6) AS intensity, CAST(sum(flag) OVER (PARTITION BY user_id, g ORDER BY time ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM isl")
def _(spark, d):
    raw = hourly(spark, d).select("user_id", F.lit(0.0).alias("longitude"), F.lit(0.0).alias("latitude"), "time", (F.col("v") + 273.15).alias("2t"))
    own = perils.prepared(raw, "tmin", ["user_id"], "time", {"offset": 273.15})
    return perils.process("tmin", own, "user_id", "time", "tmin", {"window": 3, "quantile": 0.05, "tail": "lower", "hourly": True}).select("user_id", "time", "flag", r6("intensity"), "run")


_GUSTS = f"{OBS}, {CELLS}, raw AS (SELECT pixel_id, date, lon, lat, CASE WHEN h = 1 AND day(date) % 10 = 0 THEN NULL ELSE swc * (1 - 0.1 * h) END AS v FROM obs JOIN cells USING (pixel_id), range(2) t(h) WHERE lon BETWEEN 0 AND 3 AND lat BETWEEN 1 AND 4), daily AS (SELECT pixel_id, date, max(v) * 3.6 AS v FROM raw WHERE date BETWEEN date '1995-03-01' AND date '2001-06-30' GROUP BY ALL), fy AS (SELECT year(date) AS y FROM daily GROUP BY 1 HAVING count(DISTINCT date) >= 300), clim AS (SELECT pixel_id, dayofyear(date) AS doy, avg(v) + stddev_pop(v) AS t FROM daily WHERE year(date) IN (SELECT y FROM fy) GROUP BY ALL)"


@query("peril_wind_raw", f"WITH {_GUSTS} SELECT daily.pixel_id, date, round(v, 6) AS windspeed, CASE WHEN coalesce(round(v, 6) >= round(t, 6), false) THEN 1 ELSE 0 END AS flag, round(CASE WHEN coalesce(round(v, 6) >= round(t, 6), false) THEN greatest(round(v, 6) - round(t, 6), 0) ELSE 0 END, 4) AS intensity FROM daily LEFT JOIN clim ON clim.pixel_id = daily.pixel_id AND doy = dayofyear(date)")
def _(spark, d):
    """Components at two hours a day, a sentinel among them, to the daily maximum in km/h within a box and a period."""
    obs = observations(spark, d).join(cells(spark, d), "pixel_id").select("pixel_id", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), "date", "swc", F.explode(F.array(F.lit(0), F.lit(1))).alias("h"))
    size, none = F.col("swc") * (1 - 0.1 * F.col("h")), (F.col("h") == 1) & (F.day("date") % 10 == 0)
    raw = obs.select("pixel_id", "longitude", "latitude", (F.col("date").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 6 + 12 * h)")).alias("time"), F.when(none, -9999.0).otherwise(size * 0.6).alias("u10m"), F.when(none, 0.0).otherwise(size * 0.8).alias("v10"))
    own = perils.prepared(raw, "windspeed", ["pixel_id"], "time", {"box": (0, 1, 3, 4), "missing": 9999.0, "period": ("1995-03-01", "2001-06-30"), "daily_max": True, "factor": 3.6})
    own = own.withColumn("windspeed", F.round("windspeed", 6))
    return perils.process("windspeed", own, "pixel_id", "time", "windspeed", {"margin": 1.0, "least": 300}).select("pixel_id", F.col("time").alias("date"), "windspeed", "flag", F.round("intensity", 4).alias("intensity"))


@query("peril_request_raw", f"WITH {OBS}, {CELLS}, g AS (SELECT date, lon, lat, CASE WHEN pixel_id % 7 = 3 AND day(date) = 5 THEN NULL ELSE swc END AS v FROM obs JOIN cells USING (pixel_id)), t AS (SELECT 0.5 * i AS x, 0.5 * j AS y, floor(0.5 * i) AS x0, ceil(0.5 * i) AS x1, floor(0.5 * j) AS y0, ceil(0.5 * j) AS y1 FROM range(9) a(i), range(9) b(j)), c AS (SELECT x, y, x0 + p AS lon, y0 + q AS lat, (CASE WHEN x0 = x1 THEN 1 ELSE 0.5 END) * (CASE WHEN y0 = y1 THEN 1 ELSE 0.5 END) AS w, (1 + (x1 - x0)) * (1 + (y1 - y0)) AS n FROM t, range(2) a(p), range(2) b(q) WHERE x0 + p <= x1 AND y0 + q <= y1) SELECT date, CAST(x AS DOUBLE) AS lon, CAST(y AS DOUBLE) AS lat, CASE WHEN count(v) = max(n) THEN round(sum(w * v), 6) END AS prcp FROM c JOIN g USING (lon, lat) GROUP BY ALL")
def _(spark, d):
    """A raw grid with a sentinel on a grid of half the step, at every time."""
    sentinel = F.when((F.col("pixel_id") % 7 == 3) & (F.day("date") == 5), 65535.0).otherwise(F.col("swc"))
    raw = observations(spark, d).join(cells(spark, d), "pixel_id").select("date", F.col("lon").alias("x"), F.col("lat").alias("y"), sentinel.alias("tp"))
    return perils.prepared(raw, "prcp", [], "date", {"missing": 65535.0, "res": 0.5}).select("date", "lon", "lat", r6("prcp"))


@query("peril_wind", f"WITH {CLIM}, f AS (SELECT o.pixel_id, o.date, o.swc, round(clim + 1.0 * std, 6) AS t FROM obs o LEFT JOIN clim c ON o.pixel_id = c.pixel_id AND dayofyear(o.date) = c.dayofyear) SELECT pixel_id, date, CASE WHEN coalesce(swc >= t, false) THEN 1 ELSE 0 END AS flag, round(CASE WHEN coalesce(swc >= t, false) THEN greatest(swc - t, 0) ELSE 0 END, 6) AS intensity FROM f")
def _(spark, d):
    return perils.process("wind", observations(spark, d), "pixel_id", "date", "swc", {"margin": 1.0}).select("pixel_id", "date", "flag", r6("intensity"))


#: Areas around cells: four by four boxes with cells, and one too small for any.
_AREAS = {"a": (-0.5, -0.5, 2.5, 1.5), "b": (1.5, 1.5, 4.5, 4.5), "small": (0.55, 0.6, 0.8, 0.7)}


@query("summarize_within", f"WITH {OBS}, {CELLS}, areas AS (SELECT * FROM (VALUES {', '.join(f"('{k}', {', '.join(f'{x}::DOUBLE' for x in v)})" for k, v in _AREAS.items())}) t(location_id, x0, y0, x1, y1)), valid AS (SELECT * FROM cells WHERE pixel_id IN (SELECT pixel_id FROM obs WHERE swc IS NOT NULL)), ins AS (SELECT location_id, pixel_id FROM areas JOIN valid ON lon > x0 AND lon < x1 AND lat > y0 AND lat < y1), near AS (SELECT location_id, pixel_id FROM (SELECT location_id, pixel_id, row_number() OVER (PARTITION BY location_id ORDER BY sqrt((lon - (x0 + x1) / 2) ** 2 + (lat - (y0 + y1) / 2) ** 2), lon, lat) AS n FROM areas, valid WHERE location_id NOT IN (SELECT location_id FROM ins)) WHERE n <= 2) SELECT location_id, date, round(avg(swc), 6) AS value FROM (SELECT * FROM ins UNION ALL SELECT * FROM near) JOIN obs USING (pixel_id) GROUP BY ALL")
def _(spark, d):
    rows = [(k, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]) for k, (x0, y0, x1, y1) in _AREAS.items()]
    polygons = spark.createDataFrame(rows, "polygon_id string, ring array<struct<x:double,y:double>>")
    return perils.summarized_within(observations(spark, d), cells(spark, d), polygons, "date", "swc", 2).select("location_id", "date", F.round("swc", 6).alias("value"))


@query("summarize_nearest", f"WITH {OBS}, {CELLS}, p AS (SELECT * FROM (VALUES ('p', 2.2::DOUBLE, 0.9::DOUBLE), ('q', -3.0::DOUBLE, 7.5::DOUBLE)) t(location_id, x, y)), near AS (SELECT location_id, pixel_id FROM (SELECT location_id, pixel_id, row_number() OVER (PARTITION BY location_id ORDER BY sqrt((lon - x) ** 2 + (lat - y) ** 2), lon, lat) AS n FROM p, cells WHERE pixel_id IN (SELECT pixel_id FROM obs)) WHERE n <= 3) SELECT location_id, date, round(avg(swc), 6) AS value FROM near JOIN obs USING (pixel_id) GROUP BY ALL")
def _(spark, d):
    points = spark.createDataFrame([("p", 2.2, 0.9), ("q", -3.0, 7.5)], "location_id string, lon double, lat double")
    return perils.summarized_nearest(observations(spark, d), cells(spark, d), points, "date", "swc", 3).select("location_id", "date", F.round("swc", 6).alias("value"))


@query("summarize_pixel", f"WITH {OBS} SELECT format('{{:.3f}}', CAST(pixel_id % 5 AS DOUBLE)) || '_' || format('{{:.3f}}', CAST(pixel_id // 5 AS DOUBLE)) AS name, date, round(swc, 6) AS value FROM obs")
def _(spark, d):
    joined = observations(spark, d).join(cells(spark, d), "pixel_id")
    return joined.select(F.concat_ws("_", F.format_string("%.3f", "lon"), F.format_string("%.3f", "lat")).alias("name"), "date", F.round("swc", 6).alias("value"))
