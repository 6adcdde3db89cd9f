"""Climatologies, anomalies and circular windows over the year."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rainfold.sources.scratch import exists


def daily_climatology(obs: DataFrame, key: str, date: str, value: str, years: tuple[int, int]) -> DataFrame:
    base = obs.where(F.year(date).between(*years))
    return base.groupBy(key, F.dayofyear(date).cast("long").alias("day_of_year")).agg(F.avg(value).alias(f"{value}_mean"))


def full_years(obs: DataFrame, date: str, least: int = 360) -> DataFrame:
    """``(year)``: years in which the shared time axis has ``least`` days."""
    return obs.groupBy(F.year(date).alias("year")).agg(F.count_distinct(date).alias("n")).where(F.col("n") >= least).select("year")


def full_year_climatology(obs: DataFrame, keys: list[str], date: str, value: str, least: int = 360) -> DataFrame:
    base = obs.withColumn("year", F.year(date)).join(full_years(obs, date, least), "year", "left_semi")
    return base.groupBy(*keys, F.dayofyear(date).cast("long").alias("dayofyear")).agg(F.avg(value).alias("clim"), F.stddev_pop(value).alias("std"))


def yearly_states(obs: DataFrame, keys: list[str], date: str, value: str) -> DataFrame:
    """``(keys, dayofyear, year, n, mean, m2)``: count, mean and squared deviations of each year's values, which can be merged."""
    x = F.col(value)
    return obs.groupBy(*keys, F.dayofyear(date).cast("long").alias("dayofyear"), F.year(date).alias("year")).agg(F.count(x).alias("n"), F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)).alias("m2"))


def merged_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, clim, std)`` of states of years, which are few: means weighted by counts, and the deviations of the values from the whole mean. NULL without values."""
    parts = states.where("n > 0").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("mean", "n", "m2"))).alias("_s"), F.sum("n").alias("_n"))
    total = lambda f: F.aggregate("_s", F.lit(0.0), lambda a, s: a + f(s))
    parts = parts.withColumn("clim", total(lambda s: s["n"] * s["mean"]) / F.col("_n"))
    spread = total(lambda s: s["m2"] + s["n"] * (s["mean"] - F.col("clim")) * (s["mean"] - F.col("clim")))
    own = parts.select(*keys, "clim", F.sqrt(spread / F.col("_n")).alias("std"))
    return states.select(*keys).distinct().join(own, keys, "left")


def updated_climatology(obs: DataFrame, path: str, keys: list[str], date: str, value: str, least: int = 360) -> DataFrame:
    """The climatology of full years (see ``full_year_climatology``) from states kept at ``path``, one part a year, after those of ``obs`` have come in.

    A year that is kept with ``least`` days on the shared time axis is complete and left out of ``obs`` by a filter; any other year of ``obs`` replaces its part. So a new year
    is read once, and the history only as its states, a row a cell and day of each year.
    """
    spark = obs.sparkSession
    if exists(spark, path):
        kept = spark.read.parquet(path)
        done = [r["year"] for r in kept.groupBy("year").agg(F.max("days").alias("days")).where(F.col("days") >= least).collect()]
        obs = obs.where(~F.year(date).isin(done)) if done else obs
    days = obs.groupBy(F.year(date).alias("year")).agg(F.count_distinct(date).alias("days"))
    fresh = yearly_states(obs, keys, date, value).join(days, "year")
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)
    return merged_states(spark.read.parquet(path).where(F.col("days") >= least), [*keys, "dayofyear"])


def smooth_circular(clim: DataFrame, keys: list[str], level: str, value: str, w: int) -> DataFrame:
    """Centred mean of 2w + 1 positions, the first and last w of which wrap around; positions are the levels that exist."""
    if w <= 0:
        return clim
    order = Window.partitionBy(*keys).orderBy(level)
    placed = clim.withColumn("_i", F.row_number().over(order)).withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    shifts = F.array(F.when(F.col("_i") > F.col("_n") - w, F.col("_i") - F.col("_n")), F.col("_i"), F.when(F.col("_i") <= w, F.col("_i") + F.col("_n")))
    padded = placed.withColumn("_p", F.explode(F.array_compact(shifts)))
    mean = F.avg(value).over(Window.partitionBy(*keys).orderBy("_p").rowsBetween(-w, w))
    return padded.withColumn(value, mean).where("_p = _i").drop("_i", "_n", "_p")


def wrapped(level: Column, cycle: int | None = 365, first: int = 1) -> Column:
    """A level beyond a cycle's end or start, back in it; levels without a cycle (years) stay."""
    return level if cycle is None else F.pmod(level - first, F.lit(cycle)) + first


def circular_pool(targets: DataFrame, obs: DataFrame, keys: list[str], level: str, w: int, cycle: int | None = 365, first: int = 1) -> DataFrame:
    """Observations within ``w`` of each target level, wrapping around. Targets are exploded, not observations; a pair counts once."""
    near = F.array_distinct(F.transform(F.sequence(F.lit(-w), F.lit(w)), lambda k: wrapped(F.col(level) + k, cycle, first)))
    wide = targets.select(*keys, level, F.explode(near).alias("_level"))
    return wide.join(obs.withColumnRenamed(level, "_level"), [*keys, "_level"]).drop("_level")


def sliding(levels: np.ndarray, values: np.ndarray, targets: np.ndarray, w: int, cycle: int | None = 365, first: int = 1) -> Iterator[np.ndarray]:
    """For each target level the values within ``w`` of it, wrapping around, in order. Each level's values are sorted once; a window merges what is sorted already."""
    known = ~np.isnan(values)
    levels, values = levels[known], values[known]
    order = np.lexsort((values, levels))
    own, starts = np.unique(levels[order], return_index=True)
    runs = dict(zip(own.tolist(), np.split(values[order], starts[1:])))
    none = np.empty(0)
    for x in targets.tolist():
        near = dict.fromkeys(x + k if cycle is None else (x + k - first) % cycle + first for k in range(-w, w + 1))
        yield np.sort(np.concatenate([none, *(runs[y] for y in near if y in runs)]), kind="stable")


def quantile_of(pool: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Quantiles of a sorted array, interpolated linearly; NaN of an empty one."""
    if not len(pool):
        return np.full(np.shape(q), np.nan)
    h = (len(pool) - 1) * np.asarray(q)
    i = np.floor(h).astype(np.int64)
    a = pool[i]
    return a + (h - i) * (pool[np.minimum(i + 1, len(pool) - 1)] - a)


def with_fields(df: DataFrame, columns: list[str], *added: str) -> StructType:
    """The schema of some columns of ``df`` and further ``"name type"``."""
    return StructType([df.schema[c] for c in columns] + StructType.fromDDL(", ".join(added)).fields)


def linear_quantile(ref: Column, q: Column) -> Column:
    """Quantile of a sorted array, for a level that differs by row."""
    h = (F.size(ref) - 1) * q
    i = F.floor(h).cast("int")
    a = F.get(ref, i)
    return F.when(i + 1 < F.size(ref), a + (h - i) * (F.get(ref, i + 1) - a)).otherwise(a)


def windowed_climatology(obs: DataFrame, keys: list[str], level: str, value: str, w: int, quantiles: list[float] = (), cycle: int | None = 365, first: int = 1) -> DataFrame:
    """Statistics of each level's pool: ``quantiles``, or mean, deviation, extremes and median. ``cycle`` and ``first``: 365 days from 1, 52 weeks
    or 12 months from 1, 24 hours from 0; None for years. A cell's values (a cycle times the years) are one group, in which the window slides; nothing else is shuffled."""
    names = [f"p{round(100 * q):02d}" for q in quantiles] or ["mean", "std", "min", "max", "median"]
    own = obs.where(F.col(level).isNotNull()).select(*keys, level, F.col(value).cast("double").alias("_v"))
    schema = with_fields(own, [*keys, level], *(f"{c} double" for c in names), "n long")

    def cell(table: pa.Table) -> pa.Table:
        levels = table.column(level).to_numpy()
        targets, at = np.unique(levels, return_index=True)
        stats = np.full((len(targets), len(names)), np.nan)
        counts = []
        for row, pool in zip(stats, sliding(levels, table.column("_v").to_numpy(), targets, w, cycle, first)):
            counts.append(len(pool))
            if len(pool):
                row[:] = quantile_of(pool, np.array(quantiles)) if quantiles else (pool.mean(), pool.std(), pool[0], pool[-1], quantile_of(pool, 0.5))
        out = table.take(pa.array(at)).drop_columns("_v")
        for c, column in zip(names, stats.T):
            out = out.append_column(c, pa.array(column, from_pandas=True))
        return out.append_column("n", pa.array(counts, pa.int64()))

    return own.groupBy(*keys).applyInArrow(cell, schema)


def looked_up(obs: DataFrame, clim: DataFrame, levels: list[str]) -> DataFrame:
    """``obs`` with the climatology of its ``levels``. Raises if one of its levels has none."""
    missing = obs.select(*levels).distinct().join(clim, levels, "left_anti").limit(3).collect()
    if missing:
        raise KeyError(f"no climatology for {', '.join(str(r.asDict()) for r in missing)}")
    return obs.join(clim, levels)


def season(date: Column | str) -> Column:
    m = F.month(date)
    return F.when(m.isin(12, 1, 2), "DJF").when(m.isin(3, 4, 5), "MAM").when(m.isin(6, 7, 8), "JJA").otherwise("SON")


def anomaly_parts(anomaly: Column) -> tuple[Column, Column]:
    """Size of the negative part and of the positive part."""
    return F.when(anomaly < 0, -anomaly).otherwise(F.when(anomaly.isNotNull(), 0.0)), F.when(anomaly > 0, anomaly).otherwise(F.when(anomaly.isNotNull(), 0.0))
