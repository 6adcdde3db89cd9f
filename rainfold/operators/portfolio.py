"""Annual losses, exceedance curves, quotes and the statistics of a portfolio."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainfold.operators.distributions import beta_i


def annual_losses(losses: DataFrame, crop: str = "crop", year: str = "year", loss: str = "loss_usd") -> DataFrame:
    """By crop and year, and over all crops as 'Combined', in one aggregation."""
    sets = losses.groupingSets([[F.col(crop), F.col(year)], [F.col(year)]], crop, year).agg(F.sum(loss).alias(loss), F.grouping(crop).alias("_all"))
    return sets.select(F.when(F.col("_all") == 1, "Combined").otherwise(F.col(crop)).alias("crop"), F.col(year).alias("year"), loss)


def quote(annual: DataFrame, loading: float, margin: float | None = None, loss_ratio: float | None = None) -> DataFrame:
    """Mean and deviation of the years, technical and commercial premium; 'Combined' first."""
    out = annual.groupBy("crop").agg(F.avg("loss_usd").alias("AAL_usd"), F.coalesce(F.stddev_samp("loss_usd"), F.lit(0.0)).alias("StdDev_usd"))
    out = out.withColumn("technical_premium_usd", F.col("AAL_usd") + loading * F.col("StdDev_usd"))
    commercial = F.col("technical_premium_usd") / (1 - margin if margin is not None else loss_ratio)
    return out.withColumn("commercial_premium_usd", commercial).orderBy((F.col("crop") == "Combined").desc(), "crop")


def exceedance(annual: DataFrame, plotting: bool = False) -> DataFrame:
    """Rank, probability and return period of the losses, largest first; ``plotting``: rank / (n + 1)."""
    own = Window.partitionBy("crop")
    ranked = annual.withColumn("rank", F.row_number().over(own.orderBy(F.desc("loss_usd"), "year")).cast("long")).withColumn("_n", F.count("*").over(own))
    p = F.col("rank") / (F.col("_n") + 1 if plotting else F.col("_n"))
    return ranked.withColumn("exceedance_probability", p).withColumn("return_period_years", 1 / p).drop("_n")


def bootstrap(annual: DataFrame, draws: int, index) -> DataFrame:
    """Exceedance of ``draws`` draws with replacement for each crop; ``index(draw, crop's number of years)`` picks a year, from 0."""
    own = Window.partitionBy("crop").orderBy("year")
    placed = annual.withColumn("_i", F.row_number().over(own) - 1)
    sizes = annual.groupBy("crop").agg(F.count("*").alias("_n"))
    drawn = sizes.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1)))).withColumn("_i", index(F.col("draw").cast("long"), F.col("_n")).cast("int"))
    values = drawn.join(placed, ["crop", "_i"]).select("crop", "draw", "loss_usd")
    rank = F.row_number().over(Window.partitionBy("crop").orderBy(F.desc("loss_usd"), "draw")).cast("long")
    return values.withColumn("rank", rank).select("crop", "rank", (F.lit(float(draws)) / F.col("rank")).alias("return_period_years"), (F.col("rank") / draws).alias("exceedance_probability"), "loss_usd")


def thinned(curve: DataFrame, low: float = 0.001, high: float = 0.30, points: int = 80) -> DataFrame:
    """The part of each crop's curve between two probabilities, every n-th point of it by rank, so that some ``points`` are left."""
    own = Window.partitionBy("crop")
    placed = curve.where(F.col("exceedance_probability").between(low, high)).withColumns({"_i": F.row_number().over(own.orderBy("rank")) - 1, "_m": F.count("*").over(own)})
    return placed.where(F.col("_i") % F.greatest(F.lit(1).cast("long"), F.floor(F.col("_m") / points)) == 0).drop("_i", "_m")


def trend(df: DataFrame, keys: list[str], y: Column, x: Column, least: int = 3) -> DataFrame:
    """Least squares of each group with ``least`` values or more: ``slope``, ``intercept``, ``r`` and ``n``; NULL for smaller ones."""
    known = df.withColumns({"_y": y.cast("double"), "_x": x.cast("double")}).where("_y is not null")
    line = known.groupBy(*keys).agg(F.count("*").alias("n"), F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"), F.corr("_y", "_x").alias("r"))
    return line.select(*keys, *(F.when(F.col("n") >= least, F.col(c)).alias(c) for c in ("slope", "intercept", "r")), "n")


def with_significance(line: DataFrame) -> DataFrame:
    """Adds ``p``, the two-sided p-value of ``r`` by Student's t with n - 2 degrees of freedom; 0 for a perfect fit, NULL below three values."""

    @F.pandas_udf("double")
    def two_sided(r: pd.Series, n: pd.Series) -> pd.Series:
        v, own = (n - 2).to_numpy(float), r.to_numpy(float)
        with np.errstate(all="ignore"):
            x = np.where(v > 0, 1 - own * own, np.nan)  # v / (v + t * t)
        return pd.Series(np.where(np.isnan(x), np.nan, beta_i(np.where(v > 0, v, 1.0) / 2, 0.5, np.nan_to_num(x, nan=1.0))))

    return line.withColumn("p", F.nanvl(two_sided("r", F.col("n").cast("double")), F.lit(None).cast("double")))


def correlation(annual: DataFrame) -> DataFrame:
    """Pearson correlation of each pair of crops over years, missing years as 0; a pair without variance has 0. Crops meet by year, which gives a row for
    each pair of crops and year: it is meant for some dozens of crops, not for pixels. Only the years come to the driver, as many as a calendar has."""
    years = [r[0] for r in annual.select("year").distinct().orderBy("year").collect()]
    full = annual.select("crop").distinct().withColumn("year", F.explode(F.lit(years)))
    values = full.join(annual, ["crop", "year"], "left").groupBy("crop", "year").agg(F.coalesce(F.sum("loss_usd"), F.lit(0.0)).alias("v"))
    a, b = (values.select(F.col("crop").alias(f"crop_{s}"), "year", F.col("v").alias(f"v_{s}")) for s in "ab")
    return a.join(b, "year").groupBy("crop_a", "crop_b").agg(F.coalesce(F.corr("v_a", "v_b"), F.lit(0.0)).alias("r"))
