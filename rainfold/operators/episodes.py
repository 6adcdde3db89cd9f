"""Flags, runs and rolling statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flag_intensity(df: DataFrame, value: Column, threshold: Column, tail: str = "upper", hard: Column | None = None) -> DataFrame:
    """``flag`` (1 or 0) and ``intensity``, the depth beyond the threshold; both NULL where the value is."""
    beyond = value >= threshold if tail == "upper" else value <= threshold
    if hard is not None:
        beyond = beyond & (hard.isNull() | (value >= hard if tail == "upper" else value <= hard))
    depth = F.greatest(value - threshold if tail == "upper" else threshold - value, F.lit(0.0))
    hit = F.coalesce(beyond, F.lit(False))
    return df.withColumns({"flag": F.when(value.isNotNull(), F.when(hit, 1).otherwise(0)), "intensity": F.when(value.isNotNull(), F.when(hit, depth).otherwise(0.0))})


def runs(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``run`` and ``run_intensity`` of consecutive flags; a zero begins anew, a NULL doesn't."""
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    island = df.withColumn("_island", F.sum(F.when(F.col("flag") == 0, 1).otherwise(0)).over(so_far))
    inside = Window.partitionBy(*keys, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.col("flag").isNotNull()
    return island.withColumns({"run": F.when(known, F.sum("flag").over(inside)), "run_intensity": F.when(known, F.sum(F.col("intensity") * F.col("flag")).over(inside))}).drop("_island")


def events(df: DataFrame, days: int) -> DataFrame:
    """``event``: 1 on the day on which a run reaches ``days``."""
    return df.withColumn("event", F.when((F.col("run") == days) & (F.col("flag") == 1), 1).otherwise(0))


def rolling(df: DataFrame, keys: list[str], order: str, value: str, before: int, after: int = 0, fn=F.avg) -> Column:
    return fn(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(-before, after))


def spatial_rolling(df: DataFrame, value: str, half: int, keys: list[str] = (), fn=F.avg, least: int = 1) -> DataFrame:
    """Statistic over the box of (2 half + 1)² grid cells around each cell, NULL with under ``least`` values. Each value is sent to the centres that it counts for, an equality on the grid's indices."""
    offsets = F.sequence(F.lit(-half), F.lit(half))
    sent = df.withColumn("_dy", F.explode(offsets)).withColumn("_dx", F.explode(offsets))
    sent = sent.select(*keys, (F.col("iy") + F.col("_dy")).alias("iy"), (F.col("ix") + F.col("_dx")).alias("ix"), F.col(value).alias("_v"))
    pooled = sent.groupBy(*keys, "iy", "ix").agg(F.when(F.count("_v") >= least, fn("_v")).alias("rolled"), F.count("_v").alias("n"))
    return df.join(pooled, [*keys, "iy", "ix"])
