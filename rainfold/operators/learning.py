"""Principal components and clusters of vectors, and areas of alike climate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainfold.operators import polygons as geometry
from rainfold.operators.climatology import with_fields
from rainfold.sources.scratch import written


def vectors(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("_raw", array_to_vector(F.col(column).cast("array<double>")))


def pca(df: DataFrame, column: str, k: int) -> DataFrame:
    """Adds the first ``k`` principal components of a column of vectors, less their means, over their deviations (ddof 0)."""
    n = df.count()
    scaled = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True).fit(own := vectors(df, column)).transform(own)
    out = PCA(k=k, inputCol="_scaled", outputCol="_pc").fit(scaled).transform(scaled)
    # The scaler divides by the deviation of a sample.
    return out.withColumn("components", F.transform(vector_to_array("_pc"), lambda v: v * (n / max(1, n - 1)) ** 0.5)).drop("_raw", "_scaled", "_pc")


def kmeans(df: DataFrame, column: str, k: int, starts: int = 12, seed: int = 42) -> DataFrame:
    """The best of several starts, by the cost of training."""
    own = vectors(df, column).cache()
    try:
        models = [KMeans(k=k, seed=seed + i, featuresCol="_raw", predictionCol="cluster").fit(own) for i in range(starts)]
    finally:
        own.unpersist()
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best.transform(vectors(df, column)).drop("_raw")


def standardized(pixels: DataFrame) -> DataFrame:
    """``(polygon_id, pixel_id, z, n, whole)``: features of each polygon's pixels less their mean, over their deviation (ddof 0; 1 if that is 0).

    Features without any value in a polygon go, and so do pixels without any; ``whole`` tells whether a polygon then has all values, ``n`` is its number of pixels.
    """
    own = pixels.where(F.exists("features", lambda v: v.isNotNull())).select("polygon_id", "pixel_id", "features")
    values = own.select("polygon_id", F.posexplode("features").alias("i", "v"))
    stats = values.groupBy("polygon_id", "i").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count("v").alias("have"), F.count("*").alias("all")).where("have > 0")
    rows = stats.groupBy("polygon_id").agg(F.array_sort(F.collect_list(F.struct("i", "mean", F.when(F.col("std") > 0, F.col("std")).otherwise(1.0).alias("std")))).alias("_s"), F.min(F.col("have") == F.col("all")).alias("whole"), F.max("all").alias("n"))
    z = F.transform("_s", lambda s: (F.get("features", s["i"]) - s["mean"]) / s["std"])
    return own.join(rows, "polygon_id").select("polygon_id", "pixel_id", z.alias("z"), "n", "whole")


def components_of(z: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(polygon_id, pixel_id, pc)``: the first ``n_comp`` principal components of each polygon of ``wanted(polygon_id, n_comp)``.

    Products of features are summed by polygon, which leaves a matrix of features by features a polygon; tasks take its eigenvectors. Each is signed so that its largest loading is
    positive.
    """
    own = z.join(wanted, "polygon_id")
    pairs = own.select("polygon_id", "n_comp", F.posexplode("z").alias("i", "a"), "z").select("polygon_id", "n_comp", "i", "a", F.posexplode("z").alias("j", "b")).where("j <= i")
    sums = pairs.groupBy("polygon_id", "n_comp", "i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("s"))
    rows = sums.groupBy("polygon_id", "n_comp").agg(F.array_sort(F.collect_list(F.struct("i", "j", "s"))).alias("lower"))
    schema = with_fields(rows, ["polygon_id"], "loadings array<array<double>>")

    def vectors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n_comp, lower in zip(batch.column("n_comp").to_pylist(), batch.column("lower").to_pylist()):
                side = max(x["i"] for x in lower) + 1
                m = np.zeros((side, side))
                for x in lower:
                    m[x["i"], x["j"]] = m[x["j"], x["i"]] = x["s"]
                top = np.linalg.eigh(m)[1].T[::-1][:n_comp]
                out.append((top * np.sign(top[np.arange(len(top)), np.abs(top).argmax(axis=1)])[:, None]).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("polygon_id"), pa.array(out, pa.list_(pa.list_(pa.float64())))], names=["polygon_id", "loadings"])

    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    return own.join(rows.mapInArrow(vectors_of, schema), "polygon_id").select("polygon_id", "pixel_id", F.transform("loadings", lambda v: dot(v, F.col("z"))).alias("pc"))


def clustered(points: DataFrame, wanted: DataFrame, starts: int = 12, rounds: int = 50) -> DataFrame:
    """``(polygon_id, pixel_id, area)``: k-means of ``points(polygon_id, pixel_id, pc)`` within each polygon of ``wanted(polygon_id, n_areas)``, the cheapest of several starts.

    All polygons and starts go side by side: a polygon's centres, few, come as one row to its pixels, which tell each start their nearest one (ties: the smaller number); only sums are
    shuffled. A start's centres are the pixels with its smallest hashes, so the result is the same on any plan; areas that lose all pixels go. A round writes its centres and ends the
    loop if none has moved.
    """
    own = written(points, "components")
    draw = Window.partitionBy("polygon_id", "start").orderBy(F.md5(F.concat_ws(":", "start", "pixel_id")), "pixel_id")
    drawn = own.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(starts - 1)))).withColumn("area", F.row_number().over(draw) - 1)
    drawn = drawn.join(wanted, "polygon_id").where(F.col("area") < F.col("n_areas"))
    centres, before = written(drawn.select("polygon_id", "start", "area", F.col("pc").alias("centre")), "centres"), None
    distance = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)

    def assigned() -> DataFrame:
        by_start = centres.groupBy("polygon_id", "start").agg(F.array_sort(F.collect_list(F.struct("area", "centre"))).alias("cs"))
        rows = own.join(by_start.groupBy("polygon_id").agg(F.collect_list(F.struct("start", "cs")).alias("starts")), "polygon_id")
        best = lambda cs: F.array_min(F.transform(cs, lambda c: F.struct(distance(F.col("pc"), c["centre"]).alias("d"), c["area"].alias("area"))))
        return rows.select("polygon_id", "pixel_id", "pc", F.inline(F.transform("starts", lambda s: F.struct(s["start"].alias("start"), best(s["cs"]).alias("best")))))

    for _ in range(rounds):
        means = assigned().select("polygon_id", "start", F.col("best.area").alias("area"), F.posexplode("pc").alias("i", "v")).groupBy("polygon_id", "start", "area", "i").agg(F.avg("v").alias("v"))
        centres = written(means.groupBy("polygon_id", "start", "area").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("c")).select("polygon_id", "start", "area", F.col("c.v").alias("centre")), "centres")
        stamp = tuple(centres.agg(F.count("*"), F.sum(F.aggregate("centre", F.lit(0.0), lambda s, v: s + v * v).cast("decimal(38,9)"))).first())
        if stamp == before:
            break
        before = stamp
    out = written(assigned().select("polygon_id", "start", "pixel_id", F.col("best.area").alias("area"), F.col("best.d").alias("d")), "assigned")
    costs = out.groupBy("polygon_id", "start").agg(F.round(F.sum("d"), 9).alias("cost")).groupBy("polygon_id").agg(F.min_by("start", F.struct("cost", "start")).alias("start"))
    return out.join(costs, ["polygon_id", "start"]).select("polygon_id", "pixel_id", F.col("area").cast("long").alias("area"))


def climate_areas(pixels: DataFrame, polygons: DataFrame, min_km2: float, max_km2: float, min_clusters: int = 1, n_comp: int = 5, starts: int = 12) -> DataFrame:
    """``(polygon_id, pixel_id, area)``: the pixels of every polygon in areas of alike climate, numbered from 0.

    ``pixels(polygon_id, pixel_id, features)``, ``polygons(polygon_id, km2)``. A polygon has as many areas as its size holds ``max_km2``, ``min_clusters`` at least and no more than it has
    pixels; its standardized features are brought down to ``n_comp`` principal components, no more than areas, and clustered. It is one area if it is below ``min_km2``, is left with
    one area, or lacks values of features that others of its pixels have.
    """
    z = written(standardized(pixels), "standardized")
    areas = F.least("n", F.greatest(F.lit(min_clusters), F.lit(1), F.floor(F.col("km2") / max_km2))).cast("int")
    sizes = z.select("polygon_id", "n", "whole").distinct().join(polygons.select("polygon_id", "km2"), "polygon_id").withColumn("n_areas", areas)
    wanted = written(sizes.where((F.col("km2") >= min_km2) & F.col("whole") & (F.col("n_areas") > 1)).select("polygon_id", "n_areas", F.least(F.lit(n_comp), "n_areas").cast("int").alias("n_comp")), "wanted")
    found = clustered(components_of(z, wanted.select("polygon_id", "n_comp")), wanted.select("polygon_id", "n_areas"), starts)
    order = Window.partitionBy("polygon_id").orderBy("area")
    numbers = found.select("polygon_id", "area").distinct().withColumn("number", F.row_number().over(order).cast("long") - 1)
    many = found.join(numbers, ["polygon_id", "area"]).select("polygon_id", "pixel_id", F.col("number").alias("area"))
    one = pixels.join(wanted, "polygon_id", "left_anti").select("polygon_id", "pixel_id", F.lit(0).cast("long").alias("area"))
    return many.unionByName(one)


def area_polygons(assigned: DataFrame, places: DataFrame, polygons: DataFrame, margin: float = 0.5) -> DataFrame:
    """``(polygon_id, area, name, rings)``: the part of each polygon that is nearest to each of its areas' centres, the mean place of the area's pixels.

    ``assigned(polygon_id, pixel_id, area)``, ``places(pixel_id, lon, lat)``, ``polygons(polygon_id, rings)``. Voronoi cells fill the polygon's hull grown by ``margin`` and are overlaid with the
    polygon itself. A polygon of one area, or without pixels, stays as it is, under its own name.
    """
    centres = assigned.join(places, "pixel_id").groupBy("polygon_id", "area").agg(F.avg("lon").alias("x"), F.avg("lat").alias("y"))
    several = centres.groupBy("polygon_id").agg(F.count("*").alias("n")).where("n > 1")
    hulls = polygons.select("polygon_id", geometry.buffered(geometry.hull(F.flatten("rings")), margin).alias("ring"))
    cells = geometry.voronoi(centres.join(several, "polygon_id", "left_semi"), hulls, "polygon_id", "area")
    pairs = cells.select("polygon_id", "area", F.array("ring").alias("_cell")).join(polygons.select("polygon_id", F.col("rings").alias("_whole")), "polygon_id")
    parts = geometry.with_combined(pairs, "_cell", "_whole").where(F.size("rings") > 0)
    name = F.concat_ws("-", F.col("polygon_id").cast("string"), F.lpad(F.col("area").cast("string"), 2, "0"))
    whole = polygons.join(several, "polygon_id", "left_anti").select("polygon_id", F.lit(0).cast("long").alias("area"), F.col("polygon_id").cast("string").alias("name"), "rings")
    return parts.select("polygon_id", "area", name.alias("name"), "rings").unionByName(whole)
