"""Queries of polygons: hulls, Voronoi cells, overlays, outlines of grids, climate areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.operators import learning, polygons, spatial
from rainfold.plans.catalog import query
from rainfold.plans.rows import _POINTS, points
from rainfold.sources.tables import CELLS, OBS, cells, observations, read


def point(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box(x0, y0, x1, y1):
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def regional(spark: SparkSession, d: str) -> DataFrame:
    """``(region, pixel_id, lon, lat)``."""
    region = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("pixel_id"), F.col("n_regionkey").cast("long").alias("region"))
    return cells(spark, d).join(region, "pixel_id")


_REGIONAL = f"{CELLS}, own AS (SELECT CAST(n_regionkey AS BIGINT) AS region, c.* FROM cells c JOIN nation ON n_nationkey = pixel_id)"
_PLACES = "places AS (SELECT CAST(s_nationkey AS BIGINT) AS nation, CAST(n_regionkey AS BIGINT) AS region, (s_suppkey * 7 % 13) / 4.0::DOUBLE AS x, (s_suppkey * 11 % 12) / 4.0::DOUBLE AS y FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
_SEEDS = f"{_PLACES}, seeds AS (SELECT region AS seed, avg(x) AS x, avg(y) AS y FROM places GROUP BY ALL)"


def places(spark: SparkSession, d: str) -> DataFrame:
    """``(nation, region, x, y)`` of the suppliers."""
    nations = read(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").cast("long").alias("region"))
    x, y = (F.col("s_suppkey") * a % b / 4.0 for a, b in ((7, 13), (11, 12)))
    return read(spark, d, "supplier").join(nations, "s_nationkey").select(F.col("s_nationkey").cast("long").alias("nation"), "region", x.alias("x"), y.alias("y"))


@query("polygon_hulls", f"""WITH {_PLACES}, own AS (SELECT DISTINCT nation, x, y FROM places), e AS (
  SELECT p.nation, p.x AS px, p.y AS py, q.x AS qx, q.y AS qy FROM own p JOIN own q ON p.nation = q.nation AND (p.x, p.y) <> (q.x, q.y)
  WHERE NOT EXISTS (SELECT 1 FROM own r WHERE r.nation = p.nation AND ((q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x) < 0
    OR ((q.x - p.x) * (r.y - p.y) = (q.y - p.y) * (r.x - p.x) AND (r.x < least(p.x, q.x) OR r.x > greatest(p.x, q.x) OR r.y < least(p.y, q.y) OR r.y > greatest(p.y, q.y))))))
SELECT nation, count(*) AS corners, sum(px * qy - qx * py) / 2 AS area, round(sum((px + qx) * (px * qy - qx * py)) / sum(px * qy - qx * py) / 3, 6) AS x, round(sum((py + qy) * (px * qy - qx * py)) / sum(px * qy - qx * py) / 3, 6) AS y FROM e GROUP BY nation HAVING sum(px * qy - qx * py) > 0""")
def _(spark, d):
    """Convex hulls of the nations' suppliers that aren't in line, with their corners, areas and centres."""
    rings = places(spark, d).groupBy("nation").agg(polygons.hull(F.collect_list(F.struct("x", "y"))).alias("ring")).withColumn("c", polygons.centroid(F.col("ring")))
    rings = rings.select("nation", F.size("ring").cast("long").alias("corners"), polygons.signed_area(F.col("ring")).alias("area"), F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))
    return rings.where("area > 0")


def voronoi(spark: SparkSession, d: str) -> DataFrame:
    """The cells of the regions' mean places within a box around all."""
    own = places(spark, d)
    seeds = own.groupBy(F.col("region").alias("seed")).agg(F.avg("x").alias("x"), F.avg("y").alias("y")).withColumn("all", F.lit(0))
    around = own.agg(F.min("x").alias("a"), F.max("x").alias("b"), F.min("y").alias("c"), F.max("y").alias("e")).select(F.lit(0).alias("all"), box(F.col("a") - 5, F.col("c") - 5, F.col("b") + 5, F.col("e") + 5).alias("ring"))
    return polygons.voronoi(seeds, around, "all", "seed")


@query("voronoi_pixels", f"WITH {_SEEDS}, {_POINTS} SELECT id, seed FROM (SELECT id, seed, row_number() OVER (PARTITION BY id ORDER BY (lon - x) ** 2 + (lat - y) ** 2, seed) AS n FROM points, seeds) WHERE n = 1")
def _(spark, d):
    """Every point lies in the ring of its nearest seed."""
    return spatial.within(points(spark, d), voronoi(spark, d).select(F.col("seed").alias("polygon_id"), "ring")).select("id", F.col("polygon_id").alias("seed"))


@query("voronoi_polygons", f"""WITH {_SEEDS}, b AS (SELECT min(x) - 5 AS min_x, max(x) + 5 AS max_x, min(y) - 5 AS min_y, max(y) + 5 AS max_y FROM places),
e AS (SELECT seed, x, y, unnest(range(2000)) AS k, min_x, max_x, min_y, max_y FROM seeds, b),
w AS (SELECT seed, min_x + (k + 0.5) * (max_x - min_x) / 2000 AS px, k, x, y, min_y, max_y, (max_x - min_x) / 2000 AS dx FROM e),
c AS (SELECT w.seed, w.k, dx, greatest(min_y, max(CASE WHEN t.y < w.y THEN ((t.x - w.x) * ((t.x + w.x) / 2 - px)) / (t.y - w.y) + (t.y + w.y) / 2 END)) AS low, least(max_y, min(CASE WHEN t.y > w.y THEN ((t.x - w.x) * ((t.x + w.x) / 2 - px)) / (t.y - w.y) + (t.y + w.y) / 2 END)) AS high,
  bool_and(t.y <> w.y OR (t.x - w.x) * (px - (t.x + w.x) / 2) <= 0) AS ok FROM w JOIN seeds t ON t.seed <> w.seed GROUP BY w.seed, w.k, dx, min_y, max_y)
SELECT seed, round(sum(CASE WHEN ok AND high > low THEN (high - low) * dx ELSE 0 END), 1) AS area FROM c GROUP BY seed""")
def _(spark, d):
    """Areas of the rings, against strips of a two-thousandth of the width."""
    return voronoi(spark, d).select("seed", F.round(polygons.signed_area(F.col("ring")), 1).alias("area"))


def frames(spark: SparkSession, d: str) -> DataFrame:
    """Squares of side 4 with a hole of side 2, three apart."""
    x, y = 3 * (F.col("n_nationkey") % 5), 3 * F.floor(F.col("n_nationkey") / 5)
    return read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("left_id"), F.array(box(x, y, x + 4, y + 4), box(x + 1, y + 1, x + 3, y + 3)).alias("rings"))


def angles(spark: SparkSession, d: str) -> DataFrame:
    """L shapes of three by three cells."""
    x, y = F.col("s_suppkey") * 7 % 13, F.col("s_suppkey") * 11 % 12
    ring = F.array(point(x, y), point(x + 3, y), point(x + 3, y + 1), point(x + 1, y + 1), point(x + 1, y + 3), point(x, y + 3))
    return read(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("right_id"), F.array(ring).alias("rings"))


@query("polygon_overlay", """WITH a AS (SELECT CAST(n_nationkey AS BIGINT) AS left_id, 3 * (n_nationkey % 5) + i AS x, 3 * (n_nationkey // 5) + j AS y FROM nation, range(4) t(i), range(4) u(j) WHERE NOT (i IN (1, 2) AND j IN (1, 2))),
b AS (SELECT CAST(s_suppkey AS BIGINT) AS right_id, s_suppkey * 7 % 13 + i AS x, s_suppkey * 11 % 12 + j AS y FROM supplier, range(3) t(i), range(3) u(j) WHERE i = 0 OR j = 0)
SELECT left_id, right_id, CAST(count(*) AS DOUBLE) AS area FROM a JOIN b USING (x, y) GROUP BY ALL""")
def _(spark, d):
    """Shared areas of shapes with holes and corners that point inwards, counted by cells in the SQL."""
    return polygons.overlay(frames(spark, d), angles(spark, d), 2.0).select("left_id", "right_id", F.round("area", 6).alias("area"))


_GRID = "grid AS (SELECT p_partkey % 47 AS i, p_partkey % 41 AS j, max(p_size) % 2 AS label FROM part GROUP BY ALL)"


def grid(spark: SparkSession, d: str) -> DataFrame:
    part = read(spark, d, "part")
    return part.groupBy((F.col("p_partkey") % 47).alias("i"), (F.col("p_partkey") % 41).alias("j")).agg((F.max("p_size") % 2).cast("long").alias("label"))


@query("grid_outlines", f"""WITH RECURSIVE {_GRID}, c AS (SELECT *, j * 4294967296 + i AS code FROM grid),
n AS (SELECT a.code AS a, b.code AS b FROM c a JOIN c b ON a.label = b.label AND ((a.i = b.i AND abs(a.j - b.j) = 1) OR (a.j = b.j AND abs(a.i - b.i) = 1))),
r AS (SELECT code AS node, code AS seen FROM c UNION SELECT r.node, n.b FROM r JOIN n ON n.a = r.seen),
k AS (SELECT node, min(seen) AS region FROM r GROUP BY node),
s AS (SELECT k.region, c.label, c.code, 4 - (SELECT count(*) FROM n WHERE n.a = c.code) AS sides FROM c JOIN k ON k.node = c.code)
SELECT CAST(region AS BIGINT) AS region, CAST(any_value(label) AS BIGINT) AS label, count(*) AS cells, CAST(count(*) AS DOUBLE) AS area, CAST(sum(sides) AS DOUBLE) AS border FROM s GROUP BY region""")
def _(spark, d):
    """Regions of equal labels as polygons: their rings' areas are their cells, their lengths the cells' open sides."""
    length = F.aggregate("rings", F.lit(0.0), lambda s, r: F.aggregate(polygons.sides(r), s, lambda a, e: a + F.abs(e["p"]["x"] - e["q"]["x"]) + F.abs(e["p"]["y"] - e["q"]["y"])))
    return polygons.outlines(polygons.regions(grid(spark, d))).select("region", "label", "cells", polygons.rings_area(F.col("rings")).alias("area"), length.alias("border"))


@query("cluster_polygons", """WITH p AS (SELECT (p_partkey % 47) / 20.0::DOUBLE AS x, (p_partkey % 41) / 20.0::DOUBLE AS y, CAST(p_size % 3 AS BIGINT) AS label FROM part), c AS (SELECT i, j, (i + 0.5) * 0.2::DOUBLE AS lon, (j + 0.5) * 0.2::DOUBLE AS lat FROM range(20) t(i), range(20) u(j)),
m AS (SELECT label, count(*) AS m FROM p GROUP BY label), k AS (SELECT i, j, label, round(sum(exp(-sqrt((lon - x) ** 2 + (lat - y) ** 2) / 0.1)) / any_value(m), 9) AS d FROM c JOIN p ON (lon - x) ** 2 + (lat - y) ** 2 <= 0.64 JOIN m USING (label) GROUP BY ALL),
b AS (SELECT i, j, label FROM k QUALIFY row_number() OVER (PARTITION BY i, j ORDER BY d DESC, label) = 1),
f AS (SELECT i, j, label FROM c, p WHERE (i, j) NOT IN (SELECT (i, j) FROM b) QUALIFY row_number() OVER (PARTITION BY i, j ORDER BY sqrt((lon - x) ** 2 + (lat - y) ** 2), x, y, label) = 1)
SELECT label, count(*) AS cells, round(count(*) * 0.04::DOUBLE, 6) AS area FROM (SELECT * FROM b UNION ALL SELECT * FROM f) GROUP BY label""")
def _(spark, d):
    """Where the parts of each kind are densest, as polygons whose areas are those of the grid's cells."""
    key = F.col("p_partkey")
    own = read(spark, d, "part").select((key % 47 / 20.0).alias("x"), (key % 41 / 20.0).alias("y"), (F.col("p_size") % 3).cast("long").alias("label"))
    found = polygons.cluster_polygons(own, "label", (0.0, 0.0, 4.0, 4.0), 20, 0.1)
    return found.groupBy("label").agg(F.sum("cells").alias("cells"), F.round(F.sum(polygons.rings_area(F.col("rings"))), 6).alias("area"))


def climate(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Regions as polygons, boxes around their cells, and their pixels' monthly means in areas of alike climate."""
    months = observations(spark, d).groupBy("pixel_id", F.month("date").alias("m")).agg(F.avg("swc").alias("v")).groupBy("pixel_id").agg(F.map_from_entries(F.collect_list(F.struct("m", "v"))).alias("of"))
    own = regional(spark, d).withColumnRenamed("region", "polygon_id")
    pixels = own.join(months, "pixel_id").select("polygon_id", "pixel_id", F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.try_element_at("of", m)).alias("features"))
    around = own.groupBy("polygon_id").agg(F.array(box(F.min("lon") - 1, F.min("lat") - 1, F.max("lon") + 1, F.max("lat") + 1)).alias("rings"))
    around = around.withColumn("km2", 50.0 * F.col("polygon_id") + 1)
    return around, learning.climate_areas(pixels, around, 10.0, 50.0, 2)


@query("climate_area_pixels")
def _(spark, d):
    """Every pixel's polygon and area."""
    return climate(spark, d)[1]


@query("climate_area_rings", f"WITH {_REGIONAL} SELECT region AS polygon_id, (max(lon) - min(lon) + 2) * (max(lat) - min(lat) + 2) AS area, true AS alike FROM own GROUP BY region")
def _(spark, d):
    """The areas of a polygon add up to it; it has one for each centre of those that its pixels are dealt to."""
    around, assigned = climate(spark, d)
    own = cells(spark, d)
    parts = learning.area_polygons(assigned, own, around)
    centres = assigned.join(own, "pixel_id").groupBy("polygon_id", "area").agg(F.struct(F.avg("lon"), F.avg("lat")).alias("c"))
    wanted = around.select("polygon_id").join(centres.groupBy("polygon_id").agg(F.count_distinct("c").alias("wanted")), "polygon_id", "left")
    found = parts.groupBy("polygon_id").agg(F.round(F.sum(polygons.rings_area(F.col("rings"))), 6).alias("area"), F.count("*").alias("n"))
    return found.join(wanted, "polygon_id").select("polygon_id", "area", (F.col("n") == F.coalesce("wanted", F.lit(1))).alias("alike"))
