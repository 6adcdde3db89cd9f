"""Grids and points: boxes, nearest cells, regridding, polygons."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainfold.functions import scalars
from rainfold.sources.scratch import written


def wrap_longitude(lon: Column) -> Column:
    """0..360 to -180..180."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def rounded_bounds(df: DataFrame, lon: str, lat: str, n: int = 10) -> DataFrame:
    """Bounding box rounded outward to 1/n degree."""
    return df.agg(
        (F.floor(F.min(lon) * n) / n).alias("minx"), (F.ceil(F.max(lon) * n) / n).alias("maxx"),
        (F.floor(F.min(lat) * n) / n).alias("miny"), (F.ceil(F.max(lat) * n) / n).alias("maxy"))


def enclosing_box(df: DataFrame, lon: str, lat: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows within the box after each side is moved outward to the nearest grid coordinate, or to the grid's end."""
    minx, maxx, miny, maxy = box
    low = lambda c, x: F.coalesce(F.max(F.when(F.col(c) <= x, F.col(c))), F.min(c))
    high = lambda c, x: F.coalesce(F.min(F.when(F.col(c) >= x, F.col(c))), F.max(c))
    a, b, c, d = df.agg(low(lon, minx), high(lon, maxx), low(lat, miny), high(lat, maxy)).first()
    return df.where(F.col(lon).between(a, b) & F.col(lat).between(c, d))


#: Items that a tile may hold undivided, and bits of each axis that a level of tiles takes.
LEAF, STEP = 64, 3


def _tree(items: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Items with a ``_code``, whose leading bits name their tiles, and the number of levels of tiles.

    Tiles come from the ranks of the items' middles along each axis, not from coordinates, so a few far ones don't put the others in one tile. The bits of both ranks
    alternate in the code.
    """
    levels = min(10, -(-max(1, (total - 1).bit_length()) // STEP))
    placed, bits = items.withColumns({"_mx": (F.col("_x0") + F.col("_x1")) / 2, "_my": (F.col("_y0") + F.col("_y1")) / 2}), STEP * levels
    spare = max(0, (total - 1).bit_length() - bits)
    for axis in ("_mx", "_my"):
        ranks = scalars.numbered(placed.select(axis).distinct(), [axis], f"{axis}r").withColumn(f"{axis}r", F.shiftright(F.col(f"{axis}r") - 1, spare))
        placed = placed.join(ranks, axis)
    bit = lambda c, i, to: F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1).cast("long")), to)
    code = reduce(lambda x, y: x.bitwiseOR(y), (bit(c, i, 2 * i + k) for i in range(bits) for k, c in enumerate(("_mxr", "_myr"))))
    return written(placed.withColumn("_code", code).drop("_mx", "_my", "_mxr", "_myr"), "tree"), levels


def _candidates(points: DataFrame, items: DataFrame, key: str | list[str], k: int) -> DataFrame:
    """``points(lon, lat)``, told apart by ``key``, with all ``items``, in boxes ``_x0`` to ``_y1``, that can be among their ``k`` nearest, and perhaps a few more.

    Points go down a tree of tiles, level by level. From the boxes around the tiles' items a point knows how far ``k`` of them are at most, and leaves out the
    tiles that are further away at least; a tile of at most LEAF items isn't divided. So a point meets few tiles a level and few items, whatever the density or distance.
    """
    keys = [key] if isinstance(key, str) else key
    own = list(dict.fromkeys([*keys, "lon", "lat"]))
    total = items.count()
    gap = lambda of, c, low, high: F.greatest(of(low) - F.col(c), F.col(c) - of(high), F.lit(0.0))
    reach = lambda of, c, low, high: F.greatest(F.abs(F.col(c) - of(low)), F.abs(F.col(c) - of(high)))
    least = lambda of: F.hypot(gap(of, "lon", "_x0", "_x1"), gap(of, "lat", "_y0", "_y1"))
    most = lambda of: F.hypot(reach(of, "lon", "_x0", "_x1"), reach(of, "lat", "_y0", "_y1"))
    if total <= LEAF:  # a bounded table, one row
        every = items.agg(F.collect_list(F.struct("_x0", "_x1", "_y0", "_y1", *(c for c in items.columns if c not in ("_x0", "_x1", "_y0", "_y1")))).alias("_items")).withColumn("_all", F.lit(0))
        met = points.withColumn("_all", F.lit(0)).join(F.broadcast(every), "_all").withColumn("_bound", F.get(F.array_sort(F.transform("_items", lambda i: most(i.getField))), F.lit(k - 1)))
        return met.select(*points.columns, F.inline(F.filter("_items", lambda i: F.col("_bound").isNull() | (least(i.getField) <= F.col("_bound") * F.lit(1 + 1e-9)))))
    placed, levels = _tree(items, total)
    front = points.select(*own, F.lit(0).cast("long").alias("_tile"))
    kept = None
    for level in range(levels):
        shift = 2 * STEP * (levels - 1 - level)
        tiles = placed.groupBy(F.shiftright("_code", shift).alias("_in")).agg(F.count("*").alias("_n"), *(f(c).alias(c) for f, c in ((F.min, "_x0"), (F.max, "_x1"), (F.min, "_y0"), (F.max, "_y1"))))
        tiles = tiles.withColumn("_tile", F.shiftright("_in", 2 * STEP))
        met = front.join(F.broadcast(tiles) if not level else tiles, "_tile").withColumns({"_least": least(F.col), "_most": most(F.col)})
        met = met.select(*own, F.lit(level).alias("_level"), F.col("_in").alias("_tile"), "_n", "_least", "_most", (F.col("_n") <= LEAF).alias("_done") if level < levels - 1 else F.lit(True).alias("_done"))
        met = met if kept is None else kept.where("_done").unionByName(met)
        each = Window.partitionBy(*keys)
        met = met.withColumn("_sum", F.sum("_n").over(each.orderBy("_most", "_level", "_tile").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        met = met.withColumn("_bound", F.min(F.when(F.col("_sum") >= k, F.col("_most"))).over(each)).where("_bound is null or _least <= _bound * (1 + 1e-9D)").drop("_sum", "_bound")
        kept = written(met, "tiles")
        front = kept.where("not _done").select(*own, "_tile")
        if front.isEmpty():
            break
    parts = []
    for (level,) in kept.select("_level").distinct().collect():
        shift = 2 * STEP * (levels - 1 - level)
        parts.append(kept.where(F.col("_level") == level).select(*keys, "_tile").join(placed.withColumn("_tile", F.shiftright("_code", shift)), "_tile").drop("_tile", "_code"))
    return points.join(reduce(DataFrame.unionByName, parts), keys)


#: What tells places apart.
PLACE = ["lon", "lat"]


def _ranked(points: DataFrame, items: DataFrame, distance: Column, k: int, ties: list[str]) -> DataFrame:
    """``points`` with the ``k`` nearest of ``items``. Points at one place have the same ones, which are looked for once."""
    known = points.where("lon is not null and lat is not null")
    met = _candidates(known.select(*PLACE).distinct(), items, PLACE, k)
    order = Window.partitionBy(*PLACE).orderBy("distance", *ties)
    found = met.withColumn("distance", distance).withColumn("neighbor_rank", F.row_number().over(order) - 1).where(F.col("neighbor_rank") < k).drop("_x0", "_x1", "_y0", "_y1")
    return known.join(written(found, "nearest"), PLACE)


def nearest(points: DataFrame, cells: DataFrame, key: str, k: int = 1) -> DataFrame:
    """The ``k`` nearest cells of each point, planar distance, all of them if there are fewer; ties by lon, lat.

    Points and cells with a null coordinate have no neighbours, and no rows here.
    """
    own = cells.where("lon is not null and lat is not null").select(F.col("lon").cast("double").alias("cell_lon"), F.col("lat").cast("double").alias("cell_lat"), "pixel_id")
    # Of cells at one place only the first k can count.
    own = own.withColumn("_n", F.row_number().over(Window.partitionBy("cell_lon", "cell_lat").orderBy("pixel_id"))).where(F.col("_n") <= k).drop("_n")
    boxed = own.withColumns({c: F.col("cell_lon" if "x" in c else "cell_lat") for c in ("_x0", "_x1", "_y0", "_y1")})
    d = F.sqrt(F.pow(F.col("lon") - F.col("cell_lon"), 2) + F.pow(F.col("lat") - F.col("cell_lat"), 2))
    return _ranked(points, boxed, d, k, ["cell_lon", "cell_lat", "pixel_id"])


def _tiles(polygons: DataFrame, size: float) -> DataFrame:
    """Polygons ``(polygon_id, ring)``, a ring being an array of (x, y), by the boxes that they touch."""
    side = lambda f, c: F.floor(f(F.transform("ring", lambda p: p[c])) / size).cast("long")
    spans = polygons.withColumns({"_bx": F.explode(F.sequence(side(F.array_min, "x"), side(F.array_max, "x")))})
    return spans.withColumn("_by", F.explode(F.sequence(side(F.array_min, "y"), side(F.array_max, "y"))))


#: The sides of ``ring`` as (p, q).
_SIDES = "zip_with(ring, concat(slice(ring, 2, size(ring)), slice(ring, 1, 1)), (p, q) -> struct(p, q))"
#: Ray casting: strictly inside if an odd number of sides lies to the right.
INSIDE = f"aggregate({_SIDES}, false, (odd, s) -> odd <> (((lat < s.p.y) <> (lat < s.q.y)) and lon < (s.q.x - s.p.x) * (lat - s.p.y) / (s.q.y - s.p.y) + s.p.x))"
_ALONG = "greatest(0D, least(1D, coalesce(((lon - s.p.x) * (s.q.x - s.p.x) + (lat - s.p.y) * (s.q.y - s.p.y)) / nullif(pow(s.q.x - s.p.x, 2) + pow(s.q.y - s.p.y, 2), 0D), 0D)))"
_TO_SIDE = f"sqrt(pow(s.p.x + {_ALONG} * (s.q.x - s.p.x) - lon, 2) + pow(s.p.y + {_ALONG} * (s.q.y - s.p.y) - lat, 2))"


def within(points: DataFrame, polygons: DataFrame, size: float = 1.0) -> DataFrame:
    """Points with the polygons ``(polygon_id, ring)`` that they are strictly inside of; they meet by the boxes of ``size`` that a polygon touches."""
    own = points.withColumns({"_bx": F.floor(F.col("lon") / size).cast("long"), "_by": F.floor(F.col("lat") / size).cast("long")})
    return own.join(_tiles(polygons, size), ["_bx", "_by"]).where(F.expr(INSIDE)).drop("_bx", "_by", "ring")


def nearest_polygon(points: DataFrame, polygons: DataFrame, key: str) -> DataFrame:
    """The nearest polygon of each point, at distance 0 if the point is inside; ties by polygon_id."""
    d = F.when(F.expr(INSIDE), 0.0).otherwise(F.expr(f"array_min(transform({_SIDES}, s -> {_TO_SIDE}))"))
    end = lambda f, c: f(F.transform("ring", lambda p: p[c]))
    boxed = polygons.withColumns({"_x0": end(F.array_min, "x"), "_x1": end(F.array_max, "x"), "_y0": end(F.array_min, "y"), "_y1": end(F.array_max, "y")})
    return _ranked(points, boxed.where("_x0 is not null"), d, 1, ["polygon_id"]).drop("ring", "neighbor_rank")


def _lookup(axis: DataFrame, column: str) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``(_bucket, _near)``: for each bucket of an axis its values that can be next to a coordinate in it, in order; and the bucket of a coordinate.

    An axis has as many values as a grid has columns or rows. Buckets hold as many of them as there are buckets, whatever their distances, and their bounds, a square root of the axis, are
    what the driver sees. Each value is in the buckets from its neighbour below to that above.
    """
    values = axis.select(F.col(column).cast("double").alias("v")).where("v is not null").distinct()
    order = Window.orderBy("v")
    placed = written(values.select("v", F.row_number().over(order).alias("n"), F.lag("v").over(order).alias("a"), F.lead("v").over(order).alias("b")), "axis")
    step = max(1, math.isqrt(placed.count()))
    bounds = F.lit([r["v"] for r in placed.where(F.col("n") % step == 0).orderBy("v").collect()]).cast("array<double>")
    bucket = lambda c: F.size(F.filter(bounds, lambda v: v <= c)).cast("long")
    first, last = F.lit(0).cast("long"), F.size(bounds).cast("long")
    spread = placed.select("v", F.explode(F.sequence(F.when(F.col("a").isNull(), first).otherwise(bucket(F.col("a"))), F.when(F.col("b").isNull(), last).otherwise(bucket(F.col("b"))))).alias("_bucket"))
    return spread.groupBy("_bucket").agg(F.array_sort(F.collect_list("v")).alias("_near")), bucket


def _with_near(df: DataFrame, coordinate: str, axis: DataFrame, column: str) -> DataFrame:
    near, bucket = _lookup(axis, column)
    return df.withColumn("_bucket", bucket(F.col(coordinate))).join(near, "_bucket", "left").drop("_bucket")


def _closest(x: Column, larger: bool) -> Column:
    """The value of ``_near`` closest to ``x``, of two equally near the smaller or the larger one."""
    best = lambda a, v: a.isNull() | ((F.abs(v - x) <= F.abs(a - x)) if larger else (F.abs(v - x) < F.abs(a - x)))
    return F.when(x.isNotNull(), F.aggregate("_near", F.lit(None).cast("double"), lambda a, v: F.when(best(a, v), v).otherwise(a)))


def snap(points: DataFrame, axis: DataFrame, coordinate: str, axis_coordinate: str) -> DataFrame:
    """Nearest value of a grid axis, the lower of two equally near, by an equality join on buckets of the axis. NULL for a null coordinate."""
    return _with_near(points, coordinate, axis, axis_coordinate).withColumn(axis_coordinate, _closest(F.col(coordinate), False)).drop("_near")


def ring_area(ring: list[tuple[float, float]]) -> float:
    """Area in km² on the sphere, by an equal-area projection."""
    points = [(6371.0088 * math.radians(x), 6371.0088 * math.sin(math.radians(y))) for x, y in ring]
    return abs(sum(a * d - c * b for (a, b), (c, d) in zip(points, points[1:] + points[:1]))) / 2


def clip_ring(ring: list[tuple[float, float]], window: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Part of a polygon within a convex counter-clockwise window."""
    for (x1, y1), (x2, y2) in zip(window, window[1:] + window[:1]):
        side = lambda p: (x2 - x1) * (p[1] - y1) - (y2 - y1) * (p[0] - x1)  # noqa: B023, E731
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1]):
            a, b = side(p), side(q)
            if a >= 0:
                out.append(p)
            if a * b < 0:
                t = a / (a - b)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        ring = out
        if not ring:
            break
    return ring


def regrid_nearest(cells: DataFrame, value: str, res: float) -> DataFrame:
    """Values of the nearest coordinates of the grid at every ``res`` degrees, of two equally near the larger one."""
    return _regrid(cells, value, res, False)


def regrid_bilinear(cells: DataFrame, value: str, res: float) -> DataFrame:
    """Values between the four cells around every ``res`` degrees; NULL outside the grid and where a corner that counts is missing."""
    return _regrid(cells, value, res, True)


def _target_axis(cells: DataFrame, column: str, res: float, to: str) -> tuple[DataFrame, int]:
    """``(_i, <to>, <to>0, <to>1, <to>n)``: the coordinates from the smallest to the largest one or just beyond, the grid's own ones around each (NULL
    beyond its end) and the nearest."""
    low, high = cells.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    n = 0 if low is None else max(0, math.ceil((high + res - low) / res))
    x = F.col(to)
    target = cells.sparkSession.range(n).select(F.col("id").alias("_i"), (F.lit(low or 0.0) + F.col("id") * res).alias(to))
    near = _with_near(target, to, cells, column)
    below, above = F.array_max(F.filter("_near", lambda v: v <= x)), F.array_min(F.filter("_near", lambda v: v >= x))
    return near.select("_i", to, below.alias(f"{to}0"), above.alias(f"{to}1"), _closest(x, True).alias(f"{to}n")), n


def _regrid(cells: DataFrame, value: str, res: float, linear: bool) -> DataFrame:
    """Any grid, of any step, whose cells share their coordinates along each axis; the target's rows meet their axes and cells by equality joins."""
    own = cells.where("lon is not null and lat is not null")
    (xs, nx), (ys, ny) = _target_axis(own, "lon", res, "x"), _target_axis(own, "lat", res, "y")
    at = cells.sparkSession.range(nx * ny).select((F.col("id") % max(nx, 1)).alias("_i"), F.floor(F.col("id") / max(nx, 1)).alias("_j"))
    target = at.join(xs, "_i").join(ys.withColumnRenamed("_i", "_j"), "_j").drop("_i", "_j")
    known = own.select(F.col("lon").cast("double").alias("cx"), F.col("lat").cast("double").alias("cy"), F.col(value).alias("v"))
    if not linear:
        return target.withColumnsRenamed({"xn": "cx", "yn": "cy"}).join(known, ["cx", "cy"], "left").select("x", "y", F.col("v").alias(value))
    corners = []
    for i in (0, 1):
        for j in (0, 1):
            part = lambda c, k: F.when(F.col(f"{c}0") == F.col(f"{c}1"), 1.0 - k).otherwise((F.col(c) - F.col(f"{c}0") if k else F.col(f"{c}1") - F.col(c)) / (F.col(f"{c}1") - F.col(f"{c}0")))
            corners.append(F.struct(F.col(f"x{i}").alias("cx"), F.col(f"y{j}").alias("cy"), (part("x", i) * part("y", j)).alias("w")))
    wide = target.select("x", "y", F.inline(F.array(*corners))).where("w is null or w > 0").join(known, ["cx", "cy"], "left")
    return wide.groupBy("x", "y").agg(F.when(F.count("v") == F.count("*"), F.sum(F.col("w") * F.col("v"))).alias(value))


def regridded(obs: DataFrame, keys: list[str], value: str, res: float, linear: bool = True) -> DataFrame:
    """``(keys, lon, lat, value)``: every group of rows, such as those of a time, on a grid of ``res`` degrees; NULL where a corner that counts has no value.

    Values go to the targets that they count for: rows meet the axes by equality, and the sums are the only shuffle. Targets without any corner have no row.
    """
    own = obs.where("lon is not null and lat is not null")
    maps = []
    for column, to in (("lon", "x"), ("lat", "y")):
        axis, _ = _target_axis(own.select(column).distinct(), column, res, to)
        low, high, at = F.col(f"{to}0"), F.col(f"{to}1"), F.col(to)
        part = F.array(F.struct(low.alias(column), F.when(low == high, 1.0).otherwise((high - at) / (high - low)).alias(f"w{to}")), F.struct(high.alias(column), F.when(low == high, 0.0).otherwise((at - low) / (high - low)).alias(f"w{to}")))
        near = F.array(F.struct(F.col(f"{to}n").alias(column), F.lit(1.0).alias(f"w{to}")))
        spread = axis.select(to, F.inline(F.filter(part, lambda p: p[f"w{to}"] > 0) if linear else near))
        maps.append(spread.withColumn(f"n{to}", F.count("*").over(Window.partitionBy(to))))
    met = own.select(*keys, F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"), F.col(value).alias("v")).join(maps[0], "lon").join(maps[1], "lat")
    sums = met.groupBy(*keys, "x", "y").agg(F.when(F.count("v") == F.max(F.col("nx") * F.col("ny")), F.sum(F.col("wx") * F.col("wy") * F.col("v"))).alias(value))
    return sums.withColumnsRenamed({"x": "lon", "y": "lat"})


def densest(cells: DataFrame, points: DataFrame, label: str, bandwidth: float, kernel: str = "gaussian") -> DataFrame:
    """The label of ``points(x, y, label)`` with the largest kernel density at each of ``cells(pixel_id, lon, lat)``; ties by label.

    Kernels: ``gaussian``, summed and cut at three bandwidths, or ``exponential``, the mean over a label's points, cut at eight. Cells and points meet in boxes of that reach, an equality join;
    densities are rounded to nine places, so that ties are ties on any plan. A cell without points in reach has no row.
    """
    reach = {"gaussian": 3, "exponential": 8}[kernel] * bandwidth
    box = lambda c: F.floor(F.col(c) / reach).cast("long")
    around = F.array(*map(F.lit, (-1, 0, 1)))
    spread = cells.select("pixel_id", "lon", "lat", F.explode(around).alias("_dx")).withColumn("_dy", F.explode(around)).withColumns({"_bx": box("lon") + F.col("_dx"), "_by": box("lat") + F.col("_dy")})
    d2 = F.pow(F.col("lon") - F.col("x"), 2) + F.pow(F.col("lat") - F.col("y"), 2)
    met = spread.join(points.withColumns({"_bx": box("x"), "_by": box("y")}), ["_bx", "_by"]).withColumn("_d2", d2).where(F.col("_d2") <= reach * reach)
    weight = F.exp(-F.col("_d2") / (2 * bandwidth * bandwidth)) if kernel == "gaussian" else F.exp(-F.sqrt("_d2") / bandwidth)
    sums = met.groupBy("pixel_id", label).agg(F.sum(weight).alias("density"))
    if kernel == "exponential":
        sums = sums.join(points.groupBy(label).agg(F.count("*").alias("_n")), label).withColumn("density", F.col("density") / F.col("_n")).drop("_n")
    best = sums.withColumn("density", F.round("density", 9)).groupBy("pixel_id").agg(F.max_by(F.struct(label, "density"), F.struct("density", -F.col(label))).alias("b"))
    return best.select("pixel_id", f"b.{label}", "b.density")
