"""Polygons as rings: areas, hulls, buffers, Voronoi cells, overlays, and outlines of labelled grids.

A ring is an array of (x, y), first and last point not repeated. ``rings`` of a polygon are an array of such, outer ones and holes alike: inside is what an odd number of rings
encloses. Rings that are made here have their inside on the left, so their signed areas add up to the polygon's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rainfold.operators import spatial
from rainfold.operators.climatology import with_fields
from rainfold.operators.graphs import components
from rainfold.sources.scratch import written

RING = "array<struct<x:double,y:double>>"
RINGS = f"array<{RING}>"
#: Points of the circle of a buffer; decimals to which overlays are rounded.
CIRCLE, PLACES = 64, 9


def sides(ring: Column) -> Column:
    """The sides (p, q) of a ring."""
    return F.zip_with(ring, F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def signed_area(ring: Column) -> Column:
    """Positive if the inside is on the left."""
    return F.aggregate(sides(ring), F.lit(0.0), lambda s, e: s + (e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"])) / 2


def rings_area(rings: Column) -> Column:
    return F.aggregate(rings, F.lit(0.0), lambda s, r: s + signed_area(r))


def centroid(ring: Column) -> Column:
    """The centre of a ring's area; the mean of its points if it has none."""
    cross = lambda e: e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]
    total = lambda c: F.aggregate(sides(ring), F.lit(0.0), lambda s, e: s + (e["p"][c] + e["q"][c]) * cross(e))
    mean = lambda c: F.try_divide(F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[c]), F.size(ring))
    area = signed_area(ring)
    return F.struct(*(F.when(area != 0, total(c) / (6 * area)).otherwise(mean(c)).alias(c) for c in "xy"))


def hull(points: Column) -> Column:
    """Convex hull, counter-clockwise, without points along its sides.

    Points come in order of x, then y. A chain is convex, so those of its points that a new one makes concave are its last ones, and a filter removes them.
    """
    turn = lambda a, b, c: (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])
    chain = lambda ps: F.aggregate(ps, F.array().cast(RING), lambda held, p: F.concat(F.filter(held, lambda v, i: (i == 0) | (turn(F.get(held, i - 1), v, p) > 0)), F.array(p)))
    ordered = F.array_sort(F.array_distinct(points.cast(RING)))
    most = lambda c: F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))
    return F.when(F.size(ordered) < 2, ordered).otherwise(F.concat(most(chain(ordered)), most(chain(F.reverse(ordered)))))


def buffered(convex: Column, by: float) -> Column:
    """A convex ring grown by a distance; corners become arcs of a circle of CIRCLE points."""
    circle = F.array(*(F.struct(F.lit(by * math.cos(2 * math.pi * k / CIRCLE)).alias("x"), F.lit(by * math.sin(2 * math.pi * k / CIRCLE)).alias("y")) for k in range(CIRCLE)))
    return hull(F.flatten(F.transform(convex, lambda p: F.transform(circle, lambda c: F.struct((p["x"] + c["x"]).alias("x"), (p["y"] + c["y"]).alias("y"))))))


def nearer(ring: Column, own: Column, other: Column) -> Column:
    """The part of a convex ring that is nearer to ``own`` than to ``other``: it is cut along their bisector."""
    a, b = other["x"] - own["x"], other["y"] - own["y"]
    side = lambda p: a * (p["x"] - (own["x"] + other["x"]) / 2) + b * (p["y"] - (own["y"] + other["y"]) / 2)
    none = F.array().cast(RING)

    def pieces(s: Column) -> Column:
        p, q = s["p"], s["q"]
        t = F.try_divide(side(p), side(p) - side(q))
        met = F.struct((p["x"] + t * (q["x"] - p["x"])).alias("x"), (p["y"] + t * (q["y"] - p["y"])).alias("y"))
        return F.concat(F.when(side(p) <= 0, F.array(p)).otherwise(none), F.when(side(p) * side(q) < 0, F.array(met)).otherwise(none))

    return F.flatten(F.transform(sides(ring), pieces))


def voronoi(centres: DataFrame, envelopes: DataFrame, group: str, label: str) -> DataFrame:
    """``(group, label, x, y, ring)``: the part of each group's convex envelope ``(group, ring)`` that is nearest to each of its ``centres(group, label, x, y)``.

    A group's centres are one row: each cell is the envelope cut by the bisectors with the others. Of centres at one place the smallest label has the cell;
    centres without a coordinate have none.
    """
    own = centres.where("x is not null and y is not null").groupBy(group, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).agg(F.min(label).alias(label))
    row = own.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(label, "x", "y"))).alias("_centres")).join(envelopes.select(group, F.col("ring").cast(RING).alias("_ring")), group)
    others = lambda c: F.filter("_centres", lambda o: o[label] != c[label])
    cell = lambda c: F.struct(c[label].alias(label), c["x"].alias("x"), c["y"].alias("y"), F.aggregate(others(c), F.col("_ring"), lambda r, o: nearer(r, c, o)).alias("ring"))
    return row.select(group, F.inline(F.transform("_centres", cell)))


def _edges(rings: list[list[dict]]) -> np.ndarray:
    """Sides that aren't level, from their lower end to the upper one: rows of x0, y0, x1, y1."""
    own = [np.round(np.array([(p["x"], p["y"]) for p in r], float), PLACES) for r in rings if len(r) > 2]
    both = [np.hstack((r, np.roll(r, -1, axis=0))) for r in own]
    out = np.vstack(both) if both else np.empty((0, 4))
    out = out[out[:, 1] != out[:, 3]]
    return np.where((out[:, 1] > out[:, 3])[:, None], out[:, [2, 3, 0, 1]], out)


def _crossings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Heights at which sides of ``a`` and ``b`` meet."""
    out = []
    for x0, y0, x1, y1 in a:
        near = b[(b[:, 1] < y1) & (b[:, 3] > y0) & (np.minimum(b[:, 0], b[:, 2]) <= max(x0, x1)) & (np.maximum(b[:, 0], b[:, 2]) >= min(x0, x1))]
        ux, uy, vx, vy = x1 - x0, y1 - y0, near[:, 2] - near[:, 0], near[:, 3] - near[:, 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((near[:, 0] - x0) * vy - (near[:, 1] - y0) * vx) / (ux * vy - uy * vx)
        y = y0 + t * uy
        out.append(y[(t > 0) & (t < 1) & (y > near[:, 1]) & (y < near[:, 3])])
    return np.concatenate(out) if out else np.empty(0)


def traced(segments: list[tuple[float, float, float, float]]) -> list[list[tuple[float, float]]]:
    """Rings of directed segments whose inside is on the left. Where several leave a point, the sharpest left turn is taken, and a ring that comes back to one of its
    points is closed there, so each ring passes a point once."""
    leaving: dict[tuple, list[tuple]] = {}
    for x0, y0, x1, y1 in sorted(segments):
        leaving.setdefault((x0, y0), []).append((x1, y1))
    out = []
    for start in sorted(leaving):
        while leaving[start]:
            ring, place, came = [start], {start: 0}, start
            while True:
                here = ring[-1]
                back = math.atan2(came[1] - here[1], came[0] - here[0])
                way = min(leaving[here], key=lambda w: (back - math.atan2(w[1] - here[1], w[0] - here[0])) % (2 * math.pi) or 7.0)  # noqa: B023
                leaving[here].remove(way)
                came = here
                if way not in place:
                    place[way] = len(ring)
                    ring.append(way)
                    continue
                at = place[way]
                out.append(ring[at:])
                for p in ring[at + 1 :]:
                    del place[p]
                del ring[at + 1 :]
                if not at:
                    break
    return out


def simplified(ring: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Without points that are next to another one or between their neighbours. It starts at the leftmost one, which is a corner."""
    first, near = ring.index(min(ring)), 10.0 ** (1 - PLACES)
    kept: list[tuple[float, float]] = []
    for p in [*ring[first:], *ring[: first + 1]]:
        while len(kept) > 1:
            a, b = kept[-2:]
            if math.dist(b, p) > near and abs((b[0] - a[0]) * (p[1] - b[1]) - (b[1] - a[1]) * (p[0] - b[0])) > near * max(math.dist(a, b), math.dist(b, p)):
                break
            kept.pop()
        if not kept or math.dist(kept[-1], p) > near:
            kept.append(p)
    return kept[:-1] if len(kept) > 3 else []


def combined(a: list[list[dict]], b: list[list[dict]], how: str = "intersection") -> list[list[tuple[float, float]]]:
    """Rings of the intersection, difference or union of two polygons of any shape.

    Between the heights of all corners and crossings no sides meet, so a strip is made of trapezoids, and each is inside or not by counting sides. What the trapezoids
    of neighbouring strips share cancels, and the rest is traced.
    """
    wanted = {"intersection": lambda p, q: p and q, "difference": lambda p, q: p and not q, "union": lambda p, q: p or q}[how]
    ea, eb = _edges(a), _edges(b)
    edges, of_b = np.vstack((ea, eb)), np.arange(len(ea) + len(eb)) >= len(ea)
    heights = np.unique(np.round(np.concatenate((edges[:, 1], edges[:, 3], _crossings(edges, edges))), PLACES))
    segments: list[tuple[float, float, float, float]] = []
    level: dict[float, list[tuple[float, int]]] = {}
    for low, high in zip(heights[:-1].tolist(), heights[1:].tolist()):
        at = np.flatnonzero((edges[:, 1] <= low) & (edges[:, 3] >= high))
        x0, y0, x1, y1 = edges[at].T
        bottom, top = (np.round(x0 + (x1 - x0) * (y - y0) / (y1 - y0), PLACES) for y in (low, high))
        inside, left = [False, False], None
        for k in np.lexsort((top, bottom, bottom + top)).tolist():
            before = wanted(*inside)
            inside[int(of_b[at[k]])] ^= True
            if wanted(*inside) and not before:
                left = k
            elif before and not wanted(*inside):
                if (bottom[left], top[left]) == (bottom[k], top[k]):
                    continue
                segments += [(top[left], high, bottom[left], low), (bottom[k], low, top[k], high)]
                level.setdefault(low, []).extend([(bottom[left], 1), (bottom[k], -1)])
                level.setdefault(high, []).extend([(top[left], -1), (top[k], 1)])
    for y, ends in level.items():
        net, ends = 0, sorted(ends)
        for (x, change), (after, _) in zip(ends, ends[1:]):
            net += change
            if after > x:
                segments += [(x, y, after, y) if net > 0 else (after, y, x, y)] * abs(net)
    return [r for r in map(simplified, traced([tuple(map(float, s)) for s in segments])) if r]


def with_combined(pairs: DataFrame, a: str, b: str, how: str = "intersection", out: str = "rings") -> DataFrame:
    """Adds the overlay of the two polygons of each row, in tasks over batches of rows; ``a`` and ``b`` are columns of rings."""
    schema = with_fields(pairs, pairs.columns, f"{out} {RINGS}")
    kind = to_arrow_schema(schema).field(out).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [[[{"x": x, "y": y} for x, y in r] for r in combined(p or [], q or [], how)] for p, q in zip(part.column(a).to_pylist(), part.column(b).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, kind)], names=[*part.schema.names, out])

    return pairs.mapInArrow(run, schema)


def overlay(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """``(left_id, right_id, rings, area)``: the parts that polygons ``left(left_id, rings)`` and ``right(right_id, rings)`` share, if they have an area.

    Polygons of the same points are one shape, told by a digest, so each pair of shapes is cut once. Boxes around shapes, without their points, meet on tiles of ``size``; a pair counts in the
    tile of the lower left corner of what their boxes share, so it meets once. Rings are joined to the pairs afterwards, and polygons to what their shapes share.
    """
    digest = F.sha2(F.to_json(F.struct("rings")), 256)
    a, b = left.withColumn("_a_shape", digest), right.withColumn("_b_shape", digest)
    found = _overlay(*(df.select(F.col(c).alias("_shape"), "rings").distinct() for df, c in ((a, "_a_shape"), (b, "_b_shape"))), size)
    own = written(found, "overlay")
    return own.join(a.select("left_id", "_a_shape"), "_a_shape").join(b.select("right_id", "_b_shape"), "_b_shape").select("left_id", "right_id", "rings", "area")


def _overlay(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """``(_a_shape, _b_shape, rings, area)`` of the shapes ``(_shape, rings)``."""
    end = lambda f, c: f(F.transform(F.flatten("rings"), lambda p: p[c]))
    box = F.struct(*(end(f, c).alias(n) for n, f, c in (("x0", F.array_min, "x"), ("x1", F.array_max, "x"), ("y0", F.array_min, "y"), ("y1", F.array_max, "y"))))
    tile = lambda c: F.floor(c / size).cast("long")

    def tiled(df: DataFrame, key: str, name: str) -> DataFrame:
        boxes = df.select(F.col("_shape").alias(key), box.alias(name)).where(F.col(f"{name}.x0").isNotNull())
        spread = boxes.withColumn("_tx", F.explode(F.sequence(tile(F.col(f"{name}.x0")), tile(F.col(f"{name}.x1")))))
        return spread.withColumn("_ty", F.explode(F.sequence(tile(F.col(f"{name}.y0")), tile(F.col(f"{name}.y1")))))

    met = tiled(left, "_a_shape", "_a").join(tiled(right, "_b_shape", "_b"), ["_tx", "_ty"])
    corner = lambda c: F.greatest(f"_a.{c}0", f"_b.{c}0")
    met = met.where((F.col("_tx") == tile(corner("x"))) & (F.col("_ty") == tile(corner("y"))) & (corner("x") < F.least("_a.x1", "_b.x1")) & (corner("y") < F.least("_a.y1", "_b.y1")))
    rings = lambda df, key, name: df.select(F.col("_shape").alias(key), F.col("rings").alias(name))
    pairs = met.select("_a_shape", "_b_shape").join(rings(left, "_a_shape", "_left"), "_a_shape").join(rings(right, "_b_shape", "_right"), "_b_shape")
    # Cutting takes far longer than reading: few bytes make many tasks.
    pairs = pairs.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_a_shape", "_b_shape")
    return with_combined(pairs, "_left", "_right").drop("_left", "_right").withColumn("area", rings_area(F.col("rings"))).where("area > 0")


#: Cells along a side of a tile within which regions are found by one task.
TILE = 256


def _in_tile(table: pa.Table) -> pa.Table:
    """Adds ``local``: the smallest code of the cells of a tile that are joined along sides of one label."""
    places = list(zip(table.column("i").to_pylist(), table.column("j").to_pylist()))
    label = dict(zip(places, table.column("label").to_pylist()))
    codes = dict(zip(places, table.column("code").to_pylist()))
    parent = {p: p for p in places}

    def top(p: tuple) -> tuple:
        while parent[p] != p:
            parent[p] = p = parent[parent[p]]
        return p

    for (i, j), own in label.items():
        for q in ((i - 1, j), (i, j - 1)):
            if q in label and label[q] == own:
                a, b = sorted((top((i, j)), top(q)), key=codes.__getitem__)
                parent[b] = a
    return table.append_column("local", pa.array([codes[top(p)] for p in places], pa.int64()))


def regions(grid: DataFrame) -> DataFrame:
    """``(i, j, label, region)`` of the cells ``grid(i, j, label)``, one a place: the cells of one label that are joined along sides have one region, told by its smallest
    place (``j * 2**32 + i``).

    Regions are found within tiles of TILE by TILE cells, then those of neighbouring tiles are merged along the tiles' edges, as components of a graph of
    regions. A null label is a label.
    """
    tile = lambda c: F.floor(F.col(c) / TILE).cast("long")
    own = grid.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "label").withColumns({"code": F.col("j") * (1 << 32) + F.col("i"), "ti": tile("i"), "tj": tile("j")})
    local = own.groupBy("ti", "tj").applyInArrow(_in_tile, with_fields(own, own.columns, "local long"))
    edge = lambda c, at: F.pmod(F.col(c), F.lit(TILE)) == at
    pairs = []
    for a, b in (("i", "j"), ("j", "i")):
        last = local.where(edge(a, TILE - 1)).select((F.col(a) + 1).alias(a), b, F.col("label").alias("other"), F.col("local").alias("a"))
        pairs.append(last.join(local.where(edge(a, 0)).select(a, b, "label", F.col("local").alias("b")), [a, b]).where(F.col("label").eqNullSafe(F.col("other"))).select("a", "b"))
    pairs = written(pairs[0].union(pairs[1]).distinct(), "regions")
    if pairs.isEmpty():  # no region goes on beyond its tile
        return local.select("i", "j", "label", F.col("local").alias("region"))
    roots = components(pairs)
    return local.join(roots, F.col("local") == F.col("node"), "left").select("i", "j", "label", F.coalesce("root", "local").alias("region"))


def outlines(cells: DataFrame) -> DataFrame:
    """``(region, label, cells, rings)`` of ``cells(i, j, label, region)``: each region's outline and holes, in units of cells from (i, j) to (i + 1, j + 1).

    A cell's sides towards other regions are found by windows along rows and columns and put together to straight runs before they are gathered, so a region's row has its corners only.
    """
    sides_of = []
    for along, across in (("i", "j"), ("j", "i")):
        order = Window.partitionBy(along).orderBy(across)
        same = lambda f, step: (f(across).over(order) == F.col(across) + step) & (f("region").over(order) == F.col("region"))  # noqa: B023, E731
        marked = cells.select("region", "i", "j", (~F.coalesce(same(F.lag, -1), F.lit(False))).alias("_low"), (~F.coalesce(same(F.lead, 1), F.lit(False))).alias("_high"))
        line = F.array(F.when(F.col("_low"), F.struct(F.col(across).alias("at"), F.lit(0).alias("far"))), F.when(F.col("_high"), F.struct((F.col(across) + 1).alias("at"), F.lit(1).alias("far"))))
        edges = marked.select("region", F.col(along).alias("k"), F.inline(F.array_compact(line)))
        run = Window.partitionBy("region", "at", "far").orderBy("k")
        runs = edges.withColumn("_run", F.col("k") - F.row_number().over(run)).groupBy("region", "at", "far", "_run").agg(F.min("k").alias("a"), (F.max("k") + 1).alias("b"))
        # The inside is on the left: bottoms and right sides run towards larger coordinates.
        forward = (F.col("far") == 0) == (along == "i")
        p, q = F.when(forward, F.col("a")).otherwise(F.col("b")), F.when(forward, F.col("b")).otherwise(F.col("a"))
        ends = [p, F.col("at"), q, F.col("at")] if along == "i" else [F.col("at"), p, F.col("at"), q]
        sides_of.append(runs.select("region", F.struct(*(e.cast("double").alias(n) for e, n in zip(ends, ("x0", "y0", "x1", "y1")))).alias("s")))
    gathered = sides_of[0].union(sides_of[1]).groupBy("region").agg(F.collect_list("s").alias("sides"))
    counts = cells.groupBy("region").agg(F.first("label").alias("label"), F.count("*").alias("cells"))
    rows = counts.join(gathered, "region")
    schema = with_fields(rows, ["region", "label", "cells"], f"rings {RINGS}")
    kind = to_arrow_schema(schema).field("rings").type

    def run_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[[{"x": x, "y": y} for x, y in r] for r in traced([tuple(s.values()) for s in own])] for own in batch.column("sides").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("region", "label", "cells")), pa.array(found, kind)], names=["region", "label", "cells", "rings"])

    return rows.mapInArrow(run_batch, schema)


def cluster_polygons(points: DataFrame, label: str, box: tuple[float, float, float, float], n: int, bandwidth: float) -> DataFrame:
    """``(region, label, cells, rings)``: the parts of ``box`` (west, south, east, north) where the points of one label are densest, as polygons in coordinates.

    The box is a grid of ``n`` by ``n`` cells, labelled by exponential kernels at their middles; a cell that no kernel reaches takes the label of the nearest point. Cells of one label that
    are joined along sides are a polygon. Only the grid, as many cells as asked for, meets the points.
    """
    west, south, east, north = box
    dx, dy = (east - west) / n, (north - south) / n
    grid = points.sparkSession.range(n * n).select(F.col("id").alias("pixel_id"), (west + (F.col("id") % n + 0.5) * dx).alias("lon"), (south + (F.floor(F.col("id") / n) + 0.5) * dy).alias("lat"))
    known = points.select("x", "y", F.col(label).alias("_label")).where("x is not null and y is not null and _label is not null")
    found = written(spatial.densest(grid, known, "_label", bandwidth, "exponential").select("pixel_id", "_label"), "densest")
    far = written(grid.join(found, "pixel_id", "left_anti"), "far")
    if not far.isEmpty():
        sites = known.groupBy("x", "y").agg(F.min("_label").alias("pixel_id")).select(F.col("x").alias("lon"), F.col("y").alias("lat"), "pixel_id")
        near = spatial.nearest(far.withColumnRenamed("pixel_id", "_cell"), sites, "_cell")
        found = found.unionByName(near.select(F.col("_cell").alias("pixel_id"), F.col("pixel_id").alias("_label")))
    cells = found.select((F.col("pixel_id") % n).alias("i"), F.floor(F.col("pixel_id") / n).alias("j"), F.col("_label").alias("label"))
    placed = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((west + p["x"] * dx).alias("x"), (south + p["y"] * dy).alias("y"))))
    return outlines(regions(cells)).select("region", F.col("label").alias(label), "cells", placed.alias("rings"))
