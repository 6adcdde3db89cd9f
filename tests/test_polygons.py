"""Polygons against points, counted cells and plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainfold.operators import graphs, learning, polygons

RINGS = "id long, rings array<array<struct<x:double,y:double>>>"


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def plain(rows):
    return [[(p["x"], p["y"]) for p in r] for r in rows]


def area(rings):
    return sum(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1])) / 2 for r in rings)


def inside(x, y, rings):
    odd = False
    for r in rings:
        for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1]):
            if (y < ay) != (y < by) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def shape(rng, n):
    """A ring that may cross itself."""
    cx, cy = rng.uniform(-2, 2), rng.uniform(-2, 2)
    return [[(cx + rng.uniform(1, 5) * math.cos(2 * math.pi * k / n), cy + rng.uniform(1, 5) * math.sin(2 * math.pi * k / n)) for k in range(n)]]


def test_overlays_agree_with_points():
    rng = random.Random(1)
    of = {"intersection": lambda p, q: p and q, "union": lambda p, q: p or q, "difference": lambda p, q: p and not q}
    for _ in range(40):
        a, b = shape(rng, rng.randint(3, 25)), shape(rng, rng.randint(3, 25))
        got = {}
        for how, wanted in of.items():
            own = got[how] = polygons.combined([ring(r) for r in a], [ring(r) for r in b], how)
            for _ in range(100):
                p = rng.uniform(-7, 7), rng.uniform(-7, 7)
                assert inside(*p, own) == wanted(inside(*p, a), inside(*p, b))
        assert area(got["union"]) == pytest.approx(area(got["intersection"]) + area(got["difference"]) + area(polygons.combined([ring(r) for r in b], [ring(r) for r in a], "difference")), abs=1e-6)
    same = [ring([(0, 0), (4, 0), (4, 4), (0, 4)]), ring([(1, 1), (1, 3), (3, 3), (3, 1)])]
    assert area(polygons.combined(same, same)) == 12 and polygons.combined(same, same, "difference") == []
    assert polygons.combined(same, []) == [] and polygons.combined([ring([(0, 0), (1, 1)])], same) == []


def test_overlay_meets_each_pair_once(spark):
    rng = random.Random(2)
    box = lambda x, y, a, b: [ring([(x, y), (x + a, y), (x + a, y + b), (x, y + b)])]
    left = [(i, box(rng.randint(0, 20), rng.randint(0, 20), rng.randint(1, 9), rng.randint(1, 9))) for i in range(25)] + [(90, None), (91, [])]
    right = [(i, box(rng.randint(0, 20), rng.randint(0, 20), rng.randint(1, 9), rng.randint(1, 9))) for i in range(25)]
    cells = lambda r: {(x, y) for x in range(40) for y in range(40) if inside(x + 0.5, y + 0.5, plain(r))}
    want = {(i, j): len(cells(a) & cells(b)) for i, a in left[:25] for j, b in right}
    name = lambda rows, c: spark.createDataFrame(rows, RINGS).withColumnRenamed("id", c)
    for size in (1.0, 3.0, 100.0):
        got = polygons.overlay(name(left, "left_id"), name(right, "right_id"), size).select("left_id", "right_id", "area").collect()
        assert {(r["left_id"], r["right_id"]): round(r["area"], 6) for r in got} == {k: n for k, n in want.items() if n} and len(got) == sum(n > 0 for n in want.values())


def test_overlay_cuts_each_pair_of_shapes_once(spark, monkeypatch):
    """Polygons of the same points are cut once, whatever their ids; each of their pairs has its row."""
    asked = []
    cut = polygons.with_combined
    monkeypatch.setattr(polygons, "with_combined", lambda pairs, *more: asked.append(pairs.count()) or cut(pairs, *more))
    corner = lambda x: [ring([(x, x), (x + 3, x), (x + 3, x + 1), (x + 1, x + 1), (x + 1, x + 3), (x, x + 3)])]
    left = [(i, corner(i % 3)) for i in range(40)] + [(90, None), (91, [])]
    right = [(i, corner(i % 2)) for i in range(30)] + [(90, None), (5, corner(20))]
    name = lambda rows, c: spark.createDataFrame(rows, RINGS).withColumnRenamed("id", c)
    cells = lambda x: {(x + k, x) for k in range(3)} | {(x, x + k) for k in range(3)}
    got = polygons.overlay(name(left, "left_id"), name(right, "right_id"), 2.0).select("left_id", "right_id", "area").collect()
    want = {(i, j): len(cells(i % 3) & cells(j % 2)) for i in range(40) for j in range(30)}
    assert {(r["left_id"], r["right_id"]): round(r["area"], 6) for r in got} == {k: n for k, n in want.items() if n} and len(got) == sum(n > 0 for n in want.values())
    assert asked[0] <= 6


def test_hulls_and_buffers(spark):
    rng = random.Random(3)
    rows = [(i, [ring([(rng.randint(0, 6), rng.randint(0, 6)) for _ in range(n)])]) for i, n in enumerate([1, 2, 3, 5, 20, 40])] + [(9, [ring([(k, 2 * k) for k in range(5)])])]
    df = spark.createDataFrame(rows, RINGS).withColumn("hull", polygons.hull(F.flatten("rings")))
    for r in df.withColumn("grown", polygons.buffered(F.col("hull"), 0.5)).withColumn("c", polygons.centroid(F.col("grown"))).collect():
        points, (own,), (grown,) = set(plain(r["rings"])[0]), plain([r["hull"]]), plain([r["grown"]])
        left = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
        assert set(own) <= points
        if len(own) > 2:
            assert all(left(a, b, p) >= 0 for a, b in zip(own, own[1:] + own[:1]) for p in points)
            around = sum(math.dist(a, b) for a, b in zip(own, own[1:] + own[:1]))
            assert area([grown]) == pytest.approx(area([own]) + 0.5 * around + math.pi * 0.25, rel=0.01)
        assert all(inside(*p, [grown]) for p in points) and inside(r["c"]["x"], r["c"]["y"], [grown])


def test_voronoi_cells(spark):
    rng = random.Random(4)
    centres = [(g, i, rng.uniform(0, 10), rng.uniform(0, 10)) for g in (1, 2) for i in range(12)] + [(1, 50, None, 1.0), (3, 1, 5.0, 5.0)]
    centres += [(1, 60, *centres[0][2:])]
    envelope = ring([(-1, -1), (11, -1), (11, 11), (-1, 11)])
    got = polygons.voronoi(spark.createDataFrame(centres, "g long, label long, x double, y double"), spark.createDataFrame([(g, envelope) for g in (1, 2, 3)], "g long, ring array<struct<x:double,y:double>>"), "g", "label").collect()
    assert {(r["g"], r["label"]) for r in got} == {c[:2] for c in centres} - {(1, 50), (1, 60)}
    for g in (1, 2, 3):
        own = {r["label"]: plain([r["ring"]]) for r in got if r["g"] == g}
        assert sum(map(area, own.values())) == pytest.approx(144)
        for _ in range(200):
            p = rng.uniform(0, 10), rng.uniform(0, 10)
            nearest = min((math.dist(p, c[2:]), c[1]) for c in centres if c[0] == g and c[2] is not None)[1]
            assert [k for k, r in own.items() if inside(*p, r)] == [nearest]


def flood(label):
    region = {}
    for start in sorted(label, key=lambda p: (p[1], p[0])):
        if start in region:
            continue
        todo = [start]
        region[start] = start
        while todo:
            i, j = todo.pop()
            for q in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                if q in label and q not in region and label[q] == label[start]:
                    region[q] = start
                    todo.append(q)
    return region


@pytest.mark.parametrize("tile", [256, 4])
def test_regions_and_outlines(spark, monkeypatch, tile):
    monkeypatch.setattr(polygons, "TILE", tile)
    rng = random.Random(5)
    label = {(i, j): rng.choice([0, 0, 1, None]) for i in range(-7, 14) for j in range(-3, 16) if rng.random() < 0.95}
    label |= {(100 + k, 0): 1 for k in range(40)}  # a long chain over many tiles
    grid = spark.createDataFrame([(i, j, v) for (i, j), v in label.items()], "i long, j long, label long")
    found = polygons.regions(grid)
    region = flood(label)
    assert {(r["i"], r["j"]): r["region"] for r in found.collect()} == {p: q[1] * (1 << 32) + q[0] for p, q in region.items()}
    for r in polygons.outlines(found).collect():
        own = {p for p, q in region.items() if q[1] * (1 << 32) + q[0] == r["region"]}
        rings = plain(r["rings"])
        assert area(rings) == r["cells"] == len(own) and label[next(iter(own))] == r["label"]
        assert {(i, j) for i, j in label if inside(i + 0.5, j + 0.5, rings)} == own
        assert all(len(set(x)) == len(x) for x in rings)


def test_components_of_a_graph(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5001 + k) for k in range(30)] + [(7, 7)]
    parent = {v: v for e in edges for v in e}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    joined = {v for a, b in edges if a != b for v in (a, b)}
    got = graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {v: top(v) for v in joined} and len(got) == len(joined)


def plain_areas(features, n_areas, n_comp, starts=12):
    """PCA and Lloyd's steps from the same starts, with numpy."""
    ids = sorted(features)
    x = np.array([features[i] for i in ids])
    std = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(std > 0, std, 1)
    w = np.linalg.eigh(z.T @ z)[1].T[::-1][:n_comp]
    pc = z @ (w * np.sign(w[np.arange(len(w)), np.abs(w).argmax(axis=1)])[:, None]).T
    best = None
    for s in range(starts):
        first = sorted(range(len(ids)), key=lambda k: (hashlib.md5(f"{s}:{ids[k]}".encode()).hexdigest(), ids[k]))[:n_areas]
        centres = {a: pc[k] for a, k in enumerate(first)}
        for _ in range(50):
            at = [min(centres, key=lambda a, p=p: (((p - centres[a]) ** 2).sum(), a)) for p in pc]
            centres = {a: pc[[k for k, o in enumerate(at) if o == a]].mean(axis=0) for a in sorted(set(at))}
        at = [min(centres, key=lambda a, p=p: (((p - centres[a]) ** 2).sum(), a)) for p in pc]
        cost = round(sum(((p - centres[a]) ** 2).sum() for p, a in zip(pc, at)), 9)
        if best is None or cost < best[0]:
            best = cost, at
    names = {a: n for n, a in enumerate(sorted(set(best[1])))}
    return {i: names[a] for i, a in zip(ids, best[1])}


def test_climate_areas(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(4, 6)) * 3
    own = {g: {1000 * g + k: (middles[k % min(4, g + 1)] + rng.normal(size=6) * 0.4).tolist() for k in range(18)} for g in (1, 2, 3, 4, 5)}
    rows = [(g, i, f) for g, of in own.items() for i, f in of.items()]
    rows += [(1, 1900, [None] * 6)]  # a pixel without values goes
    rows[-2 - 18 + 1] = (*rows[-2 - 18 + 1][:2], [None, *rows[-2 - 18 + 1][2][1:]])  # polygon 5 lacks a value and stays whole
    rows = [(g, i, [*f, None]) for g, i, f in rows]  # a feature without values goes
    pixels = spark.createDataFrame(rows, "polygon_id long, pixel_id long, features array<double>")
    sizes = spark.createDataFrame([(1, 250.0), (2, 350.0), (3, 450.0), (4, 5.0), (5, 900.0), (6, 900.0)], "polygon_id long, km2 double")
    got = {r["pixel_id"]: r["area"] for r in learning.climate_areas(pixels, sizes, 10.0, 100.0, 1, 3).collect()}
    for g, n in ((1, 2), (2, 3), (3, 4)):
        want = plain_areas(own[g], n, min(3, n))
        assert {i: got[i] for i in want} == want
    assert {got[i] for g in (4, 5) for i in own[g]} == {0} and len(got) == 90
    places = pixels.select("pixel_id", (F.col("pixel_id") % 7).cast("double").alias("lon"), (F.col("pixel_id") % 5).cast("double").alias("lat"))
    frame = [ring([(-2, -2), (8, -2), (8, 6), (-2, 6)]), ring([(1, 1), (1, 2), (2, 2), (2, 1)])]
    whole = spark.createDataFrame([(g, frame) for g in range(1, 7)], "polygon_id long, rings array<array<struct<x:double,y:double>>>")
    assigned = learning.climate_areas(pixels, sizes, 10.0, 100.0, 1, 3)
    parts = learning.area_polygons(assigned, places, whole).collect()
    for g in range(1, 7):
        mine = [r for r in parts if r["polygon_id"] == g]
        assert sum(area(plain(r["rings"])) for r in mine if len(mine) > 1) == pytest.approx(79 if len(mine) > 1 else 0, abs=1e-6)
        assert [r["name"] for r in sorted(mine, key=lambda r: r["area"])] == ([f"{g}-{k:02d}" for k in range(g + 1)] if g < 4 else [str(g)])


def test_cluster_polygons(spark):
    """Every cell of the grid is in one polygon, whose label is the densest there, or the nearest where no kernel reaches."""
    rng = random.Random(8)
    rows = [(rng.gauss(2, 0.6), rng.gauss(2, 0.6), 1) for _ in range(60)] + [(rng.gauss(6, 0.6), rng.gauss(5, 0.6), 2) for _ in range(20)] + [(None, 1.0, 1), (1.0, 1.0, None)]
    points = [r for r in rows if None not in r]
    found = polygons.cluster_polygons(spark.createDataFrame(rows, "x double, y double, kind long"), "kind", (0.0, 0.0, 9.0, 6.0), 18, 0.3).collect()
    assert sum(area(plain(r["rings"])) for r in found) == pytest.approx(54.0)
    for i in range(18):
        for j in range(18):
            x, y = (i + 0.5) * 0.5, (j + 0.5) / 3
            density = {k: sum(math.exp(-math.dist((x, y), p[:2]) / 0.3) for p in points if p[2] == k and math.dist((x, y), p[:2]) <= 2.4) / sum(p[2] == k for p in points) for k in (1, 2)}
            want = max(density, key=density.get) if max(density.values()) else min((math.dist((x, y), p[:2]), p[2]) for p in points)[1]
            assert [r["kind"] for r in found if inside(x, y, plain(r["rings"]))] == [want]
