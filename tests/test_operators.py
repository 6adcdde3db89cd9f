"""Micro-fixtures with values worked out by hand or with numpy."""

import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainfold.functions import scalars
from rainfold.operators import climatology, contract, distributions, episodes, learning, portfolio, spatial, timeops
from rainfold.plans import catalog, perils
from rainfold.sources import tables


def test_quote(spark):
    losses = [900e3, 1.2e6, 300e3, 420e3, 120e3, 180e3] + [0.0] * 24
    annual = spark.createDataFrame([("Combined", 1990 + i, x) for i, x in enumerate(losses)], "crop string, year long, loss_usd double")
    row = portfolio.quote(annual, 1.5, margin=0.2).first()
    assert row["AAL_usd"] == 104000.0
    assert row["StdDev_usd"] == pytest.approx(277843.915498091)
    assert row["technical_premium_usd"] == pytest.approx(520765.87324713654)
    assert row["commercial_premium_usd"] == pytest.approx(650957.3415589207)


def test_combined_comes_first(spark):
    annual = spark.createDataFrame([("a", 2000, 1.0), ("a", 2001, 3.0), ("b", 2000, 5.0)], "crop string, year long, loss_usd double")
    rows = portfolio.quote(portfolio.annual_losses(annual), 1.0, margin=0.0).collect()
    assert [r["crop"] for r in rows] == ["Combined", "a", "b"]
    assert rows[2]["StdDev_usd"] == 0.0  # one year


def test_ramps(spark):
    lower = {0: 1.0, 1: 1.0, 5.5: 0.5, 10: 0.0, 11: 0.0}
    upper = {89: 0.0, 90: 0.0, 94.5: 0.5, 99: 1.0, 100: 1.0}
    for tail, levels, want in (("lower", {1: 1, 10: 0}, lower), ("upper", {90: 0, 99: 1}, upper)):
        df = spark.createDataFrame([(float(p),) for p in want], "p double").select("p", contract.continuous(F.col("p"), tail, levels).alias("y"))
        assert {r["p"]: r["y"] for r in df.collect()} == {float(k): v for k, v in want.items()}


def test_layers(spark):
    df = spark.createDataFrame([(4.0,), (7.0,), (15.0,), (30.0,), (None,)], "p double").select(contract.layered(F.col("p"), "lower", {20: 0.3, 10: 0.4, 5: 0.5}).alias("y"))
    assert [r["y"] for r in df.collect()] == [0.5, 0.4, 0.3, 0.0, None]


@pytest.mark.parametrize(
    ("tail", "design", "levels", "pure", "re", "gross"),
    [
        ("upper", "continuous", {90: 0, 100: 1}, 0.05, 0.0675675676, 0.0793918919),
        ("upper", "continuous", {94: 0, 99: 1}, 0.035, 0.0472972973, 0.0555743243),
        ("upper", "layered", {80: 0.3, 90: 0.4, 95: 0.5}, 0.075, 0.1013513514, 0.1190878379),
        ("lower", "layered", {20: 0.3, 10: 0.4, 5: 0.5}, 0.075, 0.1013513514, 0.1190878379),
    ],
)
def test_rates(tail, design, levels, pure, re, gross):
    assert contract.rates(tail, design, levels, 0.74, 0.175) == pytest.approx({"pure": pure, "re": re, "gross": gross}, abs=1e-9)


@pytest.mark.parametrize(("tail", "design", "levels"), [("upper", "continuous", {1: 0, 2: 1, 3: 2}), ("upper", "layered", {80: 0.5, 90: 0.3}), ("lower", "layered", {10: 0.3, 20: 0.5}), ("side", "layered", {1: 1}), ("upper", "stepped", {1: 1}), ("upper", "layered", {})])
def test_contract_errors(tail, design, levels):
    with pytest.raises(ValueError):
        contract.validated(tail, design, levels)


def test_tiers(spark):
    rows = [(-9.0, "x"), (-5.0, "x"), (0.0, "x"), (None, "x"), (-9.0, "unknown")]
    df = spark.createDataFrame(rows, "a double, region string")
    tier = contract.tier(F.col("a"), {"P1": F.lit(-9.0), "P5": F.lit(-4.0), "P10": F.lit(-1.0)})
    out = df.select(tier.alias("t"), contract.tier_loss(tier, F.col("region"), F.lit(10.0), {"x": {"cost_max": 3, "cost_midpoint": 2, "cost_min": 1}}).alias("loss")).collect()
    assert [tuple(r) for r in out] == [("P1", 30.0), ("P5", 20.0), ("None", 0.0), ("None", 0.0), ("P1", 0.0)]


def test_repricing(spark):
    rows = [("Loan Amount", 1200.0, 1.0, 12, 0.1, None, None, 0.05, 0.0), ("Production Cost", 750.0, 1.0, None, None, 320.0, None, 0.0793918919, 0.0), ("Production Cost", 1.0, 0.5, None, None, 1.0, 100.0, 0.05, 0.0), ("Production Cost", 1.0, 0.0, None, None, 1.0, 100.0, 0.05, 0.0)]
    df = spark.createDataFrame(rows, "value_type string, value_amount double, coverage double, term int, rate double, size_ha double, target_premium double, gross_premium_pct double, payout_pct double")
    out = contract.repriced(df).collect()
    assert out[0]["insured_value"] == pytest.approx(220.0)
    assert out[1]["premium"] == pytest.approx(19054.054056)
    assert (out[2]["insured_value"], out[2]["premium"]) == pytest.approx((4000.0, 100.0))
    assert out[3]["insured_value"] is None


def test_empirical_positions(spark):
    ref = [1.0, 2.0, 2.0, 2.0, 3.0, 5.0]
    want = {0: 0.0, 1: 0.0, 1.5: 0.1, 2: 0.6, 2.5: 0.7, 3: 0.8, 5: 1.0, 6: 1.0}
    df = spark.createDataFrame([(float(x), ref) for x in want], "x double, ref array<double>").select("x", distributions.empirical_cdf(F.col("x"), F.col("ref")).alias("p"))
    assert {r["x"]: pytest.approx(r["p"]) for r in df.collect()} == {float(k): v for k, v in want.items()}
    one = spark.createDataFrame([(5.0, [1.0])], "x double, ref array<double>").select(distributions.empirical_cdf(F.col("x"), F.col("ref")).alias("p"))
    assert one.first()["p"] == 0.0


def test_runs_do_not_break_at_null(spark):
    flags = [0, 1, 1, None, 1, 0, 1]
    df = spark.createDataFrame([("a", i, f, 2.0) for i, f in enumerate(flags)], "k string, i int, flag int, intensity double")
    out = episodes.runs(df, ["k"], "i").orderBy("i").collect()
    assert [r["run"] for r in out] == [0, 1, 2, None, 3, 0, 1]
    assert [r["run_intensity"] for r in out] == [0.0, 2.0, 4.0, None, 6.0, 0.0, 2.0]


def test_season_years(spark):
    days = [date(1999, 12, 20), date(2000, 1, 10), date(2000, 2, 15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    window = ("12-15", "02-14")
    out = df.select(timeops.in_season("d", *window), timeops.season_year("d", *window, label="end"), timeops.season_year("d", *window)).collect()
    assert [tuple(r) for r in out[:2]] == [(True, 2000, 1999), (True, 2000, 1999)]
    assert not out[2][0]


def test_circular_pool_wraps_and_counts_once(spark):
    obs = spark.createDataFrame([("a", d, 1.0) for d in range(1, 367)], "k string, doy long, v double")
    pool = climatology.circular_pool(obs.select("k", "doy").where("doy in (1, 366)"), obs.withColumn("at", F.col("doy")), ["k"], "doy", 2)
    got = {}
    for r in pool.collect():
        got.setdefault(r["doy"], set()).add(r["at"])
    assert got == {1: {364, 365, 1, 2, 3}, 366: {364, 365, 1, 2, 3}}
    wide = climatology.circular_pool(obs.select("k", "doy").where("doy = 9"), obs, ["k"], "doy", 200)
    assert wide.count() == 365


def test_smoothing_wraps_on_positions(spark):
    clim = spark.createDataFrame([("a", d, float(v)) for d, v in ((1, 10), (100, 20), (200, 30), (300, 40))], "k string, dayofyear long, clim double")
    out = climatology.smooth_circular(clim, ["k"], "dayofyear", "clim", 1).orderBy("dayofyear").collect()
    assert [r["clim"] for r in out] == pytest.approx([70 / 3, 20.0, 30.0, 80 / 3])


def test_longitudes(spark):
    df = spark.createDataFrame([(359.0,), (181.0,), (180.0,)], "x double").select(spatial.wrap_longitude(F.col("x")).alias("y"))
    assert [r["y"] for r in df.collect()] == [-1.0, -179.0, -180.0]


def test_periods():
    assert [timeops.five_year_period(y) for y in (2026, 2024, 2021)] == [(1995, 2025), (1990, 2020), (1990, 2020)]


def test_polygons():
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    assert sorted(spatial.clip_ring([(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)], square)) == [(1.0, 1.0), (1.0, 2.0), (2.0, 1.0), (2.0, 2.0)]
    assert spatial.ring_area([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]) == pytest.approx(12363.7, rel=1e-3)


@pytest.mark.parametrize("leaf", [64, 3])
def test_nearest_of_crowded_and_far_cells(spark, monkeypatch, leaf):
    """Cells of any density, one 10**6 away and many at one place; points among them and far out."""
    monkeypatch.setattr(spatial, "LEAF", leaf)
    rng = random.Random(leaf)
    cells = [(i, rng.random() ** 4, rng.random() ** 3) for i in range(300)] + [(300 + i, 0.5, 0.5) for i in range(90)] + [(900, 1e6, -1e6), (901, None, 1.0)]
    points = [(i, rng.random(), rng.random()) for i in range(150)] + [(200, 5e5, 5e5), (201, -1e7, 3.0), (202, 0.5, 0.5), (203, 1.0, None)]
    tables = spark.createDataFrame(points, "id long, lon double, lat double"), spark.createDataFrame(cells, "pixel_id long, lon double, lat double")
    for k in (1, 4):
        got = {}
        for r in spatial.nearest(*tables, "id", k=k).collect():
            got.setdefault(r["id"], []).append((r["neighbor_rank"], r["pixel_id"]))
        for i, x, y in points[:-1]:
            best = sorted((math.sqrt((x - a) ** 2 + (y - b) ** 2), a, b, c) for c, a, b in cells if a is not None)[:k]
            assert sorted(got[i]) == [(n, w[3]) for n, w in enumerate(best)]
        assert 203 not in got
    met = spatial._candidates(tables[0].where("lat is not null"), tables[1].where("lon is not null").selectExpr("pixel_id", "lon as cell_lon", "lon as _x0", "lon as _x1", "lat as _y0", "lat as _y1"), "id", 1).count()
    assert met < 150 * len(points)


def test_nearest_against_all_pairs(spark):
    rng = random.Random(3)
    cells = [(i, 0.25 * rng.randrange(40), 0.25 * rng.randrange(40)) for i in range(30)] + [(30, None, 1.0)]
    points = [(i, rng.uniform(-3, 12), rng.uniform(-3, 12)) for i in range(60)] + [(60, 5000.0, -900.0), (61, None, 1.0), (62, 2.0, None)]
    tables = [spark.createDataFrame(rows, f"{key} long, lon double, lat double") for rows, key in ((points, "id"), (cells, "pixel_id"))]
    for k in (1, 3, 50):
        got = {(r["id"], r["neighbor_rank"]): (r["pixel_id"], r["distance"]) for r in spatial.nearest(*tables, "id", k=k).collect()}
        want = {}
        for i, x, y in points[:61]:
            near = sorted((math.hypot(x - cx, y - cy), cx, cy, c) for c, cx, cy in cells[:30])[:k]
            want |= {(i, n): (c, pytest.approx(d)) for n, (d, _, _, c) in enumerate(near)}
        assert got == want
    assert spatial.nearest(tables[0], tables[1].limit(0), "id").count() == spatial.nearest(tables[0].limit(0), tables[1], "id").count() == 0


@pytest.mark.parametrize("step", [0.1, 0.25, 1.0, 3.0])
def test_regridding_any_step(spark, step):
    cells = spark.createDataFrame([(i * step, j * step, float(i + j)) for i in range(12) for j in range(9) if (i, j) != (11, 8)], "lon double, lat double, v double")
    nearest = {(r["x"], r["y"]): r["v"] for r in spatial.regrid_nearest(cells, "v", step / 2.5).collect()}
    linear = {(r["x"], r["y"]): r["v"] for r in spatial.regrid_bilinear(cells, "v", step / 2.5).collect()}
    assert len(nearest) == len(linear) and max(x for x, _ in nearest) >= 11 * step
    for (x, y), v in linear.items():
        i, j = x / step, y / step
        if i < 10 and j < 7:
            assert v == pytest.approx(i + j) and nearest[x, y] == pytest.approx(math.floor(i + 0.5 + 1e-9) + math.floor(j + 0.5 + 1e-9))
        if i > 11 + 1e-9 or j > 8 + 1e-9 or (i > 10.01 and j > 7.01):
            assert v is None


def test_snapping(spark):
    axis = spark.createDataFrame([(x,) for x in (0.0, 0.1, 0.5, 7.0)], "grid double")
    points = spark.createDataFrame([(x,) for x in (-9.0, 0.04, 0.3, 0.31, 3.75, 3.76, 99.0, None)], "lon double")
    got = {r["lon"]: r["grid"] for r in spatial.snap(points, axis, "lon", "grid").collect()}
    assert got == {-9.0: 0.0, 0.04: 0.0, 0.3: 0.1, 0.31: 0.5, 3.75: 0.5, 3.76: 7.0, 99.0: 7.0, None: None}


def test_polygon_table(spark):
    rng = random.Random(4)
    ring = lambda x, y, r: [(x + r * math.cos(a), y + r * math.sin(a)) for a in (0.1, 1.2, 2.0, 3.9, 5.0)]
    polygons = {i: ring(rng.uniform(0, 40), rng.uniform(0, 40), rng.uniform(0.2, 4)) for i in range(25)}
    points = [(i, rng.uniform(-5, 45), rng.uniform(-5, 45)) for i in range(150)] + [(150, None, 1.0)]
    shapes = spark.createDataFrame(list(polygons.items()), "polygon_id long, ring array<struct<x:double,y:double>>")
    table = spark.createDataFrame(points, "id long, lon double, lat double")
    inside, far = set(), {}
    for i, x, y in points[:-1]:
        for p, r in polygons.items():
            sides, odd, least = list(zip(r, r[1:] + r[:1])), False, math.inf
            for (ax, ay), (bx, by) in sides:
                odd ^= (y < ay) != (y < by) and x < (bx - ax) * (y - ay) / (by - ay) + ax
                t = max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
                least = min(least, math.hypot(ax + t * (bx - ax) - x, ay + t * (by - ay) - y))
            if odd:
                inside.add((i, p))
            far[i] = min(far.get(i, (math.inf, 0)), (0.0 if odd else least, p))
    assert {(r["id"], r["polygon_id"]) for r in spatial.within(table, shapes).collect()} == inside
    got = {r["id"]: (r["distance"], r["polygon_id"]) for r in spatial.nearest_polygon(table, shapes, "id").collect()}
    assert got == {i: (pytest.approx(d), p) for i, (d, p) in far.items()}


def test_names_of_variables(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "t2m double, latitude double, x double")
    assert scalars.canonical(df, "tmax").columns == ["tmax", "lat", "lon"]
    for variable in ("swc", "no_such"):
        with pytest.raises(KeyError):
            scalars.canonical(df, variable)


@pytest.mark.parametrize(("dist", "params"), [("norm", {"loc": 1.0, "scale": 2.0}), ("t", {"loc": 0.0, "scale": 1.0, "df": 5.0}), ("lognorm", {"s": 0.5, "loc": -1.0, "scale": 3.0}), ("gamma", {"shape": 2.5, "loc": 0.0, "scale": 2.0}), ("weibull", {"shape": 1.7, "loc": 0.0, "scale": 3.0}), ("gev", {"shape": 0.1, "loc": 5.0, "scale": 2.0})])
def test_quantiles_invert_distribution_functions(dist, params):
    for q in (0.01, 0.1, 0.5, 0.9, 0.99):
        assert distributions.cdf_of(dist, distributions.ppf_of(dist, q, params), params) == pytest.approx(q, abs=1e-9)


def test_known_values():
    assert distributions.cdf_of("t", 2.570582, {"loc": 0, "scale": 1, "df": 5}) == pytest.approx(0.975, abs=1e-6)
    assert distributions.cdf_of("gamma", 3.0, {"shape": 1.0, "loc": 0, "scale": 1}) == pytest.approx(1 - math.exp(-3))


def test_likelihood_fits():
    rng = np.random.default_rng(1)
    lists = [np.sort(3.0 * rng.weibull(1.7, 4000)).tolist(), [1.0], [2.0, 2.0], [], [-1.0, 0.0, 4.0, 5.0], *(np.sort(rng.weibull(k, 30)).tolist() for k in (0.7, 2.0, 9.0))]
    shape, loc, scale = distributions.fit_weibull(lists)
    assert (shape[0], scale[0]) == pytest.approx((1.7, 3.0), rel=0.05) and set(loc) == {0.0}
    assert np.isnan(shape).tolist() == [False, True, True, True, False, False, False, False]
    for own, k, s in zip(lists, shape, scale):
        if not math.isnan(k):  # no other shape is likelier, at its own best scale
            x = np.array([v for v in own if v > 0])
            likely = lambda k, x=x: len(x) * math.log(k) - len(x) * math.log((x**k).mean()) + (k - 1) * np.log(x).sum()
            assert s == pytest.approx((x**k).mean() ** (1 / k)) and likely(k) >= max(likely(k * 0.999), likely(k * 1.001))
    u = rng.uniform(size=4000)
    lists = [np.sort(5 + 2 * (1 - (-np.log(u)) ** 0.1) / 0.1).tolist(), [1.0, 2.0], [3.0] * 5, *(np.sort(rng.gumbel(size=n)).tolist() for n in (3, 12, 40, 80))]
    shape, loc, scale = distributions.fit_gev(lists)
    assert (shape[0], loc[0], scale[0]) == pytest.approx((0.1, 5.0, 2.0), abs=0.15)
    assert np.isnan(shape).tolist() == [False, True, True, False, False, False, False]
    for i, own in enumerate(lists):
        one = [v[0] for v in distributions.fit_gev([own])]
        assert one == pytest.approx([shape[i], loc[i], scale[i]], nan_ok=True)  # alone as together
        if i > 3:
            at = lambda a, b, c, own=own: distributions.gev_loss(np.array([[a, b, math.log(c)]]), np.array([own]), np.ones((1, len(own)), bool))[0]
            best = at(shape[i], loc[i], scale[i])
            assert all(best <= at(shape[i] + a, loc[i] + b, scale[i] * c) + 1e-9 for a, b, c in [(1e-3, 0, 1), (-1e-3, 0, 1), (0, 1e-3, 1), (0, -1e-3, 1), (0, 0, 1.001), (0, 0, 0.999)])


def test_matching_follows_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [("a", date(1990 + i // 20, 6, 1 + i % 20), float(x)) for i, x in enumerate(rng.normal(size=200))]
    base = [(k, d, v * 2 + 1) for k, d, v in rows]
    schema = "k string, d date, v double"
    out = distributions.cdf_matching(spark.createDataFrame(rows, schema), spark.createDataFrame(base, schema), ["k"], "d", "v", 3)
    doy = np.array([r[1].timetuple().tm_yday for r in rows])
    v, b = np.array([r[2] for r in rows]), np.array([r[2] for r in base])
    got = {(r["d"], r["v"]): r["matched"] for r in out.collect()}
    for (_, day, x), own in zip(rows, doy):
        pool = abs(doy - own) <= 3
        q = (v[pool] <= x).mean()
        assert got[day, x] == pytest.approx(np.quantile(b[pool], q))


def test_matching_of_missing_values(spark):
    """A missing value stays missing, whether its day has others or not; a group or day without a base keeps its rows."""
    schema = "k string, d date, v double"
    rows = [("a", date(2000 + i, 5, 5), float(i)) for i in range(5)] + [("a", date(2001, 5, 6), None), ("a", date(2001, 5, 5), None), ("a", date(2001, 9, 9), 1.0), ("b", date(2001, 5, 5), 1.0)]
    base = [("a", date(2010 + i, 5, 5), 10.0 * i) for i in range(5)] + [("a", date(2010, 5, 4), None), ("c", date(2010, 5, 5), 1.0)]
    out = distributions.cdf_matching(spark.createDataFrame(rows, schema), spark.createDataFrame(base, schema), ["k"], "d", "v", 1)
    got = sorted((tuple(r) for r in out.select("k", "d", "v", "matched").collect()), key=str)
    assert len(got) == len(rows)
    assert {r[2]: r[3] for r in got if r[3] is not None} == {0.0: 8.0, 1.0: 16.0, 2.0: 24.0, 3.0: 32.0, 4.0: 40.0}
    assert sum(r[3] is None for r in got) == 4


def test_contract_terms():
    assert list(contract.validated("lower", "continuous", {"5": 1.0, "10": 0.1})) == [5, 10]
    spec = {"deductions": 0.2, "windows": {1: {"upper": {"design": "layered", "levels": {80: 0.3, 90: 0.4}}, "lower": {"design": "continuous", "levels": {20: 0.1, 5: 0.9}, "target_loss_ratio": 0.6}}, 2: {"deductions": 0.05, "lower": {"design": "layered", "levels": {10: 0.4}}}}}
    got = [(e["window"], e["tail"], e["target_loss_ratio"], e["deductions"], e["gross"]) for e in contract.expanded(spec, [1, 2, 3])]
    assert got == [(1, "upper", 0.74, 0.2, pytest.approx((0.3 * 0.2 + 0.1 * 0.1) / 0.74 * 1.2)), (1, "lower", 0.6, 0.2, pytest.approx((0.1 * 0.2 + 0.8 * 0.125) / 0.6 * 1.2)), (2, "lower", 0.74, 0.05, pytest.approx(0.04 / 0.74 * 1.05))]
    for bad in ({}, {"windows": {}}, {"windows": {9: spec["windows"][2]}}, {"windows": {1: {}}}, {"windows": {1: None}}, {"windows": {1: {"upper": {"levels": {80: 0.3}}}}}, {"windows": {1: {"upper": {"design": "layered"}}}}):
        with pytest.raises(ValueError):
            contract.expanded(bad, [1, 2, 3])
    with pytest.raises(ValueError):
        contract.schedule(None, [], None)


def test_distribution_arrays():
    x = np.array([0.2, 1.0, 2.5, 30.0, -1.0])
    assert distributions.cdf_of("norm", x, {"loc": np.zeros(5), "scale": np.ones(5)}) == pytest.approx([0.5 * math.erfc(-v / math.sqrt(2)) for v in x], abs=1e-14)
    assert distributions.cdf_of("beta", np.array([0.25, 0.5, 2.0]), {"a": 2.0, "b": 1.0, "loc": 0.0, "scale": 1.0}) == pytest.approx([0.0625, 0.25, 1.0])
    assert np.isnan(distributions.cdf_of("norm", x, {"loc": 0.0, "scale": np.array([0.0, np.nan, -1.0, 0.0, 0.0])})).all()


def test_components_and_clusters(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 4)) @ np.diag([5, 2, 1, 0.5]) + np.repeat(np.eye(3, 4) * 40, 20, axis=0)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i long, v array<double>")
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    want = z @ np.linalg.svd(z, full_matrices=False)[2].T[:, :2]
    got = np.array([r["components"] for r in learning.pca(df, "v", 2).orderBy("i").collect()])
    assert np.abs(got) == pytest.approx(np.abs(want), abs=1e-6)
    clusters = [r["cluster"] for r in learning.kmeans(df, "v", 3, starts=4).orderBy("i").collect()]
    assert [len(set(clusters[a : a + 20])) for a in (0, 20, 40)] == [1, 1, 1] and len(set(clusters)) == 3


def test_strict_steps(spark, tmp_path):
    obs = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "k long, hour long, v double")
    with pytest.raises(KeyError):
        climatology.looked_up(obs, spark.createDataFrame([(1, 1, 0.5)], "k long, hour long, clim double"), ["k", "hour"])
    with pytest.raises(ValueError):
        tables.write_cube(obs.withColumn("year", F.lit(1)), str(tmp_path / "cube"), "append")
    synthetic = tables.or_synthetic(spark, str(tmp_path / "none"), "2000-01-01", "2000-01-10")
    assert synthetic.count() == 20
    assert sorted(map(tuple, tables.or_synthetic(spark, str(tmp_path / "none")).collect())) == sorted(map(tuple, synthetic.collect()))


def test_gamma_of_large_shapes():
    for a in (1e4, 1e6, 1e8):
        assert distributions.gamma_p(np.array([a]), np.array([a]))[0] == pytest.approx(0.5 + 1 / (3 * math.sqrt(2 * math.pi * a)), abs=1e-6)


def test_raster_numbers_that_look_like_none(spark, tmp_path):
    spark.sql("select bigint(k) as o_custkey, bigint(k) as o_orderkey, timestamp'1995-03-02' as o_orderdate from values (65535), (65530), (7) t(k)").write.parquet(str(tmp_path / "orders.parquet"))
    got = {r["o_orderkey"]: (r["date"], r["value"]) for r in catalog.QUERIES["raster_decode"](spark, str(tmp_path)).collect()}
    assert got == {65535: (date(1995, 3, 2), 65535 * 0.001), 65530: (date(1995, 3, 2), None), 7: (date(1995, 3, 2), 7 * 0.001)}


def test_offsets_leave_no_trace(spark):
    raw = spark.range(2000).select((F.col("id") / 800).alias("own"), F.lit(0.0).alias("longitude"), F.lit(0.0).alias("latitude"), F.timestamp_seconds("id").alias("time"), (F.col("id") / 800 + 273.15).alias("2t"))
    got = perils.prepared(raw.withColumnRenamed("own", "k"), "tmin", ["k"], "time", {"offset": 273.15})
    assert got.where("k <> tmin").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_catalogue_of_any_intervals(spark):
    rng = random.Random(5)
    spans = [(i, a, a + rng.choice([0, 1, 2, 5, 30, 64, 400, 3000])) for i, a in enumerate(rng.choices(range(-40, 900), k=120))] + [(500, 10, 9), (501, None, 9)]
    day = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), F.col(c).cast("int"))
    catalogue = spark.createDataFrame(spans, "n long, x int, y int").select((F.col("n") * 37 % 121).alias("id"), "n", day("x").alias("a"), day("y").alias("b"))
    days = spark.range(-60, 1200).select("id", day("id").alias("day")).withColumnRenamed("id", "x")
    found = tables.catalogue_lookup(days, "day", catalogue, "a", "b", ["id"])
    want = {x: min(n * 37 % 121 for n, a, b in spans if a is not None and a <= x <= b) for x in range(-60, 1200) if any(a is not None and a <= x <= b for _, a, b in spans)}
    assert {r["x"]: r["id"] for r in found.collect()} == want and found.count() == len(want)
    # Entries are told apart before they meet days: no join is on the catalogue's own rows.
    assert plan_of(found).count("min(_entry") + plan_of(found).count("min(struct(") >= 3


def test_profile_without_one_large_group(spark):
    own = spark.createDataFrame([(1.0, None), (2.0, None), (2.0, None), (10.0, None)], "a double, b double").repartition(3)
    got = {r["name"]: r for r in tables.profile(own, ["a", "b"]).collect()}
    assert [got["a"][c] for c in ("n", "min", "p05", "p50", "p95", "max")] == [4, 1.0, 1.15, 2.0, 8.8, 10.0]
    assert got["b"]["n"] == 0 and got["b"]["p50"] is None
    assert "percentile(" not in plan_of(tables.profile(own, ["a", "b"]))


def test_missing_years_meet_each_year_once(spark, tmp_path):
    spark.range(1000).select(F.make_date(F.lit(1990) + F.col("id") % 3, F.lit(1), F.lit(1)).cast("timestamp").alias("l_shipdate")).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = catalog.QUERIES["missing_years_antijoin"](spark, str(tmp_path))
    assert sorted(r["year"] for r in found.collect()) == list(range(1993, 2006))
    assert "Aggregate" in plan_of(found)


def test_points_of_one_place_are_looked_for_once(spark, monkeypatch):
    """Copies of a point add rows of the result only, not of the search; ids may be missing or shared."""
    asked = []
    candidates = spatial._candidates
    monkeypatch.setattr(spatial, "_candidates", lambda points, *more: asked.append(points.count()) or candidates(points, *more))
    rng = random.Random(6)
    places = [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(7)]
    points = [(None if i == 3 else i // 2, *places[i % 7]) for i in range(400)]
    table = spark.createDataFrame(points, "id long, lon double, lat double")
    for n in (20, 150):
        cells = [(i, rng.uniform(0, 9), rng.uniform(0, 9)) for i in range(n)]
        got = spatial.nearest(table, spark.createDataFrame(cells, "pixel_id long, lon double, lat double"), "id", k=2).collect()
        want = [(i, x, y, c, r) for i, x, y in points for r, (_, c) in enumerate(sorted((math.hypot(x - a, y - b), c) for c, a, b in cells)[:2])]
        assert sorted(((r["id"], r["lon"], r["lat"], r["pixel_id"], r["neighbor_rank"]) for r in got), key=str) == sorted(want, key=str)
    assert asked == [7, 7]


def test_few_polygons_far_apart_are_left_out_by_their_boxes(spark):
    boxes = [(i, float(9 * i), 9.0 * i + 1, 0.0, 1.0) for i in range(40)]
    items = spark.createDataFrame(boxes, "polygon_id long, _x0 double, _x1 double, _y0 double, _y1 double")
    points = spark.createDataFrame([(i, 9.0 * (i % 40), 0.5) for i in range(200)], "id long, lon double, lat double")
    for k in (1, 3):
        met = spatial._candidates(points, items, "id", k).collect()
        assert len(met) <= 200 * (k + 2) and all(len({r["polygon_id"] for r in met if r["id"] == i}) >= k for i in range(200))
    assert spatial._candidates(points, items, "id", 41).count() == 200 * 40
