"""Chunked cubes, climatologies from kept states, contracts as tables."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainfold.operators import climatology, contract
from rainfold.sources import tables


def test_chunks_are_pruned(spark, tmp_path):
    rows = [(x / 2, y / 2, date(2000 + k, 3, 1), float(x * y + k)) for x in range(-8, 9) for y in range(-4, 5) for k in range(3)] + [(None, 1.0, date(2000, 1, 1), 1.0), (1.0, 1.0, None, 1.0)]
    path, cube = str(tmp_path / "cube"), spark.createDataFrame(rows, "lon double, lat double, date date, v double")
    tables.write_chunks(cube.where("date is null or year(date) < 2002"), path, 2.0)
    with pytest.raises(ValueError):
        tables.write_chunks(cube, path, 2.0, mode="append", append_dim="lon")
    tables.write_chunks(cube.where("year(date) = 2002"), path, 2.0, mode="append", append_dim="date")
    got = tables.read_chunks(spark, path, 2.0, (-1.0, 0.5, 0.0, 1.0), "2001-01-01")
    want = sorted(r[:2] + r[3:] for r in rows if r[0] is not None and r[2] and -1 <= r[0] <= 0.5 and 0 <= r[1] <= 1 and r[2].year >= 2001)
    assert sorted((r["lon"], r["lat"], r["v"]) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "tile_x" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = got.select(F.input_file_name()).distinct().count()
    assert 0 < read < spark.read.parquet(path).select(F.input_file_name()).distinct().count() / 3


def test_states_equal_the_whole(spark, tmp_path):
    rng = random.Random(1)
    days = [date(2001, 1, 1) + timedelta(d) for d in range(365 * 3 + 100)]
    obs = spark.createDataFrame([(k, d, None if rng.random() < 0.05 else 1e6 + rng.gauss(0, 1)) for k in ("a", "b") for d in days if rng.random() < 0.995 or k == "a"], "k string, d date, v double").cache()
    path = str(tmp_path / "states")
    climatology.updated_climatology(obs.where("year(d) < 2003"), path, ["k"], "d", "v")
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "states").rglob("*.parquet")}
    # The years that are kept complete aren't taken again, whatever comes in for them.
    changed = obs.withColumn("v", F.when(F.year("d") < 2003, -1.0).otherwise(F.col("v")))
    got = climatology.updated_climatology(changed, path, ["k"], "d", "v")
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in stamps.items())
    want = {(r["k"], r["dayofyear"]): r for r in climatology.full_year_climatology(obs, ["k"], "d", "v").collect()}
    rows = {(r["k"], r["dayofyear"]): r for r in got.collect()}
    assert rows.keys() == want.keys()
    for key, r in rows.items():
        near = lambda c, tol: r[c] is want[key][c] is None or r[c] == pytest.approx(want[key][c], abs=tol)  # noqa: B023, E731
        assert near("clim", 1e-6) and near("std", 1e-6)


def test_contract_rows(spark):
    spec = {1: {"upper": {"design": "layered", "levels": {80: 0.3, 90: 0.4, 95: 0.5}}, "lower": {"design": "continuous", "levels": {20: 0.1, 5: 0.9}}}, 2: {"lower": {"design": "layered", "levels": {10: 0.4, 5: 0.5}}, "upper": {"design": "continuous", "levels": {90: 0.0, 99: 1.0}}}}
    rows = [(c, w, t, e["design"], float(k), v, 0.6 if c else None, None) for c in (0, 1) for w, tails in spec.items() for t, e in tails.items() for k, v in e["levels"].items()]
    random.Random(2).shuffle(rows)
    schema = "contract_id long, window int, tail string, design string, pct double, fraction double, target_loss_ratio double, deductions double"
    percentiles = [None, 0.0, 1.0, 5.0, 7.5, 10.0, 19.99, 20.0, 50.0, 80.0, 89.0, 90.0, 93.3, 95.0, 99.0, 100.0]
    indices = spark.createDataFrame([(c, w, p, f) for c in (0, 1, 7) for w in (1, 2, 3) for p in percentiles for f in (0, 1)], "contract_id long, window int, p double, flag_complete_window int")
    got = contract.scheduled(indices, spark.createDataFrame(rows, schema), F.col("p")).collect()
    assert len(got) == 2 * 2 * 2 * len(percentiles)
    plain = {(w, t): spark.createDataFrame([(p,) for p in percentiles], "p double").select("p", contract.payout(F.col("p"), t, e["design"], e["levels"]).alias("x")).collect() for w, tails in spec.items() for t, e in tails.items()}
    for r in got:
        want = next(x["x"] for x in plain[r["window"], r["tail"]] if x["p"] == r["p"])
        assert r["payout_pct"] == (None if want is None else pytest.approx(want, abs=1e-9))
        assert r["target_loss_ratio"] == (0.6 if r["contract_id"] else 0.74) and r["re_premium_pct"] == pytest.approx(r["pure_premium_pct"] / r["target_loss_ratio"], abs=1e-9)
    bad = spark.createDataFrame([(0, 1, "upper", "layered", 80.0, 0.5, None, None), (0, 1, "upper", "layered", 90.0, 0.4, None, None)], schema)
    with pytest.raises(Exception, match="must rise"):
        contract.scheduled(indices, bad, F.col("p")).collect()
    assert contract.scheduled(indices, spark.createDataFrame([], schema), F.col("p")).count() == 0


def test_sliding_pools():
    rng = np.random.default_rng(3)
    levels, values = rng.integers(1, 366, 500), rng.normal(size=500)
    values[::17] = np.nan
    targets = np.array([1, 2, 180, 365, 366])
    for t, pool in zip(targets, climatology.sliding(levels, values, targets, 4)):
        near = {(t + k - 1) % 365 + 1 for k in range(-4, 5)}
        want = sorted(v for lv, v in zip(levels, values) if lv in near and not np.isnan(v))
        assert pool.tolist() == want
        if len(pool):
            assert climatology.quantile_of(pool, 0.3) == pytest.approx(np.quantile(want, 0.3))
