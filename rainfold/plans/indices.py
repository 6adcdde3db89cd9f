"""Queries of seasonal indices, fits, payouts, policies and portfolio maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainfold.operators import contract, distributions, timeops
from rainfold.plans import climate, perils
from rainfold.plans.catalog import query
from rainfold.sources.tables import CELLS, OBS, cells, observations, read
from rainfold.streaming import daily

WINDOWS = {1: ("03-01", "05-31"), 2: ("12-15", "02-14")}
_W = [f"SELECT *, {w} AS \"window\", {'CASE WHEN md <= ' + str(timeops.code(b)) + ' THEN y - 1 ELSE y END' if timeops.code(b) < timeops.code(a) else 'y'} AS window_year, '{a}' AS s, '{b}' AS e, {int(timeops.code(b) < timeops.code(a))} AS cross_ FROM dated WHERE md >= {timeops.code(a)} {'OR' if timeops.code(b) < timeops.code(a) else 'AND'} md <= {timeops.code(b)}" for w, (a, b) in WINDOWS.items()]
INDEX = f"""{OBS}, dated AS (SELECT pixel_id, date, swc, CAST(year(date) AS BIGINT) AS y, month(date) * 100 + day(date) AS md FROM obs), wins AS ({' UNION ALL '.join(_W)}),
idx AS (SELECT pixel_id, "window", window_year, CAST(window_year || '-' || s AS DATE) AS start_date, CAST((window_year + cross_) || '-' || e AS DATE) AS end_date, min(date) AS first_date, max(date) AS last_date, round(coalesce(sum(swc), 0), 4) AS index_value FROM wins GROUP BY pixel_id, "window", window_year, s, e, cross_),
indices AS (SELECT *, CASE WHEN last_date >= end_date THEN 1 ELSE 0 END AS flag_complete_window FROM idx WHERE first_date <= start_date + 5)"""


def accumulated(obs: DataFrame, windows: dict, slack: int = 0) -> DataFrame:
    """Sum, first and last day of each window; dropped if its start is missing, flagged if its end is.

    ``slack``: days that the first one may come late, for series with gaps.
    """
    wide = timeops.with_windows(obs, "date", windows)
    out = wide.groupBy("pixel_id", "window", F.col("window_year").cast("long").alias("window_year"), "start_date", "end_date").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.bround(F.coalesce(F.sum("swc"), F.lit(0.0)), 4).alias("index_value"))
    return out.where(F.col("first_date") <= F.date_add("start_date", slack)).withColumn("flag_complete_window", F.when(F.col("last_date") >= F.col("end_date"), 1).otherwise(0))


def indices(spark, d) -> DataFrame:
    return accumulated(observations(spark, d), WINDOWS, 5)


_INDEX_COLUMNS = ["pixel_id", "window", "window_year", "start_date", "end_date", "last_date", "flag_complete_window"]


@query("window_accumulate", f"WITH {INDEX} SELECT pixel_id, \"window\", window_year, start_date, end_date, last_date, flag_complete_window, round(index_value, 3) AS index_value FROM indices WHERE \"window\" = 1")
def _(spark, d):
    return accumulated(observations(spark, d), {1: WINDOWS[1]}, 5).select(*_INDEX_COLUMNS, F.round("index_value", 3).alias("index_value"))


@query("window_accumulate_cross_year", f"WITH {INDEX} SELECT pixel_id, \"window\", window_year, start_date, end_date, last_date, flag_complete_window, round(index_value, 3) AS index_value FROM indices WHERE \"window\" = 2")
def _(spark, d):
    return accumulated(observations(spark, d), {2: WINDOWS[2]}, 5).select(*_INDEX_COLUMNS, F.round("index_value", 3).alias("index_value"))


@query("season_window", f"WITH {OBS} SELECT DISTINCT date, (month(date) * 100 + day(date) >= 1215 OR month(date) * 100 + day(date) <= 214) AS inside FROM obs")
def _(spark, d):
    return observations(spark, d).select("date").distinct().select("date", timeops.in_season("date", *WINDOWS[2]).alias("inside"))


@query("assign_window_year", f"WITH {OBS}, m AS (SELECT DISTINCT date, CAST(year(date) AS BIGINT) AS y, month(date) * 100 + day(date) AS md FROM obs) SELECT date, CASE WHEN md <= 214 THEN y - 1 ELSE y END AS start_label, CASE WHEN md >= 1215 THEN y + 1 ELSE y END AS end_label FROM m")
def _(spark, d):
    days = observations(spark, d).select("date").distinct()
    return days.select("date", *(timeops.season_year("date", *WINDOWS[2], label=x).cast("long").alias(f"{x}_label") for x in ("start", "end")))


KEYS = ["pixel_id", "window"]


def complete(spark, d) -> DataFrame:
    return indices(spark, d).where("flag_complete_window = 1")


_FITS = {
    "norm": "round(avg(x), 4) AS loc, round(stddev_samp(x), 4) AS scale",
    "t": "round(avg(x), 4) AS loc, round(stddev_samp(x), 4) AS scale, round(CAST(count(x) - 1 AS DOUBLE), 4) AS df",
    "norm_inf": "round(avg(x), 4) AS loc, round(stddev_samp(x) * 1.04, 4) AS scale",
    "lognorm": "round(stddev_pop(ln(x + 1)), 4) AS s, round(CAST(-1 AS DOUBLE), 4) AS loc, round(exp(avg(ln(x + 1))), 4) AS scale",
    "gamma": "round(avg(x) ** 2 / var_samp(x), 4) AS shape, round(CAST(0 AS DOUBLE), 4) AS loc, round(var_samp(x) / avg(x), 4) AS scale",
    "beta": "round(avg(x / 10000) * (avg(x / 10000) * (1 - avg(x / 10000)) / var_pop(x / 10000) - 1), 4) AS a, round((1 - avg(x / 10000)) * (avg(x / 10000) * (1 - avg(x / 10000)) / var_pop(x / 10000) - 1), 4) AS b, round(CAST(0 AS DOUBLE), 4) AS loc, round(CAST(1 AS DOUBLE), 4) AS scale",
}
for _dist, _sql in _FITS.items():

    @query(f"fit_{_dist}", f"WITH {INDEX} SELECT pixel_id, \"window\", {_sql} FROM (SELECT pixel_id, \"window\", index_value AS x FROM indices WHERE flag_complete_window = 1) GROUP BY ALL HAVING count(*) > 1")
    def _(spark, d, dist=_dist):
        own = complete(spark, d)
        own = own.withColumn("index_value", F.col("index_value") / 10000) if dist == "beta" else own
        several = own.groupBy(*KEYS).agg(F.count("*").alias("n")).where("n > 1")
        model = distributions.fit(own.join(several, KEYS, "left_semi"), KEYS, "index_value", dist)
        return model.select(*KEYS, *(F.round(c, 4).alias(c) for c in model.columns if c not in KEYS))


#: Newton's steps on the shape, forty for each group.
_NEWTON = f"""WITH RECURSIVE {INDEX}, v AS (SELECT pixel_id, "window", index_value AS x FROM indices WHERE flag_complete_window = 1 AND index_value IS NOT NULL),
g AS (SELECT pixel_id, "window", list(ln(x)) AS l, max(ln(x)) AS top, avg(ln(x)) AS mean, 1.2 / greatest(stddev_pop(ln(x)), 1e-9) AS k0 FROM v WHERE x > 0 GROUP BY ALL HAVING count(*) > 1 AND min(x) < max(x)),
it AS (
  SELECT pixel_id, "window", 0 AS i, k0 AS k FROM g
  UNION ALL SELECT pixel_id, "window", i + 1, greatest(k - (b / a - 1 / k - mean) / ((c * a - b * b) / (a * a) + 1 / (k * k)), k / 10) FROM (
    SELECT it.*, mean, list_sum(list_transform(l, lambda y: exp(k * (y - top)))) AS a, list_sum(list_transform(l, lambda y: exp(k * (y - top)) * y)) AS b, list_sum(list_transform(l, lambda y: exp(k * (y - top)) * y * y)) AS c
    FROM it JOIN g USING (pixel_id, "window") WHERE i < 40)
), f AS (SELECT pixel_id, "window", k, exp(top) * pow(list_avg(list_transform(l, lambda y: exp(k * (y - top)))), 1 / k) AS scale FROM it JOIN g USING (pixel_id, "window") WHERE i = 40)
SELECT o.pixel_id, o."window", round(k, 4) AS shape, 0.0::DOUBLE AS loc, round(scale, 3) AS scale FROM (SELECT DISTINCT pixel_id, "window" FROM v) o LEFT JOIN f USING (pixel_id, "window")"""


@query("fit_weibull", _NEWTON)
def _(spark, d):
    found = distributions.fit(complete(spark, d), KEYS, "index_value", "weibull")
    return found.select(*KEYS, F.round("shape", 4).alias("shape"), "loc", F.round("scale", 3).alias("scale"))


@query("fit_gev")
def _(spark, d):
    return distributions.fit(complete(spark, d), KEYS, "index_value", "gev")


#: Series of the distribution functions, in positive terms. m, s: mean and sample deviation of the complete windows.
_ODD = "exp((2 * k + 1) * ln(abs(z)) - lgamma(2 * k + 2) + k * ln(2) + lgamma(k + 1))"
_SERIES = {
    "norm": f"CASE WHEN z = 0 THEN 0.5 ELSE 0.5 + sign(z) * exp(-z * z / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 200), lambda k: {_ODD})) END",
    "gamma": "list_sum(list_transform(range(0, 400), lambda k: exp((m * m / (s * s) + k) * ln(x * m / (s * s)) - x * m / (s * s) - lgamma(m * m / (s * s) + k + 1))))",
    "t": "0.5 + z * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(pi() * v) * pow(1 + z * z / v, -(v + 1) / 2) * list_sum(list_transform(range(0, 4000), lambda k: exp(lgamma((v + 1) / 2 + k) - lgamma((v + 1) / 2) - lgamma(1.5 + k) + lgamma(1.5)) * pow(z * z / (v + z * z), k)))",
}
for _dist, _sql in _SERIES.items():

    @query(f"fit_{_dist}_cdf", f"WITH {INDEX}, model AS (SELECT pixel_id, \"window\", avg(index_value) AS m, stddev_samp(index_value) AS s, CAST(count(*) - 1 AS DOUBLE) AS v FROM indices WHERE flag_complete_window = 1 GROUP BY ALL HAVING count(*) > 1), o AS (SELECT pixel_id, \"window\", window_year, index_value AS x, (index_value - m) / s AS z, m, s, v FROM indices LEFT JOIN model USING (pixel_id, \"window\")) SELECT pixel_id, \"window\", window_year, round(CASE WHEN z IS NOT NULL THEN {_sql} END, 4) AS percentile FROM o")
    def _(spark, d, dist=_dist):
        found = distributions.with_cdf(indices(spark, d), distributions.fit(complete(spark, d), KEYS, "index_value", dist), KEYS, "index_value", dist, places=12)
        return found.select(*KEYS, "window_year", F.round("percentile", 4).alias("percentile"))


@query("fitted_trigger_values", f"WITH {INDEX} SELECT pixel_id, \"window\", q, round(avg(index_value) + z * stddev_samp(index_value), 3) AS trigger_value FROM indices, (VALUES (0.1::DOUBLE, -1.2815515655446004::DOUBLE), (0.5::DOUBLE, 0.0::DOUBLE), (0.99::DOUBLE, 2.3263478740408408::DOUBLE)) t(q, z) WHERE flag_complete_window = 1 GROUP BY pixel_id, \"window\", q, z")
def _(spark, d):
    model = distributions.fit(complete(spark, d), KEYS, "index_value", "norm").withColumn("q", F.explode(F.array(*map(F.lit, (0.1, 0.5, 0.99)))))
    return distributions.with_ppf(model, KEYS, "q", "norm", places=9).withColumn("trigger_value", F.round("trigger_value", 3))


@query("fit_empirical", f"WITH {INDEX} SELECT pixel_id, \"window\", count(*) AS n, round(min(index_value), 3) AS low, round(max(index_value), 3) AS high FROM indices WHERE flag_complete_window = 1 GROUP BY ALL")
def _(spark, d):
    model = distributions.fit(complete(spark, d), KEYS, "index_value", "empirical")
    return model.select(*KEYS, F.size("ref_values").cast("long").alias("n"), F.round(F.element_at("ref_values", 1), 3).alias("low"), F.round(F.element_at("ref_values", -1), 3).alias("high"))


#: Position among the complete windows' sorted values: between the last value not above x and the next one.
EMPIRICAL = f"""{INDEX}, ref AS (SELECT pixel_id, "window", index_value AS r, row_number() OVER (PARTITION BY pixel_id, "window" ORDER BY index_value) AS k, count(*) OVER (PARTITION BY pixel_id, "window") AS n, lead(index_value) OVER (PARTITION BY pixel_id, "window" ORDER BY index_value) AS nx FROM indices WHERE flag_complete_window = 1),
cnt AS (SELECT i.pixel_id, i."window", i.window_year, i.index_value AS x, i.flag_complete_window AS f, max(r.n) AS n, count(*) FILTER (r.r <= i.index_value) AS j FROM indices i LEFT JOIN ref r ON i.pixel_id = r.pixel_id AND i."window" = r."window" GROUP BY ALL),
pct AS (SELECT c.*, CASE WHEN c.n IS NULL THEN NULL WHEN j = 0 OR c.n = 1 THEN 0.0 WHEN j = c.n THEN 1.0 ELSE (j - 1 + (x - r.r) / (r.nx - r.r)) / (c.n - 1) END AS percentile FROM cnt c LEFT JOIN ref r ON c.pixel_id = r.pixel_id AND c."window" = r."window" AND r.k = c.j)"""


def with_percentile(spark, d) -> DataFrame:
    """Every window with its position among the complete ones of its group. A group has a row a year, so it is gathered and given back rather than joined."""
    own = indices(spark, d)
    rest = [c for c in own.columns if c not in KEYS]
    known = F.array_sort(F.collect_list(F.when(F.col("flag_complete_window") == 1, F.col("index_value"))))
    rows = own.groupBy(*KEYS).agg(known.alias("ref"), F.collect_list(F.struct(*rest)).alias("rows"))
    placed = rows.select(*KEYS, F.when(F.size("ref") > 0, F.col("ref")).alias("ref"), F.inline("rows"))
    return placed.withColumn("percentile", distributions.empirical_cdf(F.col("index_value"), F.col("ref"))).drop("ref")


@query("empirical_percentile", f"WITH {EMPIRICAL} SELECT pixel_id, \"window\", window_year, round(percentile, 4) AS percentile FROM pct")
def _(spark, d):
    return with_percentile(spark, d).select(*KEYS, "window_year", F.round("percentile", 4).alias("percentile"))


@query("empirical_cdf", f"WITH {EMPIRICAL} SELECT \"window\", count(*) AS n, round(avg(percentile), 4) AS mean FROM pct GROUP BY ALL")
def _(spark, d):
    return with_percentile(spark, d).groupBy("window").agg(F.count("*").alias("n"), F.round(F.avg("percentile"), 4).alias("mean"))


@query("index_values", f"WITH {EMPIRICAL} SELECT pixel_id, \"window\", window_year, round(x, 3) AS index_value, f AS flag_complete_window, round(percentile, 4) AS percentile FROM pct WHERE window_year >= 1996")
def _(spark, d):
    return with_percentile(spark, d).where("window_year >= 1996").select(*KEYS, "window_year", F.round("index_value", 3).alias("index_value"), "flag_complete_window", F.round("percentile", 4).alias("percentile"))


@query("empirical_trigger_values", f"WITH {INDEX} SELECT pixel_id, \"window\", round(quantile_cont(index_value, 0.1), 3) AS p10, round(quantile_cont(index_value, 0.9), 3) AS p90 FROM indices WHERE flag_complete_window = 1 GROUP BY ALL")
def _(spark, d):
    model = distributions.fit(complete(spark, d), KEYS, "index_value", "empirical")
    return model.select(*KEYS, *(F.round(distributions.linear_quantile(F.col("ref_values"), F.lit(q)), 3).alias(n) for q, n in ((0.1, "p10"), (0.9, "p90"))))


@query("ecdf_in_pool", f"WITH {OBS}, y AS (SELECT pixel_id, year(date) AS yr, avg(swc) AS m FROM obs GROUP BY ALL) SELECT a.pixel_id, CAST(a.yr AS BIGINT) AS year, round(count(*) FILTER (b.m <= a.m) / count(*), 6) AS q FROM y a JOIN y b ON a.pixel_id = b.pixel_id GROUP BY ALL")
def _(spark, d):
    yearly = observations(spark, d).groupBy("pixel_id", F.year("date").cast("long").alias("year")).agg(F.avg("swc").alias("m"))
    return yearly.select("pixel_id", "year", F.round(F.cume_dist().over(Window.partitionBy("pixel_id").orderBy("m")), 6).alias("q"))


CONTRACTS = {
    ("lower", "continuous"): {10: 0.0, 1: 1.0}, ("upper", "continuous"): {90: 0.0, 99: 1.0},
    ("lower", "layered"): {20: 0.3, 10: 0.4, 5: 0.5}, ("upper", "layered"): {80: 0.3, 90: 0.4, 95: 0.5},
}
_P = "round(100 * round(percentile, 4), 2)"
_RAMP = {
    ("lower", "continuous"): f"CASE WHEN {_P} > 10 THEN 0.0 WHEN {_P} <= 1 THEN 1.0 ELSE ({_P} - 10) / (1.0 - 10) END",
    ("upper", "continuous"): f"CASE WHEN {_P} < 90 THEN 0.0 WHEN {_P} >= 99 THEN 1.0 ELSE ({_P} - 90) / (99.0 - 90) END",
    ("lower", "layered"): f"CASE WHEN {_P} <= 5 THEN 0.5 WHEN {_P} <= 10 THEN 0.4 WHEN {_P} <= 20 THEN 0.3 ELSE 0.0 END",
    ("upper", "layered"): f"CASE WHEN {_P} >= 95 THEN 0.5 WHEN {_P} >= 90 THEN 0.4 WHEN {_P} >= 80 THEN 0.3 ELSE 0.0 END",
}
for (_tail, _design), _levels in CONTRACTS.items():

    @query(f"payout_{_design}_{_tail}", f"WITH {EMPIRICAL} SELECT pixel_id, \"window\", window_year, round(CAST(CASE WHEN percentile IS NOT NULL THEN {_RAMP[_tail, _design]} END AS DOUBLE), 4) AS payout FROM pct")
    def _(spark, d, tail=_tail, design=_design, levels=_levels):
        p = F.round(100 * F.round("percentile", 4), 2)
        return with_percentile(spark, d).select(*KEYS, "window_year", F.round(contract.payout(p, tail, design, levels), 4).alias("payout"))


@query("premium_rates", """WITH c AS (SELECT CAST(p_partkey AS BIGINT) AS contract_id, 10 + p_size % 10 AS a, 1 + p_size % 5 AS e, CASE WHEN p_size % 2 = 0 THEN 0.7 ELSE 0.74 END::DOUBLE AS tlr FROM part),
r AS (SELECT contract_id, 'lower' AS tail, 'continuous' AS design, 0.1 * a / 100 + 0.8 * (a + e) / 200 AS pure, tlr FROM c UNION ALL SELECT contract_id, 'upper', 'layered', 0.3 * (a + 2) / 100 + 0.2 * a / 100, tlr FROM c)
SELECT contract_id, tail, design, round(CAST(pure AS DOUBLE), 8) AS pure, round(CAST(pure AS DOUBLE) / tlr, 8) AS re, round(CAST(pure AS DOUBLE) / tlr * 1.14, 8) AS gross FROM r""")
def _(spark, d):
    """Rates of a table of contracts, one for each part."""
    a, e = 10.0 + F.col("p_size") % 10, 1.0 + F.col("p_size") % 5
    level = lambda tail, design, pct, v: F.struct(F.lit(tail).alias("tail"), F.lit(design).alias("design"), pct.alias("pct"), F.lit(v).alias("fraction"))
    levels = F.array(level("lower", "continuous", a, 0.1), level("lower", "continuous", e, 0.9), level("upper", "layered", 98 - a, 0.3), level("upper", "layered", 100 - a, 0.5))
    part = read(spark, d, "part").select(F.col("p_partkey").cast("long").alias("contract_id"), F.lit(1).alias("window"), F.inline(levels), F.when(F.col("p_size") % 2 == 0, 0.7).alias("target_loss_ratio"), F.lit(None).cast("double").alias("deductions"))
    out = contract.entries(part.select("contract_id", "window", "tail", "design", "pct", "fraction", "target_loss_ratio", "deductions"))
    return out.select("contract_id", "tail", "design", *(F.round(f"{c}_premium_pct", 8).alias(c) for c in ("pure", "re", "gross")))


def schedule(spark, d) -> DataFrame:
    """Payouts of complete windows under every contract."""
    p = F.round(100 * F.round("percentile", 4), 2)
    entries = [{"window": w, "tail": t, "design": g, "levels": own, "target_loss_ratio": 0.74, "deductions": 0.14, **contract.rates(t, g, own)} for (t, g), own in CONTRACTS.items() for w in WINDOWS]
    return contract.schedule(with_percentile(spark, d), entries, p)


_SCHEDULE = " UNION ALL ".join(f"SELECT pixel_id, \"window\", window_year, '{t}' AS tail, '{g}' AS design, CASE WHEN percentile IS NOT NULL THEN {_RAMP[t, g]} END AS payout_pct, {contract.rates(t, g, own)['gross']} AS gross_premium_pct FROM pct WHERE f = 1" for (t, g), own in CONTRACTS.items())


@query("payout_schedule", f"WITH {EMPIRICAL}, sch AS ({_SCHEDULE}) SELECT pixel_id, \"window\", window_year, tail, design, round(payout_pct, 4) AS payout_pct FROM sch")
def _(spark, d):
    return schedule(spark, d).select(*KEYS, "window_year", "tail", "design", F.round("payout_pct", 4).alias("payout_pct"))


#: A contract with terms of its own for each window and tail.
SPEC = {
    "deductions": 0.2,
    "windows": {
        1: {"upper": {"design": "layered", "levels": {80: 0.3, 90: 0.4, 95: 0.5}}, "lower": {"design": "continuous", "levels": {20: 0.1, 5: 0.9}, "target_loss_ratio": 0.6}},
        2: {"lower": {"design": "layered", "levels": {20: 0.3, 10: 0.4, 5: 0.5}, "deductions": 0.1}},
    },
}
_TERMS = [  # window, tail, design, payout, pure premium, target loss ratio, deductions
    (1, "upper", "layered", _RAMP["upper", "layered"], 0.075, 0.74, 0.2),
    (1, "lower", "continuous", f"CASE WHEN {_P} > 20 THEN 0.0 WHEN {_P} <= 5 THEN 0.9 ELSE 0.1 + ({_P} - 20) / (5.0 - 20) * 0.8 END", 0.12, 0.6, 0.2),
    (2, "lower", "layered", _RAMP["lower", "layered"], 0.075, 0.74, 0.1),
]
_TERMED = " UNION ALL ".join(f"SELECT pixel_id, \"window\", window_year, '{t}' AS tail, '{g}' AS design, CAST(CASE WHEN percentile IS NOT NULL THEN {ramp} END AS DOUBLE) AS payout_pct, CAST({pure} AS DOUBLE) AS pure, CAST({tlr} AS DOUBLE) AS tlr, CAST({ded} AS DOUBLE) AS ded FROM pct WHERE f = 1 AND \"window\" = {w}" for w, t, g, ramp, pure, tlr, ded in _TERMS)


@query("contract_schedule", f"WITH {EMPIRICAL}, sch AS ({_TERMED}) SELECT pixel_id, \"window\", window_year, tail, design, round(payout_pct, 4) AS payout_pct, round(pure, 6) AS pure_premium_pct, tlr AS target_loss_ratio, round(pure / tlr, 6) AS re_premium_pct, ded AS deductions, round(pure / tlr * (1 + ded), 6) AS gross_premium_pct FROM sch")
def _(spark, d):
    out = contract.schedule(with_percentile(spark, d), contract.expanded(SPEC, WINDOWS), F.round(100 * F.round("percentile", 4), 2))
    return out.select(*KEYS, "window_year", "tail", "design", F.round("payout_pct", 4).alias("payout_pct"), "target_loss_ratio", "deductions", *(F.round(c, 6).alias(c) for c in ("pure_premium_pct", "re_premium_pct", "gross_premium_pct")))


@query("contract_table_schedule", f"WITH {EMPIRICAL}, sch AS ({_TERMED}) SELECT pixel_id, \"window\", window_year, tail, design, round(payout_pct, 4) AS payout_pct, round(pure / tlr, 6) AS re_premium_pct, round(ded + 0.01 * n_regionkey, 6) AS deductions, round(pure / tlr * (1 + ded + 0.01 * n_regionkey), 6) AS gross_premium_pct FROM sch JOIN nation ON n_nationkey = pixel_id")
def _(spark, d):
    """A contract for each region as rows of a table, expanded by a table function in SQL; regions differ in their deductions."""
    regions = read(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("contract_id"))
    levels = [(e["window"], e["tail"], e["design"], float(k), v, e["target_loss_ratio"], e["deductions"]) for e in contract.expanded(SPEC, WINDOWS) for k, v in e["levels"].items()]
    terms = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("window", "tail", "design", "pct", "fraction", "target_loss_ratio", "deductions"), row))) for row in levels))
    contracts = regions.select("contract_id", F.inline(terms)).withColumn("deductions", F.col("deductions") + 0.01 * F.col("contract_id"))
    own = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("pixel_id"), F.col("n_regionkey").cast("long").alias("contract_id"))
    out = contract.scheduled(with_percentile(spark, d).join(own, "pixel_id"), contracts, F.round(100 * F.round("percentile", 4), 2))
    return out.select(*KEYS, "window_year", "tail", "design", F.round("payout_pct", 4).alias("payout_pct"), *(F.round(c, 6).alias(c) for c in ("re_premium_pct", "deductions", "gross_premium_pct")))


_BOUNDS = "(1, 'upper', 80, 'level', 0.3), (1, 'upper', 90, 'level', 0.4), (1, 'upper', 95, 'level', 0.5), (1, 'lower', 20, 'start', 0.1), (1, 'lower', 5, 'exit', 0.9), (2, 'lower', 5, 'level', 0.5), (2, 'lower', 10, 'level', 0.4), (2, 'lower', 20, 'level', 0.3)"
POLICY = f"""{EMPIRICAL}, sch AS ({_TERMED}), ref2 AS (SELECT pixel_id, "window", list_sort(list(index_value)) AS v FROM indices WHERE flag_complete_window = 1 GROUP BY ALL), bounds AS (SELECT * FROM (VALUES {_BOUNDS}) t("window", tail, pct, bound, payout_fraction)),
pol AS (SELECT pixel_id, "window", tail, pct, bound, CAST(payout_fraction AS DOUBLE) AS payout_fraction, v[CAST(floor((len(v) - 1) * pct / 100.0) AS INT) + 1] + coalesce(((len(v) - 1) * pct / 100.0 - floor((len(v) - 1) * pct / 100.0)) * (v[CAST(floor((len(v) - 1) * pct / 100.0) AS INT) + 2] - v[CAST(floor((len(v) - 1) * pct / 100.0) AS INT) + 1]), 0) AS trigger_value FROM ref2 JOIN bounds USING ("window"))"""


def policy(spark, d) -> DataFrame:
    model = distributions.fit(complete(spark, d), KEYS, "index_value", "empirical")
    rows = contract.policy_levels(model, contract.expanded(SPEC, WINDOWS)).withColumn("q", F.col("pct") / 100)
    return distributions.with_ppf(rows, KEYS, "q", "empirical", places=9).drop("q")


@query("policy_table", f"WITH {POLICY} SELECT pixel_id, \"window\", tail, pct, bound, payout_fraction, round(trigger_value, 3) AS trigger_value FROM pol")
def _(spark, d):
    return policy(spark, d).withColumn("trigger_value", F.round("trigger_value", 3))


@query("policy_priced", f"""WITH {POLICY}, loc AS (SELECT CAST(s_suppkey AS BIGINT) AS location_id, CAST(s_nationkey AS BIGINT) AS pixel_id, CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN 'maize' ELSE 'wheat' END AS crop, CAST(0.8 + 0.1 * (s_suppkey % 2) AS DOUBLE) AS coverage, s_acctbal * (1.0 / 12 + 0.1) AS insured_value FROM supplier),
pay AS (SELECT DISTINCT location_id, pixel_id, "window", tail, crop, coverage, insured_value FROM sch JOIN loc USING (pixel_id))
SELECT p.pixel_id, location_id, p."window", p.tail, p.pct, p.bound, loc.crop, round(pay.coverage, 4) AS coverage, round(pay.insured_value, 4) AS insured_value FROM pol p JOIN loc USING (pixel_id) LEFT JOIN pay USING (pixel_id, location_id, "window", tail, crop)""")
def _(spark, d):
    key = F.col("s_suppkey")
    crop = F.when(key % 3 == 0, None).when(key % 2 == 0, "maize").otherwise("wheat")
    places = read(spark, d, "supplier").select(key.cast("long").alias("location_id"), F.col("s_nationkey").cast("long").alias("pixel_id"), crop.alias("crop"), (0.8 + 0.1 * (key % 2)).alias("coverage"), F.lit("Loan Amount").alias("value_type"), F.col("s_acctbal").alias("value_amount"), F.lit(12).alias("term"), F.lit(0.1).alias("rate"), F.lit(None).cast("double").alias("target_premium"), F.lit(None).cast("double").alias("size_ha"))
    paid = contract.repriced(contract.schedule(with_percentile(spark, d), contract.expanded(SPEC, WINDOWS), F.round(100 * F.round("percentile", 4), 2)).join(places, "pixel_id"))
    own = policy(spark, d).join(places.select("pixel_id", "location_id"), "pixel_id")
    out = contract.priced_policy(own, places, paid, [*KEYS, "location_id"])
    return out.select("pixel_id", "location_id", "window", "tail", "pct", "bound", "crop", *(F.round(c, 4).alias(c) for c in ("coverage", "insured_value")))


_LOCATIONS = "loc AS (SELECT CAST(s_nationkey AS BIGINT) AS pixel_id, s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'Loan Amount' ELSE 'Production Cost' END AS value_type, s_acctbal AS value_amount, 0.8 AS coverage, 12 AS term, 0.1 AS rate, 50.0 AS size_ha, CASE WHEN s_suppkey % 5 = 0 THEN 100.0 END AS target_premium FROM supplier)"


def repriced(spark, d) -> DataFrame:
    key = F.col("s_suppkey")
    places = read(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("pixel_id"), "s_suppkey", F.when(key % 2 == 0, "Loan Amount").otherwise("Production Cost").alias("value_type"), F.col("s_acctbal").alias("value_amount"), F.lit(0.8).alias("coverage"), F.lit(12).alias("term"), F.lit(0.1).alias("rate"), F.lit(50.0).alias("size_ha"), F.when(key % 5 == 0, 100.0).alias("target_premium"))
    return contract.repriced(schedule(spark, d).join(places, "pixel_id"))


REPRICED = f"""{EMPIRICAL}, sch AS ({_SCHEDULE}), {_LOCATIONS}, val AS (SELECT *, CASE WHEN target_premium IS NOT NULL THEN target_premium / (coverage * gross_premium_pct) WHEN value_type = 'Loan Amount' THEN value_amount * (1.0 / term + rate) ELSE value_amount END AS insured_value, CASE WHEN value_type = 'Loan Amount' THEN 1 ELSE size_ha END AS size FROM sch JOIN loc USING (pixel_id)),
rep AS (SELECT *, insured_value * coverage * gross_premium_pct * size AS premium, insured_value * coverage * payout_pct * size AS payout FROM val)"""


@query("reprice", f"WITH {REPRICED} SELECT pixel_id, \"window\", window_year, s_suppkey, tail, design, round(insured_value, 4) AS insured_value, round(premium, 4) + 0 AS premium, round(payout, 2) + 0 AS payout FROM rep")
def _(spark, d):
    return repriced(spark, d).select(*KEYS, "window_year", "s_suppkey", "tail", "design", F.round("insured_value", 4).alias("insured_value"), F.round("premium", 4).alias("premium"), F.round("payout", 2).alias("payout"))


@query("trigger_frequency", f"WITH {REPRICED}, y AS (SELECT pixel_id, tail, design, window_year, max(CASE WHEN payout > 0 THEN 1.0 ELSE 0.0 END) AS t FROM rep GROUP BY ALL) SELECT pixel_id, tail, design, round(avg(t), 6) AS frequency FROM y GROUP BY ALL")
def _(spark, d):
    yearly = repriced(spark, d).groupBy("pixel_id", "tail", "design", "window_year").agg(F.max(F.when(F.col("payout") > 0, 1.0).otherwise(0.0)).alias("t"))
    return yearly.groupBy("pixel_id", "tail", "design").agg(F.round(F.avg("t"), 6).alias("frequency"))


@query("average_payout_map", f"WITH {REPRICED} SELECT pixel_id, tail, design, window_year, round(avg(payout), 2) AS payout FROM rep GROUP BY ALL")
def _(spark, d):
    return repriced(spark, d).groupBy("pixel_id", "tail", "design", "window_year").agg(F.round(F.avg("payout"), 2).alias("payout"))


@query("max_payout_by_year", f"WITH {REPRICED} SELECT tail, design, window_year, round(max(payout), 2) AS payout FROM rep GROUP BY ALL")
def _(spark, d):
    return repriced(spark, d).groupBy("tail", "design", "window_year").agg(F.round(F.max("payout"), 2).alias("payout"))


@query("annual_payouts", f"WITH {REPRICED} SELECT tail, design, window_year, value_type, round(sum(premium), 2) AS premium, round(sum(payout), 2) AS payout FROM rep WHERE premium IS NOT NULL GROUP BY ALL")
def _(spark, d):
    return repriced(spark, d).where("premium is not null").groupBy("tail", "design", "window_year", "value_type").agg(F.round(F.sum("premium"), 2).alias("premium"), F.round(F.sum("payout"), 2).alias("payout"))


#: Every 23rd day of a cell has no value.
_MATCH = """{obs}, d AS (SELECT pixel_id, date, CAST(dayofyear(date) AS BIGINT) AS doy, CASE WHEN (dayofyear(date) + pixel_id) % 23 > 0 THEN swc END AS swc FROM obs), s AS (SELECT * FROM d WHERE year(date) < 1998), b AS (SELECT * FROM d WHERE year(date) >= 1998),
t AS (SELECT DISTINCT pixel_id, doy FROM s), wide AS (SELECT DISTINCT pixel_id, doy, ((doy + k - 1 + 365) % 365) + 1 AS lv FROM t, range(-5, 6) r(k)),
sp AS (SELECT w.pixel_id, w.doy, list_sort(list(s.swc)) AS sv FROM wide w JOIN s ON s.pixel_id = w.pixel_id AND s.doy = w.lv WHERE s.swc IS NOT NULL GROUP BY ALL), bp AS (SELECT w.pixel_id, w.doy, list_sort(list(b.swc)) AS bv FROM wide w JOIN b ON b.pixel_id = w.pixel_id AND b.doy = w.lv WHERE b.swc IS NOT NULL GROUP BY ALL),
q AS (SELECT s.pixel_id, s.date, s.swc, sv, bv, len(list_filter(sv, lambda u: u <= s.swc)) / len(sv) AS q FROM s LEFT JOIN sp USING (pixel_id, doy) LEFT JOIN bp USING (pixel_id, doy)), h AS (SELECT *, (len(bv) - 1) * q AS h FROM q)
SELECT pixel_id, date, CASE WHEN swc IS NOT NULL AND len(sv) >= 5 AND len(bv) >= 5 THEN round(CASE WHEN floor(h) + 1 < len(bv) THEN bv[CAST(floor(h) AS INT) + 1] + (h - floor(h)) * (bv[CAST(floor(h) AS INT) + 2] - bv[CAST(floor(h) AS INT) + 1]) ELSE bv[CAST(floor(h) AS INT) + 1] END, 4) END AS matched FROM h"""


@query("cdf_matching", "WITH " + _MATCH.format(obs=OBS))
def _(spark, d):
    obs = observations(spark, d).select("pixel_id", "date", F.when((F.dayofyear("date") + F.col("pixel_id")) % 23 > 0, F.col("swc")).alias("swc"))
    out = distributions.cdf_matching(obs.where(F.year("date") < 1998), obs.where(F.year("date") >= 1998), ["pixel_id"], "date", "swc", 5)
    return out.select("pixel_id", "date", F.round("matched", 4).alias("matched"))


#: The anomalies of the blend: the later source mapped onto the base before 1998, the base from then on.
_BLENDED = _MATCH.format(obs=OBS).replace("s AS (SELECT * FROM d WHERE year(date) < 1998), b AS (SELECT * FROM d WHERE year(date) >= 1998)", "s AS (SELECT * REPLACE (swc * 1.1 + 2 AS swc) FROM d), b AS (SELECT * FROM d)").replace("SELECT pixel_id, date, CASE WHEN swc IS NOT NULL", ", m AS (SELECT pixel_id, date, CASE WHEN swc IS NOT NULL").replace("round(CASE WHEN floor(h)", "(CASE WHEN floor(h)").replace("END, 4) END AS matched FROM h", "END) END AS matched FROM h)")
_BLENDED += ", u AS (SELECT pixel_id, date, matched AS swc FROM m WHERE date < date '1998-01-01' UNION ALL SELECT pixel_id, date, swc FROM d WHERE date >= date '1998-01-01')" + climate.ANOM.removeprefix(OBS).replace("FROM obs", "FROM u")


@query("peril_blended", f"WITH {_BLENDED} SELECT pixel_id, date, round(swc, 6) AS swc, round(a, 6) AS anomaly FROM anom")
def _(spark, d):
    obs = observations(spark, d).withColumn("swc", F.when((F.dayofyear("date") + F.col("pixel_id")) % 23 > 0, F.col("swc")))
    out = perils.blended(obs, obs.withColumn("swc", F.col("swc") * 1.1 + 2), "1998-01-01", "pixel_id", "date", "swc", {"match": 5, "smooth": 7})
    return out.select("pixel_id", "date", F.round("swc", 6).alias("swc"), F.round("anomaly", 6).alias("anomaly"))


#: A recent source by location and a gridded one before it; the second is matched, and both are smoothed.
_HARMONIZED = f"""{OBS}, {CELLS}, areas AS (SELECT * FROM (VALUES ('a', -0.5::DOUBLE, -0.5::DOUBLE, 2.6::DOUBLE, 1.6::DOUBLE), ('b', 1.4::DOUBLE, 1.4::DOUBLE, 4.6::DOUBLE, 4.6::DOUBLE)) t(location_id, ax, ay, bx, by_)),
rec AS (SELECT location_id, date, round(avg(CASE WHEN pixel_id % 7 = 3 AND day(date) = 5 THEN NULL ELSE swc END), 9) AS v FROM obs JOIN cells USING (pixel_id) JOIN areas ON lon > ax AND lon < bx AND lat > ay AND lat < by_ WHERE date >= date '1997-01-01' GROUP BY ALL),
bs AS (SELECT location_id, date, avg(v) OVER (PARTITION BY location_id ORDER BY date ROWS 6 PRECEDING) AS v FROM rec),
g AS (SELECT date, lon, lat, swc * 1.1 + 2 AS v FROM obs JOIN cells USING (pixel_id) WHERE date >= date '1994-01-01'), tg AS (SELECT 0.5 * i AS x, 0.5 * j AS y, floor(0.5 * i) AS x0, ceil(0.5 * i) AS x1, floor(0.5 * j) AS y0, ceil(0.5 * j) AS y1 FROM range(9) a(i), range(9) b(j)),
c AS (SELECT x, y, x0 + p AS lon, y0 + q AS lat, (CASE WHEN x0 = x1 THEN 1 ELSE 0.5 END) * (CASE WHEN y0 = y1 THEN 1 ELSE 0.5 END) AS w, (1 + (x1 - x0)) * (1 + (y1 - y0)) AS n FROM tg, range(2) a(p), range(2) b(q) WHERE x0 + p <= x1 AND y0 + q <= y1),
fine AS (SELECT date, x, y, CASE WHEN count(v) = max(n) THEN sum(w * v) END AS v FROM c JOIN g USING (lon, lat) GROUP BY ALL),
gp AS (SELECT location_id, date, round(avg(v), 9) AS v FROM fine JOIN areas ON x > ax AND x < bx AND y > ay AND y < by_ GROUP BY ALL),
s AS (SELECT location_id AS pixel_id, date, CAST(dayofyear(date) AS BIGINT) AS doy, v AS swc FROM gp), b AS (SELECT location_id AS pixel_id, date, CAST(dayofyear(date) AS BIGINT) AS doy, v AS swc FROM bs),
""" + _MATCH[_MATCH.index("t AS (SELECT DISTINCT"):].replace("SELECT pixel_id, date, CASE WHEN swc IS NOT NULL", ", m AS (SELECT pixel_id, date, CASE WHEN swc IS NOT NULL").replace("round(CASE WHEN floor(h)", "(CASE WHEN floor(h)").replace("END, 4) END AS matched FROM h", "END) END AS matched FROM h)")
_HARMONIZED += """, u AS (SELECT pixel_id, date, matched AS v FROM m WHERE date BETWEEN date '1994-06-01' AND date '1995-12-31' OR date BETWEEN date '1996-01-01' AND date '1996-12-31' UNION ALL SELECT location_id, date, v FROM bs),
x AS (SELECT pixel_id, date, v AS original, avg(v) OVER (PARTITION BY pixel_id ORDER BY date ROWS 20 PRECEDING) AS swc FROM u)""" + climate.ANOM.removeprefix(OBS).replace("FROM obs", "FROM x")


@query("peril_planet", f"WITH {_HARMONIZED} SELECT anom.pixel_id AS location_id, anom.date, round(original, 6) AS original, round(anom.swc, 6) AS swc, round(a, 6) AS anomaly, round(CASE WHEN a < 0 THEN -a ELSE 0 * a END, 6) AS negative FROM anom JOIN x ON x.pixel_id = anom.pixel_id AND x.date = anom.date")
def _(spark, d):
    """From two raw sources with their own names and sentinel to the anomalies of two polygons."""
    raw = observations(spark, d).join(cells(spark, d), "pixel_id")
    recent = raw.select("date", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), F.when((F.col("pixel_id") % 7 == 3) & (F.day("date") == 5), 65535.0).otherwise(F.col("swc")).alias("soil_water_content"))
    gap = raw.select("date", F.col("lon").alias("x"), F.col("lat").alias("y"), (F.col("swc") * 1.1 + 2).alias("swvl1"))
    areas = spark.createDataFrame([(k, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]) for k, x0, y0, x1, y1 in (("a", -0.5, -0.5, 2.6, 1.6), ("b", 1.4, 1.4, 4.6, 4.6))], "polygon_id string, ring array<struct<x:double,y:double>>")
    params = {
        "recent": {"missing": 65535.0, "period": ("1997-01-01", None)}, "gap": {"box": (-0.5, -0.5, 4.5, 4.5), "res": 0.5, "period": ("1994-01-01", None)}, "fill": 7, "match": 5,
        "early": ("1994-06-01", "1995-12-31"), "late": ("1996-01-01", "1996-12-31"), "time_smooth": 21, "smooth": 7,
    }
    out = perils.harmonized(recent, gap, areas, "swc", "date", params)
    return out.select("location_id", "date", *(F.round(c, 6).alias(c) for c in ("original", "swc", "anomaly", "negative")))


@query("stream_daily", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(spark, d):
    return daily.replayed(spark, f"{d}/events.parquet").select("event_type", "day", "n", F.round("total", 4).alias("total"))


@query("pca")
def _(spark, d):
    from rainfold.operators import learning

    return learning.pca(read(spark, d, "embeddings"), "embedding", 4).select("vec_id", "components")


@query("kmeans")
def _(spark, d):
    from rainfold.operators import learning

    return learning.kmeans(read(spark, d, "embeddings"), "embedding", 8).select("vec_id", "cluster")


@query("annual_totals", f"WITH {REPRICED} SELECT window_year, round(sum(premium), 2) AS premium, round(sum(payout), 2) AS payout, round(median(payout), 2) AS median_payout FROM rep WHERE premium IS NOT NULL GROUP BY ALL ORDER BY window_year")
def _(spark, d):
    aggs = {"premium": F.sum("premium"), "payout": F.sum("payout"), "median_payout": F.percentile("payout", F.lit(0.5))}
    return repriced(spark, d).where("premium is not null").groupBy("window_year").agg(*(F.round(v, 2).alias(k) for k, v in aggs.items())).orderBy("window_year")


@query("payouts_with_area", f"WITH {REPRICED}, area AS (SELECT CAST(n_nationkey AS BIGINT) AS pixel_id, 100.0 + n_nationkey AS area FROM nation WHERE n_nationkey % 4 > 0) SELECT pixel_id, window_year, round(sum(payout), 2) AS payout, round(max(area), 1) AS area, round(sum(payout) / max(area), 4) AS payout_per_area FROM rep LEFT JOIN area USING (pixel_id) GROUP BY ALL")
def _(spark, d):
    area = read(spark, d, "nation").where("n_nationkey % 4 > 0").select(F.col("n_nationkey").cast("long").alias("pixel_id"), (100.0 + F.col("n_nationkey")).alias("area"))
    paid = repriced(spark, d).groupBy("pixel_id", "window_year").agg(F.sum("payout").alias("payout")).join(area, "pixel_id", "left")
    return paid.select("pixel_id", "window_year", F.round("payout", 2).alias("payout"), F.round("area", 1).alias("area"), F.round(F.col("payout") / F.col("area"), 4).alias("payout_per_area"))


@query("frequency_map", f"WITH {REPRICED}, y AS (SELECT pixel_id, window_year, max(CASE WHEN payout > 0 THEN 1.0 ELSE 0.0 END) AS t FROM rep WHERE tail = 'upper' GROUP BY ALL), f AS (SELECT pixel_id, avg(t) AS frequency FROM y GROUP BY ALL) SELECT CAST(n_nationkey AS BIGINT) AS pixel_id, n_name, round(coalesce(frequency, 0), 6) AS frequency FROM nation LEFT JOIN f ON pixel_id = n_nationkey")
def _(spark, d):
    yearly = repriced(spark, d).where("tail = 'upper'").groupBy("pixel_id", "window_year").agg(F.max(F.when(F.col("payout") > 0, 1.0).otherwise(0.0)).alias("t"))
    names = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("pixel_id"), "n_name")
    return names.join(yearly.groupBy("pixel_id").agg(F.avg("t").alias("frequency")), "pixel_id", "left").withColumn("frequency", F.round(F.coalesce("frequency", F.lit(0.0)), 6))
