"""Queries of triggers, losses, exceedance curves and quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainfold.operators import contract, portfolio, timeops
from rainfold.plans.catalog import query
from rainfold.sources.tables import LOSS, OBS, losses, observations, read

YEARS = (1995, 2000)
#: Windows by crop, and cost a hectare by region and tier; the pixel's area is 1000 ha.
CROPS = {"maize": ("09-15", "11-14"), "soy": ("12-15", "02-14"), "wheat": ("03-01", "05-31")}
COSTS = {r: {"cost_min": 100.0 + 10 * i, "cost_midpoint": 200.0 + 10 * i, "cost_max": 300.0 + 10 * i} for i, r in enumerate(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])}
LOADING, MARGIN, RATIO = 1.5, 0.2, 0.74

CLIM = f"""clim AS (SELECT pixel_id, CAST(dayofyear(date) AS BIGINT) AS day_of_year, avg(swc) AS swc_mean FROM obs
  WHERE year(date) BETWEEN {YEARS[0]} AND {YEARS[1]} GROUP BY ALL)"""


def _mmdd(day: str) -> int:
    return int(day.replace("-", ""))


def _season_sql() -> str:
    parts = []
    for crop, (a, b) in CROPS.items():
        lo, hi = _mmdd(a), _mmdd(b)
        cross = hi < lo
        inside = f"(md >= {lo} {'OR' if cross else 'AND'} md <= {hi})"
        year = f"CASE WHEN md >= {lo} THEN y + 1 ELSE y END" if cross else "y"
        parts.append(f"SELECT '{crop}' AS crop, {year} AS year, * EXCLUDE (y, md) FROM dated WHERE {inside}")
    return " UNION ALL ".join(parts)


ANOMALIES = f"""{OBS}, {CLIM}, dated AS (SELECT o.*, o.swc - c.swc_mean AS anomaly, CAST(year(date) AS BIGINT) AS y, month(date) * 100 + day(date) AS md
  FROM obs o LEFT JOIN clim c ON o.pixel_id = c.pixel_id AND dayofyear(o.date) = c.day_of_year), seasons AS ({_season_sql()}),
sums AS (SELECT crop, year, pixel_id, zona, region, has, coalesce(sum(anomaly), 0) AS anomaly_sum FROM seasons GROUP BY ALL)"""
PERCENTILES = "pct AS (SELECT crop, pixel_id, quantile_cont(anomaly_sum, 0.01) AS P1, quantile_cont(anomaly_sum, 0.05) AS P5, quantile_cont(anomaly_sum, 0.1) AS P10 FROM sums GROUP BY ALL)"


def _cost_sql() -> str:
    whens = [f"WHEN region = '{r}' AND tier = '{t}' THEN {own[f]}" for r, own in COSTS.items() for t, f in contract.TIERS]
    return "CASE " + " ".join(whens) + " ELSE 0.0 END"


LOSSES = f"""{ANOMALIES}, {PERCENTILES}, tiers AS (SELECT s.*, P1, P5, P10, CASE WHEN anomaly_sum <= P1 THEN 'P1' WHEN anomaly_sum <= P5 THEN 'P5' WHEN anomaly_sum <= P10 THEN 'P10' ELSE 'None' END AS tier
  FROM sums s LEFT JOIN pct USING (crop, pixel_id)), lossy AS (SELECT *, has * ({_cost_sql()}) AS loss_usd FROM tiers)"""
ANNUAL = f"""{LOSSES}, annual AS (SELECT CASE WHEN grouping(crop) = 1 THEN 'Combined' ELSE crop END AS crop, year, sum(loss_usd) AS loss_usd
  FROM lossy GROUP BY GROUPING SETS ((crop, year), (year)))"""


def with_climatology(obs: DataFrame) -> DataFrame:
    """Each day with the mean of its day of the year over the base years, by a window: the observations are read once."""
    own = Window.partitionBy("pixel_id", "day_of_year")
    mean = F.avg(F.when(F.year("date").between(*YEARS), F.col("swc"))).over(own)
    return obs.withColumn("day_of_year", F.dayofyear("date").cast("long")).withColumn("swc_mean", mean)


def anomaly_sums(spark, d) -> DataFrame:
    """Seasonal sums of anomalies by crop, campaign year (that of the window's end) and pixel."""
    anomalies = with_climatology(observations(spark, d)).withColumn("anomaly", F.col("swc") - F.col("swc_mean"))
    seasons = [F.when(timeops.in_season("date", a, b), F.struct(F.lit(c).alias("crop"), timeops.season_year("date", a, b, "end").cast("long").alias("year"))) for c, (a, b) in CROPS.items()]
    wide = anomalies.select("*", F.inline(F.array_compact(F.array(*seasons))))
    return wide.groupBy("crop", "year", "pixel_id", "zona", "region", "has").agg(F.coalesce(F.sum("anomaly"), F.lit(0.0)).alias("anomaly_sum"))


def percentiles(sums: DataFrame) -> DataFrame:
    three = F.percentile("anomaly_sum", F.array(F.lit(0.01), F.lit(0.05), F.lit(0.1)))
    return sums.groupBy("crop", "pixel_id").agg(three.alias("p")).select("crop", "pixel_id", *(F.col("p")[i].alias(n) for i, n in enumerate(("P1", "P5", "P10"))))


def with_percentiles(sums: DataFrame) -> DataFrame:
    """The sums with the percentiles of their crop and pixel. A group has a row a year, so it is gathered and given back rather than joined."""
    three = F.percentile("anomaly_sum", F.array(F.lit(0.01), F.lit(0.05), F.lit(0.1)))
    rest = [c for c in sums.columns if c not in ("crop", "pixel_id")]
    rows = sums.groupBy("crop", "pixel_id").agg(three.alias("p"), F.collect_list(F.struct(*rest)).alias("rows"))
    return rows.select("crop", "pixel_id", *(F.col("p")[i].alias(n) for i, n in enumerate(("P1", "P5", "P10"))), F.inline("rows"))


def tier_losses(spark, d) -> DataFrame:
    tiered = with_percentiles(anomaly_sums(spark, d)).withColumn("tier", contract.tier(F.col("anomaly_sum"), {n: F.col(n) for n, _ in contract.TIERS}))
    return tiered.withColumn("loss_usd", contract.tier_loss(F.col("tier"), F.col("region"), F.col("has"), COSTS))


def annual(spark, d) -> DataFrame:
    return portfolio.annual_losses(tier_losses(spark, d))


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


@query("join_climatology", f"WITH {OBS}, {CLIM} SELECT o.pixel_id, o.date, round(o.swc - c.swc_mean, 6) AS anomaly FROM obs o LEFT JOIN clim c ON o.pixel_id = c.pixel_id AND dayofyear(o.date) = c.day_of_year")
def _(spark, d):
    return with_climatology(observations(spark, d)).select("pixel_id", "date", F.round(F.col("swc") - F.col("swc_mean"), 6).alias("anomaly"))


@query("seasonal_anomaly_sum", f"WITH {ANOMALIES} SELECT crop, year, pixel_id, zona, region, has, round(anomaly_sum, 6) AS anomaly_sum FROM sums")
def _(spark, d):
    return rounded(anomaly_sums(spark, d), "anomaly_sum")


@query("group_percentiles", f"WITH {ANOMALIES}, {PERCENTILES} SELECT crop, pixel_id, round(P1, 6) AS P1, round(P5, 6) AS P5, round(P10, 6) AS P10 FROM pct")
def _(spark, d):
    return rounded(percentiles(anomaly_sums(spark, d)), "P1", "P5", "P10")


@query("join_percentiles", f"WITH {ANOMALIES}, {PERCENTILES} SELECT crop, year, pixel_id, round(anomaly_sum - P5, 6) AS above_p5 FROM sums LEFT JOIN pct USING (crop, pixel_id)")
def _(spark, d):
    return with_percentiles(anomaly_sums(spark, d)).select("crop", "year", "pixel_id", F.round(F.col("anomaly_sum") - F.col("P5"), 6).alias("above_p5"))


@query("triggers_and_losses", f"WITH {LOSSES} SELECT crop, year, zona, pixel_id, tier, loss_usd, region, has, round(anomaly_sum, 6) AS anomaly_sum FROM lossy")
def _(spark, d):
    return rounded(tier_losses(spark, d), "anomaly_sum").select("crop", "year", "zona", "pixel_id", "tier", "loss_usd", "region", "has", "anomaly_sum")


@query("annual_losses_grouping_sets", f"WITH {ANNUAL} SELECT crop, year, round(loss_usd, 4) AS loss_usd FROM annual")
def _(spark, d):
    return rounded(annual(spark, d), "loss_usd", places=4)


QUOTE = """SELECT crop, round(a, 4) AS AAL_usd, round(s, 4) AS StdDev_usd, round(a + 1.5 * s, 4) AS technical_premium_usd, round((a + 1.5 * s) / {c}, 4) AS commercial_premium_usd
FROM (SELECT crop, avg(loss_usd) AS a, coalesce(stddev_samp(loss_usd), 0) AS s FROM annual GROUP BY crop)"""
_QUOTED = ("AAL_usd", "StdDev_usd", "technical_premium_usd", "commercial_premium_usd")


@query("pricing_quote", f"WITH {ANNUAL} {QUOTE.format(c='(1 - 0.2)')}")
def _(spark, d):
    return rounded(portfolio.quote(annual(spark, d), LOADING, margin=MARGIN), *_QUOTED, places=4)


@query("pricing_quote_loss_ratio", f"WITH {LOSS}, annual AS (SELECT CASE WHEN grouping(crop) = 1 THEN 'Combined' ELSE crop END AS crop, year, sum(loss_usd) AS loss_usd FROM loss GROUP BY GROUPING SETS ((crop, year), (year))) {QUOTE.format(c='0.74')}")
def _(spark, d):
    return rounded(portfolio.quote(portfolio.annual_losses(losses(spark, d)), LOADING, loss_ratio=RATIO), *_QUOTED, places=4)


_AEP = "SELECT crop, year, row_number() OVER (PARTITION BY crop ORDER BY loss_usd DESC, year) AS rank, count(*) OVER (PARTITION BY crop) AS n, loss_usd FROM {t}"


@query("aep_historical", f"WITH {LOSS}, r AS ({_AEP.format(t='loss')}) SELECT crop, rank, round(n / rank, 6) AS return_period_years, round(rank / n, 6) AS exceedance_probability, round(loss_usd, 4) AS loss_usd FROM r")
def _(spark, d):
    out = portfolio.exceedance(losses(spark, d)).select("crop", "rank", F.round("return_period_years", 6).alias("return_period_years"), F.round("exceedance_probability", 6).alias("exceedance_probability"), "loss_usd")
    return rounded(out, "loss_usd", places=4)


@query("aep_plotting_position", f"WITH {LOSS}, r AS ({_AEP.format(t='loss')}) SELECT crop, rank, round(rank / (n + 1), 6) AS exceedance_probability, round(loss_usd, 4) AS loss_usd FROM r")
def _(spark, d):
    out = portfolio.exceedance(losses(spark, d), plotting=True).select("crop", "rank", F.round("exceedance_probability", 6).alias("exceedance_probability"), "loss_usd")
    return rounded(out, "loss_usd", places=4)


def _lcg(draw, n):
    """A linear congruential index, which SQL can repeat."""
    return F.pmod((draw * 1103515245 + 12345) % 2147483648, n)


@query("bootstrap_lcg", f"""WITH {LOSS}, y AS (SELECT crop, loss_usd, row_number() OVER (PARTITION BY crop ORDER BY year) - 1 AS i, count(*) OVER (PARTITION BY crop) AS n FROM loss),
drawn AS (SELECT y.crop, g.draw, y.loss_usd FROM range(1000) g(draw) JOIN y ON y.i = ((g.draw * 1103515245 + 12345) % 2147483648) % y.n), r AS (SELECT crop, loss_usd, row_number() OVER (PARTITION BY crop ORDER BY loss_usd DESC, draw) AS rank FROM drawn)
SELECT crop, rank, round(1000.0 / rank, 6) AS return_period_years, round(rank / 1000, 6) AS exceedance_probability, round(loss_usd, 4) AS loss_usd FROM r""")
def _(spark, d):
    return rounded(rounded(portfolio.bootstrap(losses(spark, d), 1000, _lcg), "loss_usd", places=4), "return_period_years", "exceedance_probability")


@query("aep_chart", f"""WITH {LOSS}, y AS (SELECT crop, loss_usd, row_number() OVER (PARTITION BY crop ORDER BY year) - 1 AS i, count(*) OVER (PARTITION BY crop) AS n FROM loss),
drawn AS (SELECT y.crop, g.draw, y.loss_usd FROM range(1000) g(draw) JOIN y ON y.i = ((g.draw * 1103515245 + 12345) % 2147483648) % y.n), r AS (SELECT crop, loss_usd, row_number() OVER (PARTITION BY crop ORDER BY loss_usd DESC, draw) AS rank FROM drawn),
k AS (SELECT *, row_number() OVER (PARTITION BY crop ORDER BY rank) - 1 AS i, count(*) OVER (PARTITION BY crop) AS m FROM r WHERE rank / 1000 BETWEEN 0.001 AND 0.3)
SELECT crop, rank, round(rank / 1000, 6) AS exceedance_probability, round(loss_usd, 4) AS loss_usd FROM k WHERE i % greatest(1, m // 80) = 0""")
def _(spark, d):
    """The points that a chart of the curve shows."""
    curve = portfolio.thinned(portfolio.bootstrap(losses(spark, d), 1000, _lcg)).drop("return_period_years")
    return rounded(rounded(curve, "loss_usd", places=4), "exceedance_probability")


@query("qa_pricing", f"WITH {ANNUAL}, q AS ({QUOTE.format(c='(1 - 0.2)')}) SELECT count(*) FILTER (AAL_usd < 0) AS negative_aal, count(*) FILTER (commercial_premium_usd < AAL_usd) AS premium_below_aal, count(*) FILTER (AAL_usd IS NULL OR commercial_premium_usd IS NULL) AS missing FROM q")
def _(spark, d):
    """Rules that a quote must keep, with the number of rows that break each."""
    quote = portfolio.quote(annual(spark, d), LOADING, margin=MARGIN)
    below = F.col("commercial_premium_usd") < F.col("AAL_usd")
    return quote.agg(F.count_if(F.col("AAL_usd") < 0).alias("negative_aal"), F.count_if(below).alias("premium_below_aal"), F.count_if(F.col("AAL_usd").isNull() | F.col("commercial_premium_usd").isNull()).alias("missing"))


@query("bootstrap_aep")
def _(spark, d):
    seeded = lambda draw, n: F.pmod(F.xxhash64(F.lit(42), "crop", draw), n)
    return portfolio.bootstrap(portfolio.annual_losses(losses(spark, d)), 10_000, seeded)


@query("aep_thin", f"WITH {LOSS}, r AS ({_AEP.format(t='loss')}), k AS (SELECT *, row_number() OVER (PARTITION BY crop ORDER BY rank) - 1 AS i, count(*) OVER (PARTITION BY crop) AS m FROM r WHERE rank / n BETWEEN 0.001 AND 0.9) SELECT crop, rank, round(loss_usd, 4) AS loss_usd FROM k WHERE i % greatest(1, m // 3) = 0")
def _(spark, d):
    curve = portfolio.exceedance(losses(spark, d)).where(F.col("exceedance_probability").between(0.001, 0.9))
    own = Window.partitionBy("crop")
    placed = curve.withColumns({"_i": F.row_number().over(own.orderBy("rank")) - 1, "_m": F.count("*").over(own)})
    return rounded(placed.where(F.col("_i") % F.greatest(F.lit(1), F.floor(F.col("_m") / 3)) == 0).select("crop", "rank", "loss_usd"), "loss_usd", places=4)


@query("loss_trend", f"WITH {LOSS} SELECT crop, round(regr_slope(loss_usd, year), 2) AS slope, round(corr(loss_usd, year), 6) AS r FROM loss GROUP BY crop")
def _(spark, d):
    return portfolio.trend(losses(spark, d), ["crop"], F.col("loss_usd"), F.col("year")).select("crop", F.round("slope", 2).alias("slope"), F.round("r", 6).alias("r"))


@query("loss_trend_excl", f"WITH {LOSS} SELECT crop, round(regr_slope(loss_usd, year), 2) AS slope, round(corr(loss_usd, year), 6) AS r FROM loss WHERE year <> 2001 GROUP BY crop")
def _(spark, d):
    return portfolio.trend(losses(spark, d).where("year <> 2001"), ["crop"], F.col("loss_usd"), F.col("year")).select("crop", F.round("slope", 2).alias("slope"), F.round("r", 6).alias("r"))


_T = "2 * (0.5 - abs(t) * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(pi() * v) * pow(1 + t * t / v, -(v + 1) / 2) * list_sum(list_transform(range(0, 4000), lambda k: exp(lgamma((v + 1) / 2 + k) - lgamma((v + 1) / 2) - lgamma(1.5 + k) + lgamma(1.5)) * pow(t * t / (v + t * t), k))))"


@query("loss_trend_significance", f"WITH {LOSS}, l AS (SELECT crop, CAST(count(*) - 2 AS DOUBLE) AS v, regr_slope(loss_usd, year) AS slope, regr_intercept(loss_usd, year) AS intercept, corr(loss_usd, year) AS r FROM loss GROUP BY crop), t AS (SELECT *, r * sqrt(v / (1 - r * r)) AS t FROM l) SELECT crop, round(slope, 2) AS slope, round(intercept, 0) AS intercept, round(r, 6) AS r, round({_T}, 6) AS p FROM t")
def _(spark, d):
    line = portfolio.trend(losses(spark, d), ["crop"], F.col("loss_usd"), F.col("year"))
    return portfolio.with_significance(line).select("crop", F.round("slope", 2).alias("slope"), F.round("intercept", 0).alias("intercept"), F.round("r", 6).alias("r"), F.round("p", 6).alias("p"))


@query("head_of_quotes", f"WITH {LOSS}, annual AS (SELECT CASE WHEN grouping(crop) = 1 THEN 'Combined' ELSE crop END AS crop, year, sum(loss_usd) AS loss_usd FROM loss GROUP BY GROUPING SETS ((crop, year), (year))) SELECT crop, year, round(loss_usd, 4) AS loss_usd FROM annual ORDER BY loss_usd DESC, crop, year LIMIT 8")
def _(spark, d):
    """The eight worst years, a report's head."""
    return rounded(portfolio.annual_losses(losses(spark, d)).orderBy(F.desc("loss_usd"), "crop", "year").limit(8), "loss_usd", places=4)


@query("crop_correlation", f"""WITH {LOSS}, f AS (SELECT c.crop, y.year, coalesce(loss_usd, 0) AS v FROM (SELECT DISTINCT crop FROM loss) c CROSS JOIN (SELECT DISTINCT year FROM loss) y LEFT JOIN loss USING (crop, year))
SELECT a.crop AS crop_a, b.crop AS crop_b, round(coalesce(corr(a.v, b.v), 0), 6) AS r FROM f a JOIN f b ON a.year = b.year GROUP BY ALL""")
def _(spark, d):
    return rounded(portfolio.correlation(losses(spark, d)), "r")


@query("pivot_losses", f"WITH {LOSS} SELECT year, round(coalesce(sum(loss_usd) FILTER (crop = 'A'), 0), 4) AS A, round(coalesce(sum(loss_usd) FILTER (crop = 'N'), 0), 4) AS N, round(coalesce(sum(loss_usd) FILTER (crop = 'R'), 0), 4) AS R FROM loss GROUP BY year")
def _(spark, d):
    return rounded(losses(spark, d).groupBy("year").pivot("crop", ["A", "N", "R"]).agg(F.sum("loss_usd")).fillna(0), "A", "N", "R", places=4)


@query("reindex_years", f"WITH {LOSS}, c AS (SELECT DISTINCT crop FROM loss) SELECT c.crop, CAST(g.y AS BIGINT) AS year, round(coalesce(loss_usd, 0), 4) AS loss_usd FROM c CROSS JOIN range(1990, 2006) g(y) LEFT JOIN loss ON loss.crop = c.crop AND loss.year = g.y")
def _(spark, d):
    own = losses(spark, d)
    years = own.select("crop").distinct().withColumn("year", F.explode(F.sequence(F.lit(1990).cast("long"), F.lit(2005).cast("long"))))
    return rounded(years.join(own, ["crop", "year"], "left").fillna(0, ["loss_usd"]), "loss_usd", places=4)


@query("describe_losses", f"WITH {LOSS} SELECT crop, count(*) AS n, round(avg(loss_usd), 2) AS mean, round(stddev_samp(loss_usd), 2) AS std, round(min(loss_usd), 2) AS min, round(quantile_cont(loss_usd, 0.25), 2) AS p25, round(quantile_cont(loss_usd, 0.5), 2) AS p50, round(quantile_cont(loss_usd, 0.75), 2) AS p75, round(max(loss_usd), 2) AS max FROM loss GROUP BY crop")
def _(spark, d):
    v = F.col("loss_usd")
    out = losses(spark, d).groupBy("crop").agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), *(F.percentile(v, F.lit(q)).alias(n) for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))), F.max(v).alias("max"))
    return rounded(out, "mean", "std", "min", "p25", "p50", "p75", "max", places=2)


@query("qa_extremes", f"WITH {LOSS} SELECT crop, count(DISTINCT year) AS n_years, arg_max(year, loss_usd) AS worst_year, round(max(loss_usd) / avg(loss_usd), 6) AS max_to_mean FROM loss GROUP BY crop")
def _(spark, d):
    return losses(spark, d).groupBy("crop").agg(F.count_distinct("year").alias("n_years"), F.max_by("year", "loss_usd").alias("worst_year"), F.round(F.max("loss_usd") / F.avg("loss_usd"), 6).alias("max_to_mean"))


@query("qa_trigger_frequency", f"""WITH {LOSSES} SELECT crop, count(*) AS n, round(100.0 * count(*) FILTER (tier = 'P1') / count(*), 6) AS p1, round(100.0 * count(*) FILTER (tier IN ('P1', 'P5')) / count(*), 6) AS p5,
round(100.0 * count(*) FILTER (tier <> 'None') / count(*), 6) AS p10, abs(100.0 * count(*) FILTER (tier <> 'None') / count(*) - 10) <= 2 AS p10_ok FROM lossy GROUP BY crop""")
def _(spark, d):
    share = lambda *t: 100.0 * F.count(F.when(F.col("tier").isin(*t), 1)) / F.count("*")
    ten = share("P1", "P5", "P10")
    return tier_losses(spark, d).groupBy("crop").agg(F.count("*").alias("n"), F.round(share("P1"), 6).alias("p1"), F.round(share("P1", "P5"), 6).alias("p5"), F.round(ten, 6).alias("p10"), (F.abs(ten - 10) <= 2).alias("p10_ok"))


@query("qa_rules", f"WITH {LOSSES} SELECT count(*) FILTER (NOT (P1 <= P5 AND P5 <= P10)) AS percentile_order, count(*) FILTER (loss_usd < 0) AS negative_loss, count(*) FILTER (anomaly_sum IS NULL) AS null_anomaly, count(*) FILTER (tier = 'None' AND loss_usd <> 0) AS loss_without_tier FROM lossy")
def _(spark, d):
    return tier_losses(spark, d).agg(
        F.count_if(~((F.col("P1") <= F.col("P5")) & (F.col("P5") <= F.col("P10")))).alias("percentile_order"), F.count_if(F.col("loss_usd") < 0).alias("negative_loss"),
        F.count_if(F.col("anomaly_sum").isNull()).alias("null_anomaly"), F.count_if((F.col("tier") == "None") & (F.col("loss_usd") != 0)).alias("loss_without_tier"))


def contract_violations(df: DataFrame, schema: dict[str, str], not_null: list[str], positive: list[str]) -> DataFrame:
    """Rows ``(check, column, n)`` of a table contract: missing or unexpected columns, other types, NULLs, values that aren't positive."""
    have = dict(df.dtypes)
    shape = [("missing", c, 1) for c in schema if c not in have] + [("unexpected", c, 1) for c in have if c not in schema]
    shape += [("type", c, 1) for c, t in schema.items() if have.get(c, t) != t]
    counts = [F.struct(F.lit(k).alias("check"), F.lit(c).alias("column"), F.count_if(F.col(c).isNull() if k == "null" else ~(F.col(c) > 0)).alias("n")) for k, cs in (("null", not_null), ("positive", positive)) for c in cs if c in have]
    fixed = [F.struct(F.lit(k).alias("check"), F.lit(c).alias("column"), F.lit(n).cast("long").alias("n")) for k, c, n in shape]
    return df.agg(F.array(*counts).alias("a")).select(F.inline(F.concat("a", F.array(*fixed)) if fixed else F.col("a")))


@query("contract_violations", "SELECT 'null' AS \"check\", 'l_quantity' AS \"column\", count(*) FILTER (l_quantity IS NULL) AS n FROM lineitem UNION ALL SELECT 'positive', 'l_discount', count(*) FILTER (NOT l_discount > 0) FROM lineitem UNION ALL SELECT 'missing', 'swc', 1 UNION ALL SELECT 'unexpected', 'l_tax', 1")
def _(spark, d):
    lines = read(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax")
    return contract_violations(lines, {"l_quantity": "double", "l_discount": "double", "swc": "double"}, ["l_quantity"], ["l_discount"])
