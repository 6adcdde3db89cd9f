"""Trigger and payout contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TIERS = (("P1", "cost_max"), ("P5", "cost_midpoint"), ("P10", "cost_min"))


def validated(tail: str, design: str, levels: dict) -> dict[int, float]:
    """Levels by whole percentile, in ascending order; raises if the contract makes no sense."""
    if tail not in ("lower", "upper"):
        raise ValueError(f"tail must be lower or upper, not {tail!r}")
    if design not in ("continuous", "layered"):
        raise ValueError(f"design must be continuous or layered, not {design!r}")
    own = dict(sorted((int(k), float(v)) for k, v in levels.items()))
    if not own:
        raise ValueError("a contract needs levels")
    if design == "continuous" and len(own) != 2:
        raise ValueError("a continuous contract has two levels")
    values = list(own.values())
    rising = all(a < b for a, b in zip(values, values[1:]))
    falling = all(a > b for a, b in zip(values, values[1:]))
    if len(values) > 1 and not (rising if tail == "upper" else falling):
        raise ValueError(f"payouts of the {tail} tail must {'rise' if tail == 'upper' else 'fall'} with the level")
    return own


def expanded(spec: dict, windows) -> list[dict]:
    """The entries of a contract, one for each window and tail, upper first, with its levels and rates.

    ``spec``: ``{"windows": {window: {tail: {"design", "levels"}}}}``; ``target_loss_ratio`` and ``deductions`` may be given for a tail, a window or all, the
    nearest counts. Raises for a window that isn't one of ``windows``, one without a tail, and levels that make no sense.
    """
    own = spec.get("windows")
    if not isinstance(own, dict) or not own:
        raise ValueError("a contract needs windows")
    if unknown := set(own) - set(windows):
        raise ValueError(f"unknown windows {sorted(unknown)}; there are {sorted(windows)}")
    defaults = {"target_loss_ratio": 0.74, "deductions": 0.14}
    out = []
    for window, tails in own.items():
        named = [t for t in ("upper", "lower") if t in (tails or {})]
        if not named:
            raise ValueError(f"window {window} needs an upper or a lower tail")
        for tail in named:
            terms = tails[tail]
            if not terms or "design" not in terms or not isinstance(terms.get("levels"), dict):
                raise ValueError(f"the {tail} tail of window {window} needs a design and levels")
            levels = validated(tail, terms["design"], terms["levels"])
            costs = {k: next((s[k] for s in (terms, tails, spec) if k in s), v) for k, v in defaults.items()}
            out.append({"window": window, "tail": tail, "design": terms["design"], "levels": levels, **costs, **rates(tail, terms["design"], levels, **costs)})
    return out


def schedule(indices: DataFrame, entries: list[dict], percentile: Column) -> DataFrame:
    """Every complete window under the entries of its contract: ``indices`` with their terms, payout and rates. ``percentile`` is 0 to 100.

    The entries are literals in one array, so the indices are read once and not joined. Raises without entries.
    """
    if not entries:
        raise ValueError("no window and tail to pay out")
    terms = [
        F.struct(
            F.lit(e["window"]).alias("of"), F.lit(e["tail"]).alias("tail"), F.lit(e["design"]).alias("design"), F.lit(", ".join(f"{k}: {v:g}" for k, v in e["levels"].items())).alias("levels"),
            F.round(payout(percentile, e["tail"], e["design"], e["levels"]), 10).alias("payout_pct"), F.lit(e["pure"]).alias("pure_premium_pct"), F.lit(e["target_loss_ratio"]).alias("target_loss_ratio"),
            F.lit(e["re"]).alias("re_premium_pct"), F.lit(e["deductions"]).alias("deductions"), F.lit(e["gross"]).alias("gross_premium_pct"))
        for e in entries
    ]
    own = F.filter(F.array(*terms), lambda t: t["of"] == F.col("window"))
    return indices.where("flag_complete_window = 1").select("*", F.inline(own)).drop("of")


ENTRIES = (
    "contract_id long, window int, tail string, design string, pcts array<double>, fractions array<double>, pure_premium_pct double, "
    "target_loss_ratio double, re_premium_pct double, deductions double, gross_premium_pct double"
)


class ContractEntries:
    """Table function: the entries of contracts given as rows ``(contract_id, window, tail, design, pct, fraction, target_loss_ratio, deductions)``, one for each level, to be called with
    ``PARTITION BY contract_id``. A contract is checked as a whole, by the rules of ``expanded``; costs that are NULL take its defaults."""

    def __init__(self):
        self.windows: dict = {}
        self.contract_id = None

    def eval(self, row) -> None:
        self.contract_id = row["contract_id"]
        terms = self.windows.setdefault(row["window"], {}).setdefault(row["tail"], {"design": row["design"], "levels": {}})
        terms["levels"][row["pct"]] = row["fraction"]
        terms |= {k: row[k] for k in ("target_loss_ratio", "deductions") if row[k] is not None}

    def terminate(self):
        if not self.windows:
            return
        for e in expanded({"windows": self.windows}, self.windows):
            yield self.contract_id, e["window"], e["tail"], e["design"], [float(k) for k in e["levels"]], list(e["levels"].values()), e["pure"], e["target_loss_ratio"], e["re"], e["deductions"], e["gross"]


def register(spark: SparkSession) -> None:
    """Registers ``contract_entries`` for SQL."""
    spark.udtf.register("contract_entries", F.udtf(ContractEntries, returnType=ENTRIES))


def payout_of(p: Column) -> Column:
    """The payout at a percentile (0 to 100) of a row's own ``tail``, ``design``, ``pcts`` (ascending) and ``fractions``: a changed contract is another row, not another plan."""
    lower = F.col("tail") == "lower"
    steps = F.arrays_zip("pcts", "fractions")
    reached = F.filter(steps, lambda s: F.when(lower, p <= s["pcts"]).otherwise(p >= s["pcts"]))
    layer = F.when(F.size(reached) == 0, 0.0).otherwise(F.when(lower, F.get(reached, F.lit(0))["fractions"]).otherwise(F.get(reached, F.size(reached) - 1)["fractions"]))
    first, last = (F.when(lower, F.get(steps, F.lit(1 - i))).otherwise(F.get(steps, F.lit(i))) for i in (0, 1))
    ramp = first["fractions"] + (p - first["pcts"]) / (last["pcts"] - first["pcts"]) * (last["fractions"] - first["fractions"])
    before, after = F.when(lower, p > first["pcts"]).otherwise(p < first["pcts"]), F.when(lower, p <= last["pcts"]).otherwise(p >= last["pcts"])
    ramp = F.when(before, 0.0).when(after, last["fractions"]).otherwise(ramp)
    return F.when(p.isNotNull(), F.when(F.col("design") == "continuous", ramp).otherwise(layer))


def entries(contracts: DataFrame) -> DataFrame:
    """The rows that ``contract_entries`` makes of ``contracts``."""
    register(contracts.sparkSession)
    return contracts.sparkSession.sql("SELECT * FROM contract_entries(TABLE(SELECT * FROM {contracts}) PARTITION BY contract_id)", contracts=contracts)


def scheduled(indices: DataFrame, contracts: DataFrame, percentile: Column) -> DataFrame:
    """Every complete window under the entries of its contract: ``indices(contract_id, window, ...)`` joined to the rows that ``contract_entries`` makes of ``contracts``."""
    met = indices.where("flag_complete_window = 1").join(entries(contracts), ["contract_id", "window"])
    return met.withColumn("payout_pct", F.round(payout_of(percentile), 10)).drop("pcts", "fractions")


def policy_levels(model: DataFrame, entries: list[dict]) -> DataFrame:
    """A row for each bound of a continuous entry (start and exit) and each level of a layered one: ``tail``, ``pct``, ``bound``, ``payout_fraction``."""
    rows = []
    for e in entries:
        levels = list(e["levels"].items())
        if e["design"] == "continuous":
            start, end = levels[::-1] if e["tail"] == "lower" else levels
            levels = [(*start, "start"), (*end, "exit")]
        rows += [(e["window"], e["tail"], k, bound[0] if bound else "level", v) for k, v, *bound in levels]
    names = ("of", "tail", "pct", "bound", "payout_fraction")
    own = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in rows))
    return model.select("*", F.inline(F.filter(own, lambda t: t["of"] == F.col("window")))).drop("of")


def priced_policy(policy: DataFrame, locations: DataFrame, payouts: DataFrame, keys: list[str]) -> DataFrame:
    """``policy`` with the crop of each location and, from its payouts, coverage and insured value: two left joins, the second on distinct prices."""
    prices = payouts.groupBy(*keys, "crop", "tail").agg(F.min_by(F.struct("coverage", "insured_value"), "window_year").alias("price"))
    out = policy.join(locations.select("location_id", "crop").dropDuplicates(["location_id"]), "location_id", "left")
    return out.join(prices, [*keys, "crop", "tail"], "left").select(*out.columns, "price.coverage", "price.insured_value")


def continuous(p: Column, tail: str, levels: dict) -> Column:
    """Ramp between two percentiles (0 to 100)."""
    (a, x), (b, y) = validated(tail, "continuous", levels).items()
    start, exit_, least, most = (b, a, y, x) if tail == "lower" else (a, b, x, y)
    ramp = least + (p - start) / (exit_ - start) * (most - least)
    before, after = (p > start, p <= exit_) if tail == "lower" else (p < start, p >= exit_)
    return F.when(p.isNull(), None).when(before, 0.0).when(after, most).otherwise(ramp)


def layered(p: Column, tail: str, levels: dict) -> Column:
    """Payout of the last layer reached."""
    own = validated(tail, "layered", levels)
    out = F.lit(0.0)
    for k, v in sorted(own.items(), reverse=tail == "lower"):
        out = F.when(p <= k if tail == "lower" else p >= k, v).otherwise(out)
    return F.when(p.isNotNull(), out)


def payout(p: Column, tail: str, design: str, levels: dict) -> Column:
    return (continuous if design == "continuous" else layered)(p, tail, levels)


def pure_premium(tail: str, design: str, levels: dict) -> float:
    """Expected payout, from the contract alone."""
    own = validated(tail, design, levels)
    if design == "continuous":
        (k1, x), (k2, y) = own.items()
        start, exit_, least, most = (k2, k1, y, x) if tail == "lower" else (k1, k2, x, y)
        a, e = ((start, exit_) if tail == "lower" else (100 - start, 100 - exit_))
        return least * a / 100 + (most - least) * (a + e) / 200
    order = sorted(own.items(), reverse=tail == "lower")
    reach = [k / 100 if tail == "lower" else 1 - k / 100 for k, _ in order]
    steps = [v - u for (_, v), u in zip(order, [0.0, *(v for _, v in order)])]
    return sum(s * r for s, r in zip(steps, reach))


def rates(tail: str, design: str, levels: dict, target_loss_ratio: float = 0.74, deductions: float = 0.14) -> dict[str, float]:
    pure = pure_premium(tail, design, levels)
    re = pure / target_loss_ratio
    return {"pure": round(pure, 10), "re": round(re, 10), "gross": round(re * (1 + deductions), 10)}


def tier(anomaly: Column, p: dict[str, Column]) -> Column:
    """First of P1, P5, P10 that the anomaly doesn't exceed, else 'None'."""
    out = F.lit("None")
    for name, _ in reversed(TIERS):
        out = F.when(anomaly <= p[name], name).otherwise(out)
    return out


def tier_loss(tier_: Column, region: Column, area: Column, costs: dict[str, dict[str, float]], ratio: float = 1.0) -> Column:
    """Area times the region's cost at the tier; 0 for unknown regions and no tier."""
    cost = F.lit(0.0)
    for r, own in costs.items():
        for name, field in TIERS:
            cost = F.when((region == r) & (tier_ == name), float(own[field])).otherwise(cost)
    return F.coalesce(area * cost * ratio, F.lit(0.0))


def repriced(df: DataFrame) -> DataFrame:
    """``insured_value``, ``premium`` and ``payout`` of locations with payouts. A zero divisor gives NULL."""
    loan = F.col("value_type") == "Loan Amount"
    by_target = F.try_divide(F.col("target_premium"), F.col("coverage") * F.col("gross_premium_pct"))
    amount = F.when(loan, F.col("value_amount") * (F.try_divide(F.lit(1.0), F.col("term")) + F.col("rate"))).otherwise(F.col("value_amount"))
    value = F.when(F.col("target_premium").isNotNull(), by_target).otherwise(amount)
    size = F.when(loan, 1.0).otherwise(F.coalesce("size_ha", F.lit(1.0)))
    known = df.where("value_type is not null and value_amount is not null and coverage is not null").withColumn("insured_value", value)
    return known.withColumns({"premium": F.col("insured_value") * F.col("coverage") * F.col("gross_premium_pct") * size, "payout": F.col("insured_value") * F.col("coverage") * F.col("payout_pct") * size})
