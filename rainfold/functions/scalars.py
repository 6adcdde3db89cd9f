"""Column helpers: cleaning, naming, registration."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainfold.sources.scratch import written

#: Names under which a source may carry a variable. Fixed values.
ALIASES = {
    "swc": ["swc", "swvl1", "soil_water_content"],
    "prcp": ["prcp", "tp", "total_precipitation", "precipitation", "precip", "prc", "pcp", "precip_rnl"],
    "tmin": ["tmin", "t2m", "2t", "t", "mn2t6", "mn2t", "mn2t24"],
    "tmax": ["tmax", "t2m", "2t", "t", "mx2t6", "mx2t", "mx2t24"],
    "windspeed": ["windspeed", "wind_speed", "wind"],
    "windgust": ["windgust", "fg10"],
    "wind": ["fg10"],
}
COORDINATES = {"lat": ["lat", "latitude", "y"], "lon": ["lon", "longitude", "x"]}


def canonical(df: DataFrame, variable: str) -> DataFrame:
    """``df`` with the variable and its coordinates under their own names. Of several names the first in order counts.

    Raises if the variable isn't registered, or if no name of it is a column.
    """
    if variable not in ALIASES:
        raise KeyError(f"{variable!r} isn't a registered variable; there are {', '.join(ALIASES)}")
    have = next((c for c in ALIASES[variable] if c in df.columns), None)
    if have is None:
        raise KeyError(f"no column for {variable!r}; one of {', '.join(ALIASES[variable])} is needed")
    for name, others in {variable: [have], **COORDINATES}.items():
        found = next((c for c in others if c in df.columns), None)
        if found and found != name:
            df = df.withColumnRenamed(found, name)
    return df


def date_of_file(file: Column | str) -> Column:
    """Day from a file name with ``-yyyymmddT``; NULL without one."""
    return F.try_to_date(F.nullif(F.regexp_extract(file, r"-(\d{8})T", 1), F.lit("")), "yyyyMMdd")


def decoded(raw: Column, missing: int, scale: float) -> Column:
    return F.when(raw != missing, raw * scale)


def keyword_search(df: DataFrame, words: list[str], columns: dict[str, list[str]]) -> DataFrame:
    """Rows in which any word occurs in its columns, whatever the case."""
    hits = [F.contains(F.lower(c), F.lit(w.lower())) for w in words for c in columns[w]]
    return df.where(reduce(lambda a, b: a | b, hits))


def time_slice(df: DataFrame, time: str, first: str | None, last: str | None) -> DataFrame:
    """Both days included; either may be open."""
    if first:
        df = df.where(F.col(time) >= F.lit(first).cast("timestamp_ntz"))
    if last:
        df = df.where(F.col(time) < F.lit(last).cast("timestamp_ntz") + F.expr("interval 1 day"))
    return df


def subset(df: DataFrame, include: dict[str, list], exclude: dict[str, list]) -> DataFrame:
    """Rows with listed values and without others; NULL isn't excluded. Unknown columns are warned of and ignored."""
    for keep, wanted in ((True, include), (False, exclude)):
        for c, values in wanted.items():
            if c not in df.columns:
                warnings.warn(f"no column {c!r}; ignored", stacklevel=2)
            else:
                df = df.where(F.col(c).isin(values) if keep else F.coalesce(~F.col(c).isin(values), F.lit(True)))
    return df


def rename_location(df: DataFrame, column: str) -> DataFrame:
    if "location_id" in df.columns:
        df = df.withColumnRenamed("location_id", "location_id_orig")
    return df.withColumnRenamed(column, "location_id")


def registered(df: DataFrame, defaults: dict) -> DataFrame:
    """Missing columns get defaults; production costs have no rate and term, loans no size."""
    for c, v in defaults.items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v))
    loan = F.col("value_type") == "Loan Amount"
    return df.withColumns({"rate": F.when(loan, F.col("rate")), "term": F.when(loan, F.col("term")), "size_ha": F.when(~loan, F.col("size_ha"))})


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """Numbers from 1 in an order: rows are dealt out by range and sorted there, and the ranges before a row's own give its offset.

    The other columns break ties. The driver sees one count a partition. A key that many rows share makes its own range large unless
    the other columns tell its rows apart.
    """
    ties = [F.col(f"`{c}`") for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    placed = written(df.repartitionByRange(*order, *ties).sortWithinPartitions(*order, *ties).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    sizes = dict(placed.groupBy(F.shiftright("_at", 33)).count().collect())
    before = [(k, sum(n for j, n in sizes.items() if j < k)) for k in sizes]
    offsets = df.sparkSession.createDataFrame(before, "_range long, _before long")
    within = F.col("_at").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("_range", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_range").withColumn(name, F.col("_before") + within + 1).drop("_range", "_before", "_at")


def with_ids(df: DataFrame, order: list, prefix: str = "ID-", least: int = 3) -> DataFrame:
    """Consecutive ids in an order, as wide as the last one."""
    rows = numbered(df, order, "_number")
    width = F.lit(max(len(str(rows.count())), least))
    return rows.withColumn("location_id", F.concat(F.lit(prefix), F.lpad(F.col("_number").cast("string"), width, "0"))).drop("_number")
