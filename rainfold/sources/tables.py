"""Scans and sinks, and the time-series view of the star-schema tables."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainfold.sources.scratch import exists, written


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet or CSV by suffix; NaN becomes NULL once, here."""
    df = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.csv(path, header=True, schema=schema)
    return nan_to_null(df)


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast(t)) for c, t in df.dtypes if t in ("double", "float")})


def write_partitioned(df: DataFrame, path: str, *keys: str, mode: str = "overwrite") -> None:
    """Only the partitions present in ``df`` are replaced."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy(*keys).parquet(path)


def write_cube(df: DataFrame, path: str, mode: str = "overwrite", append_dim: str | None = None) -> None:
    """A cube by year: a fresh one is dealt by year and sorted; ``append`` adds rows along ``append_dim``, and raises without it."""
    if mode == "append" and not append_dim:
        raise ValueError("appending needs the dimension to append along")
    order = [c for c in ("pixel_id", append_dim or "date") if c in df.columns]
    df.repartition("year").sortWithinPartitions(*order).write.mode(mode).partitionBy("year").parquet(path)


def write_chunks(df: DataFrame, path: str, side: float, time: str = "date", mode: str = "overwrite", append_dim: str | None = None) -> None:
    """A cube in chunks of space and time: folders by year and by tiles of ``side`` degrees, rows sorted by place and time within.

    ``append`` adds rows along ``append_dim``, and raises without it, as it does for a dimension that isn't the cube's time. Rows without a coordinate or time are left out.
    """
    if mode == "append" and append_dim != time:
        raise ValueError(f"a cube is appended along {time}, not {append_dim}")
    tile = lambda c: F.floor(F.col(c) / side).cast("int")
    chunks = df.where(F.col("lon").isNotNull() & F.col("lat").isNotNull() & F.col(time).isNotNull()).withColumns({"year": F.year(time), "tile_x": tile("lon"), "tile_y": tile("lat")})
    chunks.repartition("year", "tile_x", "tile_y").sortWithinPartitions("year", "tile_x", "tile_y", "lon", "lat", time).write.mode(mode).partitionBy("year", "tile_x", "tile_y").parquet(path)


def read_chunks(spark: SparkSession, path: str, side: float, box: tuple[float, float, float, float], first: str | None = None, last: str | None = None, time: str = "date") -> DataFrame:
    """Rows of a chunked cube within ``box`` (west, east, south, north, ends included) and from ``first`` to ``last``: only the chunks that these touch are listed and read."""
    west, east, south, north = box
    tile = lambda v: math.floor(v / side)
    rows = spark.read.parquet(path).where(F.col("tile_x").between(tile(west), tile(east)) & F.col("tile_y").between(tile(south), tile(north)))
    rows = rows.where(F.col("lon").between(west, east) & F.col("lat").between(south, north))
    for bound, keep in ((first, lambda c, v: c >= v), (last, lambda c, v: c <= v)):
        if bound:
            day = F.lit(bound).cast("date")
            rows = rows.where(keep(F.col("year"), F.year(day)) & keep(F.col(time), day))
    return rows.drop("tile_x", "tile_y")


def or_synthetic(spark: SparkSession, path: str, first: str = "1991-01-01", last: str = "2020-12-31") -> DataFrame:
    """The table at ``path``; if there is none, two pixels with a normal daily value are written there first."""
    if not exists(spark, path):
        days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
        spark.range(2).select(F.col("id").alias("pixel_id"), F.explode(days).alias("date")).withColumn("swc", 0.3 + 0.05 * F.randn(42)).write.parquet(path)
    return spark.read.parquet(path)


def request_summary(files: DataFrame, request: str) -> DataFrame:
    """``(request, n_files, total_mb, status)`` of ``files(request, bytes, ok)``: success if all came, failed if none did, else partial."""
    got = F.count_if("ok")
    status = F.when(got == F.count("*"), "success").when(got == 0, "failed").otherwise("partial")
    return files.groupBy(request).agg(got.alias("n_files"), F.round(F.sum(F.when(F.col("ok"), F.col("bytes")).otherwise(0)) / 1e6, 6).alias("total_mb"), status.alias("status"))


def without_scalars(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Columns with a single value go, but for those to keep; one pass over the table."""
    single = df.agg(*(F.min(c).eqNullSafe(F.max(c)).alias(c) for c in df.columns)).first()
    return df.select(*(c for c in df.columns if c in keep or not single[c]))


def without_empty(df: DataFrame, keys: list[str]) -> DataFrame:
    """Columns without any value go, then rows without any in what is left, but for the keys; one pass tells the columns."""
    values = [c for c in df.columns if c not in keys]
    row = df.agg(*(F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(values))).first() if values else []
    kept = [c for c, n in zip(values, row) if n]
    return df.select(*keys, *(F.col(f"`{c}`") for c in kept)).where(reduce(lambda a, b: a | b, (F.col(f"`{c}`").isNotNull() for c in kept), F.lit(False)))


def resampled_daily(df: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """``(keys, day, value)``: the largest value of each day from the table's first day to its last one, for every key, as a cube has them; NULL where there is none."""
    own = df.groupBy(*keys, F.to_date(time).alias("day")).agg(F.max(value).alias(value))
    ends = df.agg(F.to_date(F.min(time)).alias("a"), F.to_date(F.max(time)).alias("b")).where("a is not null")
    days = ends.select(F.explode(F.sequence("a", "b")).alias("day")).withColumn("_one", F.lit(1))
    # The days of a table are few, and come to every key.
    places = df.select(*keys).distinct().withColumn("_one", F.lit(1)).join(F.broadcast(days), "_one").drop("_one")
    return places.join(own, [*keys, "day"], "left")


def overwrite_schema(df: DataFrame, path: str, *keys: str) -> None:
    """Replaces a table and its columns as a whole, unlike ``write_partitioned``, which keeps what isn't in ``df``. ``df`` may be made from the table itself:
    the new one is written beside it and then takes its place."""
    spark, beside = df.sparkSession, f"{path.rstrip('/')}.new"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(beside)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(path), hadoop.Path(beside)
    store = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.delete(old, True)
    if not store.rename(new, old):
        raise OSError(f"{beside} couldn't take the place of {path}")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A table to which files with more columns were appended."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pixel_id, zona, region, date, swc, has)``: mean quantity by nation of the supplier and day."""
    places = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lines = read(spark, sf_dir, "lineitem").join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.groupBy(F.col("n_nationkey").cast("long").alias("pixel_id"), F.col("n_name").alias("zona"), F.col("r_name").alias("region"), F.to_date("l_shipdate").alias("date")).agg(F.avg("l_quantity").alias("swc")).withColumn("has", F.lit(1000.0))


OBS = """obs AS (
  SELECT CAST(n_nationkey AS BIGINT) AS pixel_id, n_name AS zona, r_name AS region, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS swc, CAST(1000 AS DOUBLE) AS has
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy(F.col("user_id").cast("long").alias("user_id"), F.date_trunc("hour", "ts").alias("time")).agg(F.avg("value").alias("v"))


HOURLY = "hourly AS (SELECT CAST(user_id AS BIGINT) AS user_id, date_trunc('hour', ts) AS time, avg(value) AS v FROM events GROUP BY ALL)"


def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(crop, year, loss_usd)``."""
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("crop"), F.year("l_shipdate").cast("long").alias("year")).agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("loss_usd"))


LOSS = "loss AS (SELECT l_returnflag AS crop, CAST(year(l_shipdate) AS BIGINT) AS year, sum(l_extendedprice * l_discount) AS loss_usd FROM lineitem GROUP BY ALL)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lattice of nations: ``lon`` = key % 5, ``lat`` = key // 5."""
    return read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("pixel_id"), (F.col("n_nationkey") % 5).cast("double").alias("lon"), F.floor(F.col("n_nationkey") / 5).cast("double").alias("lat"))


CELLS = "cells AS (SELECT CAST(n_nationkey AS BIGINT) AS pixel_id, CAST(n_nationkey % 5 AS DOUBLE) AS lon, CAST(n_nationkey // 5 AS DOUBLE) AS lat FROM nation)"


def first_of(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def densify(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Every key on every day of its calendar years, missing values NULL."""
    days = df.groupBy(key).agg(F.year(F.min(date)).alias("a"), F.year(F.max(date)).alias("b"))
    days = days.select(key, F.explode(F.sequence(F.make_date("a", F.lit(1), F.lit(1)), F.make_date("b", F.lit(12), F.lit(31)))).alias(date))
    return days.join(df.select(key, date, value), [key, date], "left")


def _blocks(first: Column, last: Column, k: int) -> Column:
    """The days ``first`` to ``last``, as numbers, in blocks of ``2 ** k`` days that lie within no block of twice the size there: two at most, as (``_level``, ``_block``)."""
    inner = lambda j: (F.shiftright(first + ((1 << j) - 1), j), F.shiftright(last + 1, j))  # noqa: E731  whole blocks are from the one up to before the other
    (a, b), (c, d) = inner(k), inner(k + 1)
    wider = c < d
    left, right = F.when(wider & (a < 2 * c), a), F.when(wider & (2 * d < b), b - 1)
    alone = [F.when(~wider & (a < b), a), F.when(~wider & (a + 1 < b), a + 1)]
    return F.array(*(F.when(x.isNotNull(), F.struct(F.lit(k).alias("_level"), x.alias("_block"))) for x in (left, right, *alone)))


#: Sizes of blocks of days, up to 2 ** 22 of them: from year 1 to 9999 no interval holds a larger one.
LEVELS = 23


def catalogue_lookup(days: DataFrame, date: str, catalogue: DataFrame, first: str, last: str, order: list[str]) -> DataFrame:
    """Interval lookup: of the catalogue's entries that cover the day, the first; a row a day that has one.

    Of entries with the same days only the first counts. The days of an interval are a few blocks of powers of two (two a size), and of the entries of a block again only the first counts;
    a day meets the blocks that it lies in, one a size, by equality. So entries are sent by their interval, never to each day, and no group grows with the catalogue.
    """
    rest = [c for c in catalogue.columns if c not in order]
    best = lambda df, *keys: df.groupBy(*keys).agg(F.min("_entry").alias("_entry"))
    number = lambda c: F.unix_date(F.col(c).cast("date")).cast("long")
    own = catalogue.where(F.col(first) <= F.col(last)).select(number(first).alias("_a"), number(last).alias("_b"), F.struct(*order, *rest).alias("_entry"))
    parts = F.array_compact(F.concat(*(_blocks(F.col("_a"), F.col("_b"), k) for k in range(LEVELS))))
    blocks = best(best(own, "_a", "_b").select("_entry", F.inline(parts)), "_level", "_block")
    at = F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda k: F.struct(k.alias("_level"), F.call_function("shiftright", F.col("_day"), k).alias("_block")))
    asked = days.withColumn("_day", number(date))
    met = asked.select("_day").where("_day is not null").distinct().select("_day", F.inline(at)).join(blocks, ["_level", "_block"])
    return first_of(asked.join(best(met, "_day"), "_day").drop("_day").select("*", "_entry.*").drop("_entry"), [date], order)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each column: count, mean, std, min, exact 5/50/95 %, max.

    One pass over the table gives the moments; another one counts each column's different values, which are sorted by range for the percentiles. The driver sees a count a range.
    """
    aggs = [F.struct(F.lit(c).alias("name"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")) for c in columns]
    moments = df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
    rows = moments.join(percentiles(df, columns, {"p05": 0.05, "p50": 0.5, "p95": 0.95}), "name", "left")
    return rows.select("name", "n", *(F.round(c, 4).alias(c) for c in ("mean", "std", "min", "p05", "p50", "p95", "max")))


def percentiles(df: DataFrame, columns: list[str], levels: dict[str, float]) -> DataFrame:
    """``(name, <levels>)``: exact percentiles of columns, interpolated linearly; no row for a column without values."""
    long = df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns)))).where("v is not null")
    placed = written(long.groupBy("name", "v").agg(F.count("*").alias("n")).repartitionByRange("name", "v").sortWithinPartitions("name", "v").withColumn("_range", F.spark_partition_id()), "values")
    # Values of a column before a range, from the few sums by range; within it a window adds up.
    sums = placed.groupBy("name", "_range").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy("name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("name", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy("name")).alias("_all"))
    here = Window.partitionBy("name", "_range").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = placed.withColumn("_to", F.sum("n").over(here)).join(F.broadcast(offsets), ["name", "_range"]).withColumn("_to", F.col("_before") + F.col("_to"))
    place = lambda q: (F.col("_all") - 1) * q
    at = lambda r: F.max(F.when((F.col("_to") - F.col("n") <= r) & (r < F.col("_to")), F.col("v")))  # noqa: E731  the value of this rank, from 0
    ends = ended.groupBy("name").agg(F.max("_all").alias("_all"), *(at(f(place(q))).alias(f"{c}_{e}") for c, q in levels.items() for e, f in (("low", F.floor), ("high", F.ceil))))
    between = lambda c, q: F.col(f"{c}_low") + (F.col(f"{c}_high") - F.col(f"{c}_low")) * (place(q) - F.floor(place(q)))
    return ends.select("name", *(between(c, q).alias(c) for c, q in levels.items()))
