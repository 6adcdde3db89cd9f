"""Daily totals of an event stream, with late rows bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.sources.scratch import scratch_path


def totals(events: DataFrame, late: str = "1 day") -> DataFrame:
    """``(event_type, day, n, total)`` of a stream of ``(ts, event_type, value)``."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = timed.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select("event_type", F.to_date("window.start").alias("day"), "n", "total")


def replayed(spark: SparkSession, path: str) -> DataFrame:
    """Runs the stream over the rows of a table until it is through, and reads the latest total of each day.

    Update mode: a batch writes the totals that it changed to a folder of its own, and days behind the watermark leave the state. A batch that runs again replaces its folder.
    """
    out, work = scratch_path(spark, "daily"), scratch_path(spark, "progress")
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", path.rsplit("/", 1)[1]).parquet(path.rsplit("/", 1)[0])
    query = totals(stream).writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", work)
    query.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")).start().awaitTermination()
    latest = spark.read.parquet(out).groupBy("event_type", "day").agg(F.max_by(F.struct("n", "total"), "batch").alias("t"))
    return latest.select("event_type", "day", "t.n", "t.total")
