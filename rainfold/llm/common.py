"""What the operators of this subpackage share: reading tables, cutting lineage, connected components."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Unset, a local one if all runs on this machine, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = os.path.join(tempfile.gettempdir(), "rainfold-checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended; the folder is scratch space
        pass


#: Spark deletes the shuffle files of a query when it ends; that of a written table is never run again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written below the shared folder, which cut lineage and survive lost executors.

    ``write`` returns the table read back. ``drop`` deletes those that nothing lazy reads any more;
    what is left goes when the interpreter ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.paths: dict[int, str] = {}
        atexit.register(_delete, spark, self.root)

    def write(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path, before = f"{self.root}/{self.n}", self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def sized(self, written: DataFrame, rows: int = 1 << 20) -> DataFrame:
        """A written table of a few numbers a row, to be broadcast if it has at most ``rows`` rows (16 MB or so); else Spark shuffles it."""
        return F.broadcast(written) if written.limit(rows + 1).count() <= rows else written

    def drop(self, *written: DataFrame) -> None:
        for df in written:
            if path := self.paths.pop(id(df), None):
                _delete(self.spark, path)


_SPACES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, ASCII letters in lower case and non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACES).split()


def arrow_schema(ddl: str) -> pa.Schema:
    """Only the driver can parse a schema; a task gets the result."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def per_text(docs: DataFrame, fn: Callable[[list, list], dict], schema: str, *extra: str) -> DataFrame:
    """``fn(doc_ids, texts, *extra columns)`` on Arrow batches of ``docs``; it returns columns of ``schema``."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                out = fn(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *extra).mapInArrow(run, schema)


def whole_rows(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``run`` on batches of all columns of ``docs``, of which it gives rows back. It sees columns by place, so that any names will do."""
    placed = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return placed.mapInArrow(run, placed.schema).toDF(*docs.columns)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of the undirected ``edges(a, b)`` of longs, as ``(node, root)`` with the smallest node as root.

    Alternates large-star and small-star steps; each is one aggregation and one join, and a table is
    written after each round. Only counts come to the driver. Nodes without edges are not returned.
    """
    now = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()
        after = scratch.write(small)
        stamp = tuple(after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(now)
        now = after
        if stamp == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = stamp
