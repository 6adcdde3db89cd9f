"""Connected components of graphs given by their edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainfold.sources.scratch import written


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of the undirected ``edges(a, b)`` of longs: each node's smallest reachable one, for nodes that have an edge.

    Each round every node tells its neighbours the smallest root it knows, and roots are replaced by their own roots; a round is two aggregations and two joins, is
    written to the shared folder, and ends when the roots' checksum stays. Long chains halve each round, and a hub is a row a task.
    """
    both = written(edges.where("a <> b").select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).distinct(), "edges")
    roots, before = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots"), None
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        # A root whose node has found a lower one takes that along with all that point to it.
        hooks = lower.groupBy("root").agg(F.min("low").alias("hook"))
        step = lower.join(hooks, "root").select("node", F.least("low", "hook").alias("root"))
        jumped = step.join(step.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left").select("node", F.least("root", F.coalesce("up", "root")).alias("root"))
        roots = written(jumped, "roots")
        stamp = tuple(roots.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())
        if stamp == before:
            return roots
        before = stamp
