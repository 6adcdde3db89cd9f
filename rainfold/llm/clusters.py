"""Centroid clustering of vectors: k-means on integers with ns-bounds.

Vectors of ``DIMENSION`` components, none null or non-finite, become integers ``floor(SCALE * x)``. Each vector keeps, for every centroid, the
squared distance it had when that was last evaluated, and the round of it. In a later round the root of a kept distance is loosened by the norm of the
centroid's *total* displacement since that round, which the history of centroids gives: an upper bound for its own centroid, a lower bound for each
other one. Where a lower bound doesn't exceed the upper one, the own distance is evaluated and, if the test still fails, the distance in question too, both exactly
on integers. So assignments are those of a full search, ties included (the smaller number).

The history has ``k`` centroids a round and goes with every task; so do sums of a round, a row a cluster. A round's sums are the last ones with the vectors that
moved taken out of one cluster and put into another, summed in tasks first, so a cluster of any share of the rows is a row a task. The state is written after
each round and cuts the lineage.

Defined results: rows without a vector of this kind are left out; repeated rows and those that share a vec_id or have none are vectors of their own (a null
vec_id is hashed as empty text, equal ids come in the order of their vectors); fewer vectors than ``k`` give as many centroids; an empty table gives an empty result.
Components beyond 2**27 are taken as that, so that a squared distance fits a long. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.llm.common import Scratch, arrow_schema, table

DIMENSION, SCALE, K, ROUNDS = 64, 256, 40, 5
LARGEST = 1 << 27
#: Below it, products summed over a vector are exact in doubles.
EXACT = 1 << 21


def kept(embeddings: DataFrame, dimension: int = DIMENSION) -> DataFrame:
    """``(vec_id, x)``: integer vectors of the rows that have all components."""
    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    odd = F.exists("e", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = lambda v: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), v * SCALE)))
    return own.where((F.size("e") == dimension) & ~odd).select("vec_id", F.transform("e", whole).alias("x"))


def seeds(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The first centroids: the ``k`` vectors with the smallest hashes of their ids."""
    name = F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select("x", F.sha2(name, 256).alias("h")).orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` to all rows of ``c``."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < EXACT:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """(round, centroid): how far each centroid is now from where it was in a round, rounded up."""
    now = history[-1]
    return np.stack([np.sqrt(((now - old).astype(np.float64) ** 2).sum(axis=1)) for old in history]) * (1 + 1e-12)


def reassigned(x: np.ndarray, cluster: np.ndarray, known: np.ndarray, seen: np.ndarray, history: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """The nearest centroids of ``x`` now and the number of distances evaluated for each row.

    ``known`` and ``seen`` hold squared distances and the rounds of their evaluation, by row and centroid, and are brought up to date in place.
    """
    now, far, rows = len(history) - 1, displacements(history), np.arange(len(x))
    evaluated = np.zeros(len(x), np.int64)
    loosened = far[seen, np.arange(known.shape[1])[None, :]]
    root = np.sqrt(known.astype(np.float64))
    lower = root * (1 - 1e-12) - loosened
    upper = root[rows, cluster] * (1 + 1e-12) + loosened[rows, cluster]
    lower[rows, cluster] = np.inf
    doubtful = np.flatnonzero((lower <= upper[:, None]).any(axis=1) & (seen[rows, cluster] < now))
    own = ((x[doubtful] - history[-1][cluster[doubtful]]) ** 2).sum(axis=1)
    known[doubtful, cluster[doubtful]], seen[doubtful, cluster[doubtful]] = own, now
    evaluated[doubtful] += 1
    upper[doubtful] = np.sqrt(own.astype(np.float64)) * (1 + 1e-12)
    failed = lower <= upper[:, None]
    at = np.flatnonzero(failed.any(axis=1))
    r, c = np.nonzero(failed[at])
    r = at[r]
    for i in range(0, len(r), 1 << 15):
        a, b = r[i : i + (1 << 15)], c[i : i + (1 << 15)]
        known[a, b], seen[a, b] = ((x[a] - history[-1][b]) ** 2).sum(axis=1), now
    evaluated += failed.sum(axis=1)
    # What was rescanned is compared exactly; what wasn't is further away than the own centroid.
    fresh = np.where(failed[at], known[at], np.iinfo(np.int64).max)
    fresh[np.arange(len(at)), cluster[at]] = known[at, cluster[at]]
    after = cluster.copy()
    after[at] = fresh.argmin(axis=1)
    return after, evaluated


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).ravel(), type=kind)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), flat)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


STATE = "vec_id long, x array<long>, cluster int, before int, evaluations long, known array<long>, seen array<byte>"
#: Vectors taken at a time.
BATCH = 2048


def assign(history: list[np.ndarray], exact: bool = False):
    """Tasks that assign vectors to the centroids of the last round in ``history``; ``before`` is the cluster of the round before, or -1.

    ``exact``: the distance of the own centroid is evaluated even where its bound was enough.
    """
    schema, k = arrow_schema(STATE), len(history[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                x = matrix(batch.column("x"), history[-1].shape[1]).astype(np.int64)
                if len(history) == 1:
                    before, known, seen = np.full(len(x), -1), squared(x, history[-1]), np.zeros((len(x), k), np.int8)
                    cluster, evaluations = known.argmin(axis=1), np.full(len(x), k)
                else:
                    before = batch.column("cluster").to_numpy().astype(np.int64)
                    known, seen = matrix(batch.column("known"), k).copy(), matrix(batch.column("seen"), k).copy()
                    cluster, evaluations = reassigned(x, before, known, seen, history)
                    if exact:
                        stale = np.flatnonzero(seen[np.arange(len(x)), cluster] < len(history) - 1)
                        known[stale, cluster[stale]] = ((x[stale] - history[-1][cluster[stale]]) ** 2).sum(axis=1)
                        evaluations[stale] += 1
                    evaluations = evaluations + batch.column("evaluations").to_numpy()
                columns = (batch.column("vec_id"), lists(x, pa.int64()), pa.array(cluster, pa.int32()), pa.array(before, pa.int32()), pa.array(evaluations, pa.int64()), lists(known, pa.int64()), lists(seen, pa.int8()))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def moved(state: DataFrame, k: int, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """By cluster, the change of its count and of its sums: a number for each of its components comes to the driver."""
    change = F.filter(F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("sign")), F.struct(F.col("before").alias("c"), F.lit(-1).alias("sign"))), lambda s: s["c"] >= 0)
    signed = state.where("cluster <> before").select("x", F.inline(change)).select("c", "sign", F.posexplode("x").alias("i", "v"))
    rows = signed.groupBy("c", "i").agg(F.sum("sign").alias("n"), F.sum(F.col("v") * F.col("sign")).alias("s")).collect()
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dimension), np.int64)
    for r in rows:
        counts[r["c"]], sums[r["c"], r["i"]] = r["n"], r["s"]
    return counts, sums


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, salt: str = "2:") -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance, evaluations)`` of ``vectors(vec_id, x)`` after ``rounds`` rounds and a last assignment, and the centroids."""
    scratch = Scratch(vectors.sparkSession, "clusters")
    history = [seeds(vectors, k, salt)]
    if not len(history[0]):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("evaluations")).limit(0), history[0]
    k, dimension = history[0].shape
    counts, sums, state = np.zeros(k, np.int64), np.zeros((k, dimension), np.int64), vectors
    for _ in range(rounds):
        state, old = scratch.write(state.mapInArrow(assign(history), STATE)), state
        scratch.drop(old)
        counts, sums = (a + b for a, b in zip((counts, sums), moved(state, k, dimension)))
        history.append(np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], history[-1]))
    last = state.mapInArrow(assign(history, True), STATE)
    return last.select("vec_id", "cluster", F.element_at("known", F.col("cluster") + 1).alias("distance"), "evaluations"), history[-1]


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(kept(table(spark, sf_dir, "embeddings")))
    found = Scratch(spark, "clustered").write(found)
    names = [sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(i, sums.get(i, 0), sum(sums.values()), name) for i, name in enumerate(names)]
    totals = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(totals), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds_sql() -> str:
    """Full searches, round by round."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(
            f"m{i} AS MATERIALIZED (SELECT r, min(CAST(list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, k.x) + list_dot_product(k.x, k.x) AS BIGINT) * {K} + k.c) AS best FROM v, c{i} k GROUP BY r),"
            f" a{i} AS MATERIALIZED (SELECT r, best % {K} AS c, best // {K} AS d FROM m{i})"
        )
        if i < ROUNDS:
            steps.append(
                f"s{i} AS (SELECT c, i, floor(sum(x[i]) / count(*)) AS y FROM a{i} JOIN v USING (r), range(1, {DIMENSION + 1}) t(i) GROUP BY c, i),"
                f" c{i + 1} AS MATERIALIZED (SELECT k.c, coalesce(n.x, k.x) AS x FROM c{i} k LEFT JOIN (SELECT c, list(y ORDER BY i) AS x FROM s{i} GROUP BY c) n USING (c))"
            )
    return ",\n".join(steps)


OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor({SCALE} * CAST(e AS DOUBLE))) AS x
  FROM embeddings WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c, x FROM v
  ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), x LIMIT {K}
),
{_rounds_sql()}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(k.x, lambda y: CAST(y AS BIGINT)), ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (r) JOIN c{ROUNDS} k USING (c)
"""
