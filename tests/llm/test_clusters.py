"""Clustering against a full search on Python's integers."""

import hashlib
import math
import random

import pytest

from rainfold.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, label int, x array<long>, cluster int, known string, before long"


def plain(rows: list[tuple], k: int, rounds: int, dimension: int) -> tuple[list[tuple], list[list[int]]]:
    whole = lambda v: max(-(1 << 27), min(1 << 27, math.floor(256 * v))) if abs(v) < 1e18 else int(math.copysign(1 << 27, v))
    kept = [(i, [whole(v) for v in e]) for i, e in rows if e is not None and len(e) == dimension and all(v is not None and math.isfinite(v) for v in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in order[:k]]
    distance = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    nearest = lambda x: min((distance(x, c), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in kept]
        for c in set(own):
            members = [x for (_, x), o in zip(kept, own) if o == c]
            centroids[c] = [sum(v) // len(members) for v in zip(*members)]
    return [(i, *reversed(nearest(x))) for i, x in kept], centroids


def table(spark, rows):
    return spark.createDataFrame([(i, e, 1, [9], 7, "k", 8) for i, e in rows], SCHEMA)


def vectors(n: int, dimension: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    middles = [[rng.uniform(-0.3, 0.3) for _ in range(dimension)] for _ in range(7)]
    rows = [(i, [m + rng.gauss(0, 0.05) for m in rng.choice(middles)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(40)] + [(5, rows[0][1]), (5, rows[4][1]), (None, rows[1][1]), (None, rows[2][1])]
    odd = [None, [], [0.1] * (dimension + 1), [None] * dimension, [math.nan] + [0.1] * (dimension - 1), [math.inf] + [0.1] * (dimension - 1)]
    return rows + [(9000 + i, e) for i, e in enumerate(odd)] + [(9100, [1e300] * dimension), (9101, [-3e4] * dimension)]


@pytest.mark.parametrize("n, k, rounds, dimension", [(300, 12, 5, 64), (120, 40, 5, 3), (5, 60, 2, 2)])
def test_against_full_search(spark, n, k, rounds, dimension):
    rows = vectors(n, dimension, n)
    want, centroids = plain(rows, k, rounds, dimension)
    found, own = clusters.cluster(clusters.kept(table(spark, rows), dimension), k, rounds)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = found.collect()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=key) == sorted(want, key=key)
    assert own.tolist() == centroids
    if (n, k) == (300, 12):  # the bounds save most of the work after the first rounds
        assert sum(r["evaluations"] for r in got) < 0.5 * len(got) * k * (rounds + 1)


def test_query(spark, tmp_path):
    rows = vectors(150, 64, 3)
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    want, centroids = plain(rows, 40, 5, 64)
    inertia = {c: sum(d for _, o, d in want if o == c) for c in range(40)}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    got = [tuple(r) for r in clusters.op13_clusters(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(((i, c, d, inertia[c], sum(inertia.values()), names[c]) for i, c, d in want), key=key)


def test_no_vectors(spark, tmp_path):
    table(spark, [(1, None), (2, [1.0])]).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert clusters.op13_clusters(spark, str(tmp_path)).collect() == []
