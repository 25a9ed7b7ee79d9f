"""Clustering by bounds against plain rounds in whole numbers, and against SQL."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from marketloom.llm import clusters
from marketloom.llm.queries import QUERIES, SQL
from tools import compare


def plain(rows, k, rounds, dims, scale=256, seed=2):
    """Every vector against every centroid in each round: [(id, cluster, distance)], centroids."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    at = [v for _, v in named[:k]] or [min(v for _, v in kept)]
    for step in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at)) for _, v in kept]
        if step < rounds:
            for n in range(len(at)):
                own = [v for (_, v), (_, c) in zip(kept, best) if c == n]
                if own:
                    at[n] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i, c, d) for (i, _), (d, c) in zip(kept, best)), key=str), at


def got(df):
    rows = df.collect()
    total = {}
    for r in rows:
        total[r.cluster] = total.get(r.cluster, 0) + r.distance
    assert all(r.cluster_inertia == total[r.cluster] and r.inertia == sum(total.values()) for r in rows)
    return sorted(((r.vec_id, r.cluster, r.distance) for r in rows), key=str), {r.cluster: list(r.centroid) for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_rounds(spark, seed, monkeypatch):
    pushed, write = [], clusters._heap

    def heap(df):
        pushed.append(write(df))
        return pushed[-1]

    monkeypatch.setattr(clusters, "_heap", heap)
    draw = random.Random(seed)
    middles = [[draw.uniform(-3, 3) for _ in range(6)] for _ in range(5 + seed)]
    rows = [(i, [draw.gauss(m, 0.3) for m in draw.choice(middles)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)] + rows[:3]  # a vector under many ids, and repeated rows
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    want, at = plain(rows, 4, 8, 6)
    found, centroids = got(clusters.cluster(df, k=4, rounds=8, dims=6))
    assert found == want and all(at[c] == v for c, v in centroids.items())
    # Bounds spare most vectors the later scans, once centroids settle.
    scans = [h.count() for h in pushed]
    assert scans[0] == len(rows) and scans[-1] == 0 and sum(scans) < 0.65 * 9 * len(rows)


def test_ties_and_whole_steps(spark):
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate((a, b) for a in range(8) for b in range(8))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for scale in (1, 2):
        assert got(clusters.cluster(df, k=5, rounds=4, dims=2, scale=scale))[0] == plain(rows, 5, 4, 2, scale)[0]


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (1, [5.0, 2.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [float("nan"), 0.0]), (6, [float("inf"), 0.0]),
            (None, [1.5, 2.0]), (7, []), (8, [-0.001, 0.0]), (9, [5e5, -5e5])]
    docs = spark.createDataFrame([(*r, 3, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, v string")
    want, at = plain(rows, 40, 5, 2)
    found, centroids = got(clusters.cluster(docs, dims=2))
    assert found == want and len(at) == 4 and all(at[c] == v for c, v in centroids.items())
    only = docs.where("vec_id is null")
    assert got(clusters.cluster(only, dims=2))[0] == [(None, 0, 0)]
    assert clusters.cluster(docs.limit(0), dims=2).count() == 0 and clusters.cluster(docs, dims=3).count() == 0
    far = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(PySparkException, match="no long holds"):
        clusters.cluster(far, dims=2)


def test_distances_are_exact():
    draw = np.random.default_rng(0)
    for size in (100, clusters.LARGEST - 1):
        v, c = (draw.integers(-size, size, (20, 64)) for _ in range(2))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
        assert clusters.distances(v, c).tolist() == want


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query(spark, folder):
    run = QUERIES["op12_centroid_clustering"](spark, folder)
    same_width = SQL["op12_centroid_clustering"].replace("AS INTEGER", "AS BIGINT")
    assert compare.mismatch(run.withColumn("cluster", run.cluster.cast("bigint")), compare.duck(folder), same_width) is None
