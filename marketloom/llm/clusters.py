"""Operator 12: k-means by heap-ordered bounds, exact in whole numbers.

A vector's key is its gap (distance to the second nearest centroid less that to its own, rounded down) plus
the drift that its cluster has accumulated so far: in each round the own centroid's move plus the farthest
move of any other. While the key is at least the accumulated drift, the own centroid is still strictly
the nearest. So a cluster is a heap ordered by key, and a round pops the vectors whose keys the drift has
passed, scans all centroids for these alone, and pushes them with a new key.

Heaps lie on shared storage: the vectors that a round pushes are written once, sorted by cluster and key,
and never rewritten. As drift only grows, a vector leaves its heap in the one round that takes the drift past
its key, so popping is a filter on cluster and key that Parquet's statistics turn into the low end of each
cluster's stretch. Sums change by the vectors that move. Nothing is shuffled but one row of sums for each
cluster and task, and only centroids and their drifts reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import pick, steps
from marketloom.session import stored

#: Whole numbers a component of 1.0 is cut into.
SCALE = 256
#: Larger components (after scaling) could give distances that no long holds.
LARGEST = 1 << 27
#: Distances are kept in this many parts of one.
_FINE = 1024
#: Numbers below this make all products and sums exact in doubles.
_DOUBLE_SAFE = 1 << 20
_ROWS = 4096


def grid(embeddings: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and ``v`` (floor of scale times each component) of the vectors of ``dims`` finite components."""
    rows = pick(embeddings, vec_id=id_col, x=vector_col)
    finite = F.forall("x", lambda a: a.isNotNull() & ~F.isnan(a.cast("double")) & (F.abs(a.cast("double")) != float("inf")))
    cut = F.transform("x", lambda a: F.floor(a.cast("double") * scale).cast("int"))
    fits = F.forall("x", lambda a: F.abs(a.cast("double") * scale) < LARGEST)
    return (rows.where(F.coalesce((F.size("x") == dims) & finite, F.lit(False)))
            .select("vec_id", F.when(fits, cut).otherwise(F.raise_error(F.lit(
                f"a component beyond {LARGEST // scale} gives distances that no long holds"))).alias("v")))


def distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids, exact."""
    if max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0)) < _DOUBLE_SAFE and v.shape[1] <= 1024:
        a, c = v.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (a @ c.T)).astype(np.int64)
    return np.stack([np.square(v - c).sum(1) for c in centroids], axis=1)


def _matrix(values: pa.Array, dims: int) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(values), dims)


@dataclass
class Centroids:
    """Where the centroids are, how far each cluster's bounds have drifted, and the sums of their vectors."""

    at: np.ndarray
    drift: list[int]
    sums: list[list[int]]
    counts: list[int]

    @classmethod
    def start(cls, vectors: list[list[int]], dims: int) -> Centroids:
        k = len(vectors)
        return cls(np.array(vectors, np.int64).reshape(k, dims), [0] * k, [[0] * dims for _ in range(k)], [0] * k)

    def move(self, changes: Iterable) -> None:
        """Add the changes of sums and counts, put centroids at their vectors' mean, and add up the drift."""
        for r in changes:
            self.sums[r.cluster][r.place] += int(r.total)
            if r.place == 0:
                self.counts[r.cluster] += r.n
        moved = np.array([[s // n for s in sums] if n else old for sums, n, old in zip(self.sums, self.counts, self.at.tolist())],
                         np.int64).reshape(self.at.shape)
        moves = [math.isqrt(int(d) * _FINE ** 2) + 1 if d else 0 for d in np.square(moved - self.at).sum(1).tolist()]
        for c, own in enumerate(moves):
            self.drift[c] += own + max(moves[:c] + moves[c + 1:], default=0)
        self.at = moved


def assign(rows: DataFrame, centroids: Centroids, dims: int) -> DataFrame:
    """vec_id, v, ``cluster``, ``key`` and ``was`` (the cluster before, if any) after scanning all centroids."""
    at, drift = centroids.at, np.array(centroids.drift, np.int64)
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "v"):
            d = distances(_matrix(batch.column("v"), dims), at)
            own = d.argmin(axis=1)  # ties: the smaller number
            near = d[np.arange(len(d)), own]
            d[np.arange(len(d)), own] = np.iinfo(np.int64).max
            # The own distance is rounded up, the other one down, so that doubles can't flatter a gap.
            second = np.floor(np.sqrt(d.min(axis=1)) * _FINE) - 1
            key = (second - np.ceil(np.sqrt(near) * _FINE) - 1).astype(np.int64) + drift[own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(own.astype(np.int32)), pa.array(key), batch.column("was")],
                ["vec_id", "v", "cluster", "key", "was"])

    return rows.mapInArrow(run, f"vec_id {kind}, v array<int>, cluster int, key bigint, was int")


def _changes(pushed: DataFrame, dims: int) -> DataFrame:
    """cluster, place, total, n: what the vectors that moved add to each cluster's sums. A row per cluster and
    place leaves each task."""
    moved = pushed.where("was is null or was <> cluster").select("v", "cluster", "was")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in steps(batches, "v"):
            v = np.concatenate([_matrix(batch.column("v"), dims), np.ones((len(batch), 1), np.int64)], axis=1)
            for sign, name in ((1, "cluster"), (-1, "was")):
                c = batch.column(name).fill_null(-1).to_numpy(zero_copy_only=False)
                for each in np.unique(c[c >= 0]).tolist():
                    sums[each] = sums.get(each, 0) + sign * v[c == each].sum(axis=0)
        for each, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([each] * dims, pa.int32()), pa.array(range(dims), pa.int32()), pa.array(s[:dims]),
                 pa.array([int(s[dims])] * dims, pa.int64())], ["cluster", "place", "total", "n"])

    return (moved.mapInArrow(run, "cluster int, place int, total bigint, n bigint").groupBy("cluster", "place")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")))


def _keys(least: list[int] | None = None, below: list[int] | None = None) -> Column:
    """Rows whose key lies between two drifts of their cluster, in a form that Parquet's statistics can answer."""
    terms = [f"cluster = {c}" for c in range(len(least or below))]
    if least:
        terms = [f"{t} AND key >= {d}" for t, d in zip(terms, least)]
    if below:
        terms = [f"{t} AND key < {d}" for t, d in zip(terms, below)]
    return F.expr(" OR ".join(f"({t})" for t in terms))


def _heap(df: DataFrame) -> DataFrame:
    """Write vectors once, sorted within each task by cluster and key: the low end of a stretch is the heap's top."""
    return stored(df.sortWithinPartitions("cluster", "key"), "heap")


def cluster(embeddings: DataFrame, *, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = SCALE, seed: int = 2,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid`` of each vector.

    Vectors become whole numbers (floor of ``scale`` times each component). Centroids start as the k vectors
    with the smallest SHA-256 of ``seed:id``; each round assigns every vector to the nearest centroid (ties:
    smaller number) and moves non-empty centroids to the floor of their vectors' mean; at last vectors are
    assigned again. Distances are squared. ``n_scanned`` is how often a vector met all centroids.

    Vectors that are NULL, of another size, or hold NULL or non-finite components take no part. Equal ids are
    told apart by their vectors; a vector without an id is assigned but starts no centroid (if none has an id, the
    smallest vector starts the only one). With fewer vectors than k there are fewer centroids; without any the
    result is empty. Components beyond 2^27 after scaling are refused, as no long could hold their distances.
    """
    base = stored(grid(embeddings, dims, scale, id_col, vector_col), "grid")
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = base.where("vec_id is not null").select("v", named.alias("h")).orderBy("h", "v").limit(k).collect()  # k rows
    if not first:
        first = base.select("v").orderBy("v").limit(1).collect()  # vectors without ids only
    state = Centroids.start([r.v for r in first], dims)
    if not first:
        state.at = np.zeros((1, dims), np.int64)  # no vectors: nothing will be assigned to it
        state.drift, state.sums, state.counts = [0], [[0] * dims], [0]

    heaps: list[DataFrame] = []
    passed: list[int] = []  # the drift that older heaps are popped to
    todo = base.select("*", F.lit(None).cast("int").alias("was"))
    for step in range(rounds + 1):
        if step:
            todo = reduce(DataFrame.unionByName, [
                heap.where(_keys(None if heap is heaps[-1] else passed, state.drift))
                .select("vec_id", "v", F.col("cluster").alias("was")) for heap in heaps])
        heaps.append(_heap(assign(todo, state, dims)))
        passed = list(state.drift)
        if step < rounds:
            state.move(_changes(heaps[-1], dims).collect())  # k times dims rows

    settled = reduce(DataFrame.unionByName, [
        (heap if heap is heaps[-1] else heap.where(_keys(state.drift))).select("vec_id", "v", "cluster") for heap in heaps])
    return _measured(settled, state, dims)


def _measured(settled: DataFrame, state: Centroids, dims: int) -> DataFrame:
    """Exact distances to the final centroids, and their sums."""
    at, kind = state.at, settled.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "v"):
            own = batch.column("cluster").to_numpy()
            d = np.square(_matrix(batch.column("v"), dims) - at[own]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("cluster"), pa.array(d)],
                                             ["vec_id", "cluster", "distance"])

    placed = stored(settled.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint"), "placed")
    sums = {r.cluster: r.d for r in placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    spark = settled.sparkSession
    named = spark.createDataFrame([(c, sums.get(c, 0), sum(sums.values()), v) for c, v in enumerate(at.tolist())],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return placed.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")



def cluster_sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = SCALE, seed: int = 2) -> str:
    """The same in SQL, every vector against every centroid in each round."""
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(FLOOR({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
               FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims})""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS mid
               FROM (SELECT v, sha256('{seed}:' || vec_id) AS h FROM kept ORDER BY h, v LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, v, MIN((d, c)) AS best FROM (
            SELECT r, vec_id, v, c, list_sum(list_transform(generate_series(1, {dims}), lambda i: (v[i] - mid[i]) * (v[i] - mid[i])))::BIGINT AS d
            FROM kept, c{i}) GROUP BY r, vec_id, v)""")
        if i < rounds:
            parts.append(f"""m{i} AS MATERIALIZED (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS mean FROM (
                SELECT best[2] AS c, p, SUM(x)::BIGINT AS s, COUNT(*) AS n
                FROM (SELECT best, unnest(v) AS x, unnest(generate_series(1, {dims})) AS p FROM a{i}) GROUP BY ALL) GROUP BY c)""")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.c, COALESCE(mean, mid) AS mid FROM c{i} LEFT JOIN m{i} ON c{i}.c = m{i}.c)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance,
       CAST(SUM(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia, CAST(SUM(best[1]) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(mid, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = best[2]"""
