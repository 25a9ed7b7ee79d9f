"""Operator 3: approximate nearest neighbours by cosine on robust-pruned directed graphs.

Vectors are dealt by hash into shards of bounded size, and a task builds one shard's graph: greedy
searches from the graph so far propose a vector's neighbours, and relaxed distance pruning keeps
those that no kept one stands in for. Each block of queries is then beam-searched in every shard,
and the shards' best are merged. Scores are computed anew in double precision on the original vectors.

Equal vectors share one node. A node keeps the ids of its k + 1 smallest members: with ties going to the
smaller id, no other member can be among a query's k nearest, so nothing is lost.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import pick
from marketloom.session import stored

#: Vectors of a shard on average; edges of a node; beam while building; relaxation of pruning; beam while searching.
SHARD, DEGREE, BUILD_BEAM, ALPHA, BEAM = 8192, 32, 64, 1.5, 128
#: Nodes inserted at once, queries searched at once.
BATCH, QUERY_BLOCK = 512, 1024
#: Nodes that searches start from, spread over a shard.
STARTS = 16
#: A stored row of some megabytes is a page of its own; else Parquet looks at a page's size after a hundred rows only.
ROW_PAGES = {"parquet.page.size.row.check.min": "1"}


def beam_search(unit: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and distances (1 - cosine) of the ``beam`` nearest found for each query, nearest first.

    All queries advance together: each expands its nearest node not yet expanded, until none is left.
    ``edges`` holds -1 where a node has fewer. Missing places are -1 and infinitely far.
    """
    n, q = len(unit), len(queries)
    seen = np.zeros((q, n + 1), bool)  # the last column swallows -1
    seen[:, n] = True
    nodes = np.full((q, beam), -1, np.int64)
    far = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), bool)
    first = starts[:beam]
    far[:, :len(first)] = 1 - queries @ unit[first].T
    nodes[:, :len(first)] = first
    done[:, :len(first)] = False
    seen[:, first] = True
    order = np.argsort(far, axis=1, kind="stable")
    nodes, far, done = (np.take_along_axis(x, order, 1) for x in (nodes, far, done))
    active = np.arange(q)
    while len(active):
        at = np.argmin(done[active], axis=1)  # the nearest that is not expanded
        left = ~done[active, at]
        active, at = active[left], at[left]
        if not len(active):
            break
        done[active, at] = True
        near = edges[nodes[active, at]]
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        dist = np.where(fresh, 1 - np.einsum("qrd,qd->qr", unit[near], queries[active]), np.inf).astype(np.float32)
        all_nodes = np.concatenate([nodes[active], np.where(fresh, near, -1)], axis=1)
        all_far = np.concatenate([far[active], dist], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        nodes[active] = np.take_along_axis(all_nodes, order, 1)
        far[active] = np.take_along_axis(all_far, order, 1)
        done[active] = np.take_along_axis(all_done, order, 1)
    return np.where(np.isinf(far), -1, nodes), far


def robust_prune(unit: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` neighbours of each of ``own`` from its candidates (-1: none).

    The nearest candidate is kept, and every other drops out that is ``alpha`` times nearer to it than to the
    node itself; and so on.
    """
    b, c = candidates.shape
    ranked = np.sort(candidates, axis=1)
    twice = np.zeros((b, c), bool)
    twice[:, 1:] = ranked[:, 1:] == ranked[:, :-1]
    absent = twice | (ranked < 0) | (ranked == own[:, None])
    vectors = unit[ranked]
    to_own = 1 - np.einsum("bcd,bd->bc", vectors, unit[own])
    to_own[absent] = np.inf
    between = 1 - vectors @ vectors.transpose(0, 2, 1)
    kept = np.full((b, degree), -1, np.int64)
    rows = np.arange(b)
    open_ = to_own.copy()
    for k in range(degree):
        best = np.argmin(open_, axis=1)
        some = np.isfinite(open_[rows, best])
        if not some.any():
            break
        kept[some, k] = ranked[rows, best][some]
        open_[(alpha * between[rows, best] <= to_own) & some[:, None]] = np.inf
        open_[rows, best] = np.inf
    return kept


def build_graph(unit: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 7
                ) -> tuple[np.ndarray, np.ndarray]:
    """Edges (n x degree, -1 where none) and starting nodes of one shard's graph.

    It starts from random edges; two passes over the nodes, in random order and in batches, search,
    prune, and add the edges back. Nodes with too many edges are pruned in turn.
    """
    n = len(unit)
    draw = np.random.default_rng(seed)
    edges = np.full((n, degree), -1, np.int64)
    if n > 1:
        few = min(degree // 2, n - 1)
        edges[:, :few] = (np.arange(n)[:, None] + draw.integers(1, n, (n, few))) % n
    centre = int(np.argmax(unit @ unit.mean(axis=0))) if n else 0
    starts = np.unique(np.concatenate([[centre], draw.permutation(n)[:STARTS - 1]])).astype(np.int64)[:n]
    for relax in (1.0, alpha):
        for batch in np.array_split(draw.permutation(n), max(1, math.ceil(n / BATCH))):
            found, _ = beam_search(unit, edges, starts, unit[batch], beam)
            edges[batch] = robust_prune(unit, batch, np.concatenate([found, edges[batch]], axis=1), degree, relax)
            # the way back, for all nodes pointed to at once
            source = np.repeat(batch, degree)
            target = edges[batch].ravel()
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            nodes, begin, count = np.unique(target, return_index=True, return_counts=True)
            for lo in range(0, len(nodes), BATCH):
                own, own_begin, own_count = nodes[lo:lo + BATCH], begin[lo:lo + BATCH], count[lo:lo + BATCH]
                width = int(own_count.max())
                back = np.full((len(own), width), -1, np.int64)
                row = np.repeat(np.arange(len(own)), own_count)
                column = np.arange(own_count.sum()) - np.repeat(np.cumsum(own_count) - own_count, own_count)
                back[row, column] = source[own_begin[0]:own_begin[0] + own_count.sum()]
                if width > 4 * degree:  # of very many, those nearest; pruning would keep no others
                    off = np.where(back >= 0, 1 - np.einsum("bcd,bd->bc", unit[back], unit[own]), np.inf)
                    back = np.take_along_axis(back, np.argsort(off, axis=1, kind="stable")[:, :4 * degree], 1)
                edges[own] = robust_prune(unit, own, np.concatenate([back, edges[own]], axis=1), degree, relax)
    return edges, starts


def _usable(vector: Column) -> Column:
    """Not NULL, every component there and finite, and not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def nodes_of(vectors: DataFrame, k: int) -> DataFrame:
    """``vector`` and ``ids`` (its k + 1 smallest ids, sorted): one row for each distinct vector.

    The ids are cut to k + 1 within each task before the shuffle, so a vector that a third of the rows
    share does no harm.
    """
    least = Window.partitionBy("vector").orderBy("vec_id")
    return (vectors.withColumn("at", F.dense_rank().over(least)).where(F.col("at") <= k + 1)
            .groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")))


def _matrix(vectors: Iterable[np.ndarray], dims: int) -> np.ndarray:
    """Rows in double precision, scaled by powers of two (which changes no digit) so that squares stay finite."""
    x = np.array(list(vectors), np.float64).reshape(-1, dims)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def _units(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def graphs(nodes: DataFrame, count: int, dims: int, *, shard: int = SHARD, degree: int = DEGREE, beam: int = BUILD_BEAM,
           alpha: float = ALPHA) -> DataFrame:
    """One row per shard: its vectors, ids, edges and starts as arrays of numbers in binary."""
    shards = max(1, math.ceil(count / shard))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("least", kind="stable")  # the same order however often the task runs
        x = _matrix(frame["vector"], dims)
        edges, starts = build_graph(_units(x), degree, beam, alpha)
        sizes = frame["ids"].map(len).to_numpy(np.int64)
        return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])], "vectors": [x.tobytes()], "edges": [edges.astype(np.int32).tobytes()],
                             "starts": [starts.tobytes()], "sizes": [sizes.tobytes()],
                             "ids": [np.concatenate(frame["ids"].to_list()).astype(np.int64).tobytes()]})

    placed = nodes.select("vector", "ids", F.element_at("ids", 1).alias("least"),
                          F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"))
    return placed.groupBy("shard").applyInPandas(
        build, "shard int, vectors binary, edges binary, starts binary, sizes binary, ids binary")


def nearest(vectors: DataFrame, *, k: int = 5, every: int = 50, shard: int = SHARD, degree: int = DEGREE,
            build_beam: int = BUILD_BEAM, alpha: float = ALPHA, beam: int = BEAM, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found for each row whose id is divisible by
    ``every``, by cosine, nearest first, ties to the smaller id.

    All rows are indexed and are candidates, but for those of the query's own id. Vectors that are NULL, zero, or
    hold a NULL or non-finite component take no part, nor do rows without an id, nor vectors of another length than the
    most usual one (the shorter on ties). Rows that repeat both id and vector count once. Fewer candidates than ``k``
    give fewer rows; an empty table gives none.
    """
    rows = pick(vectors, vec_id=id_col, vector=vector_col)
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    nodes = stored(nodes_of(rows, k), "nodes")
    usual = nodes.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims").first()
    dims, count = (usual["dims"], usual["n"]) if usual else (0, 0)
    index = stored(graphs(nodes.where(F.size("vector") == dims), count, dims, shard=shard, degree=degree, beam=build_beam,
                          alpha=alpha), "graphs", **ROW_PAGES)
    queries = stored(rows.where((F.col("vec_id") % every == 0) & (F.size("vector") == dims)).distinct(), "queries")
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    blocked = stored(queries.groupBy(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).alias("block"))
                     .agg(F.collect_list("vec_id").alias("query_ids"), F.flatten(F.collect_list("vector")).alias("query_vectors")), "blocks",
                     **ROW_PAGES)
    # Tasks read a part of the shards and a part of the blocks where they are stored. Blocks exploded over the shards look
    # as small to the optimizer as one of them, and would be broadcast through the driver, times the number of shards.
    met = index.drop("shard").hint("shuffle_replicate_nl").crossJoin(blocked.drop("block"))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                query_ids, flat = (batch.column(c)[i].values.to_numpy() for c in ("query_ids", "query_vectors"))
                get = lambda c, kind: np.frombuffer(batch.column(c)[i].as_buffer(), kind)  # noqa: E731, B023
                x = get("vectors", np.float64).reshape(-1, dims)
                edges = get("edges", np.int32).reshape(len(x), -1).astype(np.int64)
                ends = np.cumsum(get("sizes", np.int64))
                yield best(x, edges, get("starts", np.int64), ends, get("ids", np.int64), query_ids,
                           _matrix(flat.reshape(-1, dims), dims), k, beam)

    found = met.mapInArrow(search, "query_id bigint, query int, vec_id bigint, score double")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def best(x: np.ndarray, edges: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray, query_ids: np.ndarray,
         queries: np.ndarray, k: int, beam: int) -> pa.RecordBatch:
    """The k best of one shard for each query, with scores in double precision. ``query`` tells apart queries
    that share an id."""
    found, _ = beam_search(_units(x), edges, starts, _units(queries), min(beam, max(1, len(x))))
    lengths, out = np.linalg.norm(x, axis=1), []
    for q, (own, vector) in enumerate(zip(query_ids, queries)):
        nodes = found[q][found[q] >= 0]
        scores = (x[nodes] @ vector) / (lengths[nodes] * np.linalg.norm(vector))
        top = np.argsort(-scores, kind="stable")[:4 * (k + 1)]
        mark = zlib.crc32(vector.tobytes()) >> 1
        pairs = [(-s, int(i), mark) for s, n in zip(scores[top], nodes[top]) for i in ids[(ends[n - 1] if n else 0):ends[n]] if i != own]
        out += [(int(own), m, i, float(-s)) for s, i, m in sorted(pairs)[:k]]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    columns = zip(*out) if out else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["query_id", "query", "vec_id", "score"])
