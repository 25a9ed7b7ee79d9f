"""Nearest neighbours: recall against brute force, exact scores, ties, and rows that take no part."""

import math

import numpy as np
import pytest

from marketloom.llm import graph_search
from marketloom.llm.queries import QUERIES

SHAPE = "vec_id long, embedding array<double>"


def brute(rows, k=5, every=50):
    """{query id: its k best (vec_id, score)}"""
    usable = [(i, np.array(v, float)) for i, v in rows
              if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    ids = np.array([i for i, _ in usable])
    x = np.array([v for _, v in usable])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i, v in zip(ids, unit):
        if i % every == 0:
            s = unit @ v
            order = sorted((-round(float(a), 12), int(b)) for a, b in zip(s, ids) if b != i)
            out[int(i)] = [(b, -a) for a, b in order[:k]]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = collected(QUERIES["op3_graph_nearest_neighbours"](spark, folder)), brute(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.97 * 5 * len(want)
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        for i, score in found:
            a, b = vectors[q], vectors[i]
            assert score == pytest.approx(a @ b / math.sqrt((a @ a) * (b @ b)), abs=1e-12)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))


def test_many_shards_and_copies(spark):
    draw = np.random.default_rng(0)
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(draw.normal(size=(900, 8)))]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]) for i in range(600)]  # one vector, many ids
    rows += [(50, rows[50][1])] * 3  # repeated rows
    got = collected(graph_search.nearest(spark.createDataFrame(rows, SHAPE), shard=200))
    want = brute(dict(rows).items())
    same = sum([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)
    assert got.keys() == want.keys() and same >= 0.97 * len(want)
    assert [i for i, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005] and [i for i, _ in got[1050]] == [1000, 1001, 1002, 1003, 1004]


def test_blocks_meet_shards_where_they_lie(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "QUERY_BLOCK", 10)
    draw = np.random.default_rng(1)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(draw.normal(size=(800, 8)))]
    found = graph_search.nearest(spark.createDataFrame(rows, SHAPE), every=4, shard=40)
    got, want = collected(found), brute(rows, every=4)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.97 * 5 * len(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Broadcast", "Generate"))  # no copy of a block for each shard, in the driver or in a shuffle


def test_small_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, [1.0, 1.0, 1.0]), (100, [1e300, 1e300]),
            (150, [1e-300, 0.0]), (200, None), (11, [-1.0, 0.0])]
    docs = spark.createDataFrame([(*r, 1.0, "x") for r in rows], f"{SHAPE}, score double, vector string")
    got = collected(graph_search.nearest(docs))
    assert [i for i, _ in got[0]] == [1, 150, 100, 2, 11] and got.keys() == {0, 100, 150}
    assert sorted(i for i, _ in got[100]) == [0, 1, 2, 11, 150] and got[100][-1][0] == 11
    assert got[0][0][1] == 1.0 and got[0][2][1] == pytest.approx(2 ** -0.5)
    assert collected(graph_search.nearest(docs.where("vec_id = 0"))) == {}
    assert collected(graph_search.nearest(docs.limit(0))) == {}


def test_pruning_keeps_diverse_edges():
    unit = graph_search._units(np.array([[1, 0], [1, 0.1], [1, 0.11], [1, -0.3]]))
    assert graph_search.robust_prune(unit, np.array([0]), np.array([[1, 2, 3, -1, 1]]), 3, 1.2).tolist() == [[1, 3, -1]]
