"""SimHash near duplicates against all pairs by brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import components, simhash
from marketloom.llm.queries import QUERIES
from tests.llm import brute


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_on_a_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op6_simhash_near_dedup"](spark, sf_dir)) == sorted(brute.simhash(docs), key=str)


@pytest.mark.parametrize("text", ["", " \t\n", "one", "One TWO", "Ünï É A b", "a b c", "a\x85b c d e", "x " * 70_000,
                                  "ABC def " * 9 + "ghi"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


@pytest.mark.parametrize("tile", [3, 1 << 14])
@pytest.mark.parametrize("radius", [1, 2, 3])
def test_planted_fingerprints(spark, tile, radius):
    """Chains, dense groups and noise: components equal those over all pairs, whatever the size of a tile."""
    draw = random.Random(radius)
    prints = [draw.getrandbits(64) for _ in range(120)]
    for base in prints[:12]:
        for _ in range(draw.randint(1, 25)):
            base ^= 1 << draw.randrange(64) if draw.random() < 0.5 else (1 << draw.randrange(64)) | (1 << draw.randrange(64))
            prints.append(base)
    prints += [prints[5] ^ (1 << k) for k in range(64)] + [0, 0, (1 << 64) - 1]
    rows = [(i, int(np.uint64(p).astype(np.int64))) for i, p in enumerate(prints)]
    named = {r.fp: r.least for r in simhash.classes(spark.createDataFrame(rows, "doc_id long, fp long"), radius=radius, tile=tile).collect()}
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    assert [named[f] for _, f in rows] == [root(i) for i in range(len(prints))]


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(2000, 2000), (3001, 3000)]
    random.Random(1).shuffle(links)
    df = spark.createDataFrame(links, "x long, y long")
    found = {r.node: r.root for r in components.components(df, F.col("x"), F.col("y")).collect()}
    assert found == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(300)}, 3000: 3000, 3001: 3000}
    assert components.components(df.limit(0), F.col("x"), F.col("y")).count() == 0


PROSE = " ".join(f"word{i}" for i in range(400))


def test_small_cases(spark):
    docs = [(None, PROSE), (7, PROSE + " more"), (5, PROSE.upper()), (5, PROSE), (9, None), (8, ""), (None, " "), (None, "alone here"),
            (3, "x " * 100_000), (11, "something else")]
    frame = spark.createDataFrame([(*d, "f", 1) for d in docs], "doc_id long, text string, fp string, component_id int")
    assert got(simhash.near_duplicates(frame)) == sorted(brute.simhash(docs), key=str)
    assert simhash.near_duplicates(frame.limit(0)).count() == 0
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    # the smallest id of each component; rows without an id stay where no row of their component has one
    want = sorted([d for d, _, c in {r for r in brute.simhash(docs) if r[0] is not None} if d == c] + [-1])
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == want
    assert simhash.keep_one(frame.limit(0)).count() == 0


def test_rows_equal_throughout_leave_one(spark):
    frame = spark.createDataFrame([(1, PROSE, "a")] * 3 + [(None, "no id", "b")] * 2, "doc_id long, text string, k1 string")
    assert sorted(r.k1 for r in simhash.keep_one(frame).collect()) == ["a", "b"]


def test_rows_that_differ_in_a_map_are_different(spark):
    """Of equal texts without an id one row stays per component; maps that list the same entries are equal."""
    shape = "doc_id long, text string, m map<string,int>, deep array<map<int,string>>"
    one, two = {"a": 1, "b": 2}, {"b": 2, "a": 1}
    rows = [(1, PROSE, one, [{1: "x"}]), (1, PROSE, two, [{1: "x"}]), (2, "other words", {"a": 2}, None), (2, "other words", None, None)]
    kept = simhash.keep_one(spark.createDataFrame(rows, shape))
    assert kept.columns == ["doc_id", "text", "m", "deep"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, PROSE), (2, "other words")]
    hashed = spark.createDataFrame(rows, shape).select(*[simhash._hashable(f.name, f.dataType).alias(f.name) for f in kept.schema.fields])
    assert [r.m for r in hashed.collect()][0] == [r.m for r in hashed.collect()][1] and len({r.m for r in hashed.collect()}) == 3


def test_a_hot_fingerprint_meets_its_class_as_one_row(spark):
    """Half of all rows share a fingerprint; the join by fingerprint sees it once."""
    docs = spark.range(0, 4000, 1, 8).selectExpr(
        "id as doc_id", "if(id % 2 = 0, 'the very same words in every copy', concat('text number ', id, ' of its own ', id * 7)) as text")
    seen = []
    really = simhash.stored

    def kept(df, label="table"):
        out = really(df, label)
        seen.append((label, out))
        return out

    simhash.stored = kept
    try:
        left = simhash.keep_one(docs)
    finally:
        simhash.stored = really
    least = dict(seen)["least"]
    assert least.count() == least.select("fp").distinct().count()
    assert [r.doc_id for r in left.where("doc_id % 2 = 0").collect()] == [0]


def test_a_large_component_is_not_pinned_to_a_task(spark):
    """Fingerprints meet their component straight from storage, so the join by root can be split; a chain of half of
    all fingerprints is one component."""
    chain, value = [], 0
    for bit in range(40):
        value |= 1 << bit
        chain.append(value)
    apart = [(i * 0x9E3779B97F4A7C15) % 2**63 for i in range(1, 41)]
    printed = spark.createDataFrame([(i, f) for i, f in enumerate(chain + apart)], "doc_id long, fp long")
    named = simhash.classes(printed)
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" in plan
    got = {r.fp: r.least for r in named.collect()}
    assert len(got) == 80 and {got[f] for f in chain} == {0}
