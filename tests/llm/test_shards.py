"""Sharding: the table against turns taken one by one, placement against plain hashing."""

import hashlib
from collections import Counter

import pytest

from marketloom.llm import shards
from marketloom.llm.queries import QUERIES, SHARDS

NAMES = [f"s{i}" for i in range(7)]


def by_turns(names, slots):
    """Every shard's whole permutation written out, and slots claimed in turns."""
    orders = []
    for n in names:
        first, stride = shards.preference(n, slots)
        orders.append([(first + k * stride) % slots for k in range(slots)])
    assert all(sorted(o) == list(range(slots)) for o in orders)
    owner = {}
    while len(owner) < slots:
        for i, order in enumerate(orders):
            wanted = next((s for s in order if s not in owner), None)
            if wanted is not None:
                owner[wanted] = i
    return [owner[s] for s in range(slots)]


@pytest.mark.parametrize("slots", [7, 11, 101, 503])
def test_table_is_filled_in_turns(slots):
    assert shards.lookup_table(NAMES, slots) == by_turns(NAMES, slots)


def test_even_and_little_moves():
    owners = shards.lookup_table(NAMES, 5003)
    sizes = Counter(owners).values()
    assert max(sizes) - min(sizes) <= 1
    after = shards.lookup_table(NAMES[:-1], 5003)
    moved = sum(a != b for a, b in zip(owners, after) if a < 6)
    assert moved < 0.1 * 5003


@pytest.mark.parametrize("names, slots", [([], 7), (["a", "a"], 7), (["a"], 8), (["a"], 1_000_033), (NAMES, 5)])
def test_refused(names, slots):
    with pytest.raises(ValueError):
        shards.lookup_table(names, slots)


def place(key, names, slots=shards.SLOTS):
    slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % slots
    return slot, names[shards.lookup_table(names, slots)[slot]]


def test_query_on_a_whole_table(spark, sf_dir):
    ids = [r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    table = shards.lookup_table(SHARDS)
    less = shards.lookup_table(SHARDS[:-1])
    got = {r.doc_id: (r.slot, r.shard, r.shard_after_loss) for r in QUERIES["op4_sharding"](spark, sf_dir).collect()}
    for d in ids:
        slot = int(hashlib.md5(str(d).encode()).hexdigest()[:15], 16) % shards.SLOTS
        assert got[d] == (slot, SHARDS[table[slot]], SHARDS[less[slot]])
    assert len(got) == len(ids)


def test_small_cases(spark, tmp_path):
    rows = [(None, "x", 1), (None, "y", 2), (1, "x", 3), (1, "x", 3), (2, "z" * 200_000, 4)]
    df = spark.createDataFrame(rows, "k long, shard string, SLOT int")
    got = shards.assign(df, "k", NAMES)
    assert got.columns == ["k", "shard", "SLOT", "slot", "shard"]
    assert sorted((r[0] or 0, r[3], r[4]) for r in got.collect()) == sorted(
        (k or 0, *place("" if k is None else str(k), NAMES)) for k, _, _ in rows)
    assert shards.assign(df.limit(0), "k", NAMES).count() == 0
    placed = shards.assign(df.select("k"), "k", NAMES)
    assert sum(r.n for r in shards.balance(placed).collect()) == 5
    shards.write(placed, str(tmp_path / "out"), files_per_shard=3)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).select("k", "slot", "shard").collect())) == sorted(
        map(str, placed.collect()))
