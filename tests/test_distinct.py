"""Distinct counts by bitmaps equal those of sets."""

import random

from pyspark.sql import functions as F

from marketloom.operators.distinct import bitmaps, counted, dictionary, extended, merged, numbered_by


def test_counts_equal_sets(spark):
    pick = random.Random(5)
    ids = [0, 1, -1, 32_768, 32_769, -32_768, 2**40, 2**62, -2**62, *range(500)]
    data = [(pick.choice("abc") if i % 9 else None, None if i % 11 == 0 else pick.choice(ids), i % 4) for i in range(6000)]
    data += [("nulls", None, 0)] * 3
    df = spark.createDataFrame(data, "g string, id long, part int").repartition(7)
    maps = bitmaps(df, "id", ["g", "part"])
    want = {}
    for g, i, _ in data:
        want.setdefault(g, set()).update([] if i is None else [i])
    assert {(r.g, r.n) for r in counted(maps, ["g"], "n").collect()} == {(g, len(s)) for g, s in want.items()}
    assert counted(maps, [], "n").first().n == len(set().union(*want.values()))
    halves = merged(maps.where("part < 2"), ["g"]).unionByName(merged(maps.where("part >= 2"), ["g"]))
    assert counted(halves, [], "n").first().n == len(set().union(*want.values()))


def test_no_id_is_shuffled(spark):
    """Before the exchange rows are bitmaps of a task."""
    df = spark.range(0, 100_000, 1, 3).select((F.col("id") % 7).alias("g"), "id")
    plan = bitmaps(df, "id", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bitmap_construct_agg" in plan.split("Exchange")[1]


def test_nothing_to_count(spark):
    maps = bitmaps(spark.createDataFrame([], "g string, id long"), "id", ["g"])
    assert counted(maps, ["g"], "n").count() == 0 and counted(maps, [], "n").first().n == 0


def test_a_dictionary_keeps_its_numbers(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"t{i % 50}") for i in range(900)], "i int, t string").repartition(5)
    first = dictionary(df.where("i < 20"), "t", "n")
    both = extended(first, df, "t", "n")
    old, new = ({r.t: r.n for r in d.collect()} for d in (first, both))
    assert old.items() <= new.items() and sorted(new.values()) == list(range(df.select("t").where("t IS NOT NULL").distinct().count()))
    met = numbered_by(df, both, "t", "i").collect()
    assert len(met) == 900 and all(r.n == new.get(r.t) for r in met)
    assert extended(both, df, "t", "n").count() == len(new)
    none = dictionary(df.where("i < 0"), "t", "n")
    assert sorted(r.n for r in extended(none, df, "t", "n").collect()) == list(range(len(new)))
