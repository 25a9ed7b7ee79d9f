"""Row numbers, buckets and spread joins: the distributed path must equal the plain one."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.operators.modelling import rollup_items
from marketloom.operators.borders import at_or_after, rows_at
from marketloom.operators.ranking import bucket_of, bucket_starts, first_within, global_positions, ntile_scores, number_in_steps
from marketloom.operators.skew import spread_join


@pytest.fixture(autouse=True, scope="module")
def many_partitions(spark):
    """Keep small results in several partitions, as large ones would be."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def skewed(spark, n=4000):
    """A third of the rows in one group, a part in the NULL group, the rest in small ones."""
    pick = random.Random(7)
    data = [(i, ("hot" if i % 3 == 0 else None if i % 7 == 0 else f"g{i % 500}"), pick.randrange(50)) for i in range(n)]
    pick.shuffle(data)
    return spark.createDataFrame(data, "id int, g string, t int").repartition(6)


def test_global_positions_are_gapless(spark):
    df = skewed(spark).withColumn("wide", F.lit(1))
    got = global_positions(df.select("id", "t"), [F.asc("t"), F.asc("id")], "pos")
    want = skewed(spark).withColumn("pos", F.row_number().over(Window.orderBy("t", "id")) - 1)
    assert got.columns == ["id", "t", "pos"]
    assert sorted((r.id, r.pos) for r in got.collect()) == sorted((r.id, r.pos) for r in want.collect())


def test_number_in_steps(spark):
    """Rows of a third of the table in one group, NULL groups and NULL times included."""
    df = skewed(spark).withColumn("t", F.when(F.col("t") > 3, F.col("t")))
    order = [F.asc_nulls_first("t"), F.asc("id")]
    got = number_in_steps(df, ["g"], F.floor(F.col("t") / 7), order, "n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert got.columns == want.columns and got.schema["n"].dataType == want.schema["n"].dataType
    assert sorted((r.id, r.n) for r in got.collect()) == sorted((r.id, r.n) for r in want.collect())


def test_no_task_numbers_a_whole_group(spark):
    """The window over rows is partitioned by group and step; the one by group alone sees counts."""
    plan = number_in_steps(skewed(spark), ["g"], F.col("t"), [F.asc("t"), F.asc("id")], "n")._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):
        if "windowspecdefinition(g#" in line:
            assert "_step" in line.split("row_number()")[-1] or "sum(_n" in line


@pytest.mark.parametrize("cells, at_once", [(4096, 1 << 16), (2, 1), (7, 20)])
@pytest.mark.parametrize("n", [0, 1, 3, 7, 1500, 1503])
def test_ntile_scores(spark, n, cells, at_once):
    df = spark.range(n).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), (F.col("id") * 7919 % 101).alias("v"),
                               (F.col("id") % 3).alias("w"))
    got = ntile_scores(df, "id", {"up": ["v"], "down": ["-v", "w"]}, 5, cells=cells, at_once=at_once)
    want = df.withColumn("up", F.ntile(5).over(Window.orderBy("v", "id"))).withColumn(
        "down", F.ntile(5).over(Window.orderBy(F.desc("v"), "w", "id")))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.dtypes == want.dtypes


def test_bucket_sizes_of_seven_rows(spark):
    got = [r[0] for r in spark.range(7).select(bucket_of(F.col("id"), 7, 5)).collect()]
    assert got == [1, 1, 2, 2, 3, 4, 5]


def test_first_within_trims_before_the_shuffle(spark):
    kept = first_within(skewed(spark), ["g"], [F.asc("t"), F.asc("id")], 2)
    assert kept.groupBy("g").count().agg(F.max("count")).first()[0] == 2
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join(spark, how):
    child = skewed(spark)
    parent = spark.createDataFrame([("hot", 1)] + [(f"g{i}", i) for i in range(0, 500, 2)] + [("unused", 9)],
                                   "g string, p int")
    got = spread_join(child, parent, "g", "id", how)
    want = child.join(parent, "g", how)
    assert set(got.columns) == set(want.columns)
    key = lambda r: (r.id, str(r.g), r.t, str(r.p))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


SPLIT_EARLY = {"spark.sql.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}


@pytest.fixture
def split_early(spark):
    before = {k: spark.conf.get(k) for k in SPLIT_EARLY}
    for k, v in SPLIT_EARLY.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_hot_product_is_split_between_tasks(spark, split_early):
    """Items meet products straight from two shuffles, so adaptive execution can split a best seller."""
    items = spark.range(0, 600_000, 1, 8).selectExpr(
        "id as order_item_id", "id % 150000 as order_id", "if(id % 3 = 0, 7, id % 20000) as product_id", "1 as quantity",
        "cast(10 as decimal(14,2)) as unit_price")
    products = spark.range(20_000).selectExpr(
        "id as product_id", "cast(1 as decimal(14,2)) as unit_cost", "cast(2 as decimal(14,2)) as list_price")
    rolled = rollup_items(items, products)
    assert len(rolled.collect()) == 150_000
    assert "skew=true" in rolled._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_of_a_spread_join_is_split(spark, split_early, how):
    """Both sides are grouped by the key before they meet, and a third of the children has no key."""
    child = spark.range(0, 600_000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 'hot', if(id % 3 = 1, null, concat('k', id % 20000))) as k").groupBy("k", "id").count()
    parent = spark.range(20_000).selectExpr("concat('k', id) as k", "id as v").union(
        spark.range(1).selectExpr("'hot' as k", "id as v")).groupBy("k").agg(F.max("v").alias("v"))
    joined = spread_join(child, parent, "k", "id", how)
    assert len(joined.collect()) == (600_000 if how == "left" else 400_000)
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


KINDS = {"long": "if(id % 9 = 0, null, (id * 7919) % 1000000007 * 8000000000)", "int": "cast(id % 13 as int)",
         "text": "if(id % 11 = 0, null, concat('Kunde-é', cast((id * 7919) % 1009 as string)))",
         "money": "cast(pow(1.02, id % 1200) as decimal(20,2))", "float": "if(id = 5, double('Infinity'), if(id = 7, double('NaN'), sqrt(id % 700)))",
         "day": "date_add(date '1999-12-30', cast(id % 400 as int))", "flag": "id % 3 = 0", "zeros": "repeat('\\0', cast(id % 4 as int))",
         "time": "timestamp_ntz '2021-10-31 00:30:00.5' + make_dt_interval(0, 0, 0, (id * 17) % 9000)", "none": "cast(null as int)"}


@pytest.mark.parametrize("order", [["long"], ["-long"], ["int", "-text"], ["-text"], ["money", "int"], ["float"], ["-float"], ["-day"],
                                   ["flag", "time"], ["zeros"], ["none", "-int"], ["-none", "-money"], ["time"]])
def test_rows_at_places(spark, order):
    """Every kind of column, NULLs first and last, ties, and values that only the last column tells apart."""
    df = spark.range(0, 2000, 1, 4).selectExpr("id", *[f"{e} as {n}" for n, e in KINDS.items()])
    order = [*order, "id"]
    names = [c.removeprefix("-") for c in order]
    sort = [F.desc_nulls_last(n) if n != c else F.asc_nulls_first(n) for n, c in zip(names, order)]
    want = [[str(r[n]) for n in names] for r in df.orderBy(*sort).collect()]
    places = [-1, 0, 1, 399, 400, 1000, 1001, 1999, 2000]
    for cells, at_once in ((16, 3), (1024, 100)):
        got = rows_at(df, order, places, cells=cells, at_once=at_once)
        assert {p: [str(v) for v in row] for p, row in got.items()} == {p: want[p] for p in places if 0 <= p < 2000}
    for place, row in got.items():
        assert df.where(at_or_after(df, order, row)).count() == 2000 - place


def test_bucket_starts():
    for rows in range(23):
        sizes = [rows // 5 + (b < rows % 5) for b in range(5)]
        assert bucket_starts(rows, 5) == [sum(sizes[:b]) for b in range(1, 5)]


def test_scores_sort_nothing(spark):
    """No row is sorted, shuffled or joined: the plan is a scan and comparisons."""
    df = spark.range(5000).selectExpr("id", "id % 7 as v")
    plan = ntile_scores(df, "id", {"up": ["v"], "down": ["-v"]}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and not any(word in plan for word in ("Exchange", "Sort", "Join", "Window"))
