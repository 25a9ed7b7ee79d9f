"""Order numbers kept over many runs equal those of a full rebuild."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators.modelling import with_order_seq
from marketloom.sources.numbers import KeptNumbers

SCHEMA = "customer_id string, ordered_at timestamp_ntz, order_id long, other int"
START = dt.date(2024, 1, 1)


def orders(seed=1, n=600, days=6):
    """A third of the orders are one customer's; some have no customer, some no time; times tie."""
    pick = random.Random(seed)
    return [("hot" if i % 3 == 0 else None if i % 17 == 0 else f"c{pick.randrange(40)}",
             None if i % 29 == 0 else dt.datetime.combine(START, dt.time()) + dt.timedelta(days=pick.randrange(days), hours=pick.randrange(6)),
             i, i) for i in range(n)]


def same(spark, kept, rows, only=None):
    full = with_order_seq(spark.createDataFrame(rows, SCHEMA))
    want = {(r.customer_id, r.order_id, r.customer_order_seq) for r in full.collect()
            if only is None or (r.ordered_at and r.ordered_at.date()) in only}
    got = [tuple(r) for r in kept.numbers(only).collect()]
    return len(got) == len(want) and set(got) == want


def on(rows, *days):
    return [r for r in rows if (r[1] and r[1].date()) in days]


def test_days_that_change_alone(spark, tmp_path):
    kept, rows, last = KeptNumbers(spark, str(tmp_path)), orders(), START + dt.timedelta(days=5)
    with pytest.raises(FileNotFoundError):
        kept.numbers()
    earlier = [r for r in rows if r not in on(rows, last)]
    kept.update(spark.createDataFrame(earlier, SCHEMA))
    assert same(spark, kept, earlier)
    kept.update(spark.createDataFrame(on(rows, last), SCHEMA))  # one more day
    assert same(spark, kept, rows) and same(spark, kept, rows, [last]) and same(spark, kept, rows, [None, START])
    second = START + dt.timedelta(days=1)  # a day in the middle comes anew
    fresh = [(c, dt.datetime.combine(second, dt.time(i % 24)), 10_000 + i, 0) for i, (c, *_) in enumerate(rows[:90])]
    rows = [r for r in rows if r not in on(rows, second)] + fresh
    kept.update(spark.createDataFrame(rows, SCHEMA), [second])
    assert same(spark, kept, rows)
    rows = [r for r in rows if r not in on(rows, START, None)]  # days that are no more
    kept.update(spark.createDataFrame(rows, SCHEMA), [START, None])
    assert same(spark, kept, rows) and kept.runs() == [1, 2, 3, 4]
    kept.compact()
    assert kept.runs() == [5] and same(spark, kept, rows)
    assert kept.numbers([]).count() == 0


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.createDataFrame(orders(), SCHEMA).write.parquet(path)
    kept, source = KeptNumbers(spark, str(tmp_path / "kept")), spark.read.parquet(path)
    day = START + dt.timedelta(days=2)
    plan = source.where(kept._on([day]))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(ordered_at,2024" in pushed and "LessThan(ordered_at,2024" in pushed
    kept.update(source, [day])
    kept.update(source, [START])
    assert same(spark, kept, on(orders(), day, START))
    plan = kept.numbers([day])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(day, [" in plan or "PushedFilters: [IsNotNull(day), EqualTo(day," in plan


def test_a_run_that_did_not_end_counts_for_nothing(spark, tmp_path):
    kept, rows = KeptNumbers(spark, str(tmp_path)), orders(n=90)
    kept.update(spark.createDataFrame(rows, SCHEMA))
    broken = spark.createDataFrame(rows, SCHEMA).withColumn(
        "order_id", F.when(F.col("order_id") < 80, F.col("order_id") + 1000).otherwise(F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        kept.update(broken)
    assert kept.runs() == [1] and same(spark, kept, rows)
    kept.update(spark.createDataFrame(rows[:40], SCHEMA), [START])
    assert kept.runs() == [1, 2] and same(spark, kept, [r for r in rows if r not in on(rows, START)] + on(rows[:40], START))


def test_no_orders(spark, tmp_path):
    kept = KeptNumbers(spark, str(tmp_path))
    kept.update(spark.createDataFrame([], SCHEMA))
    assert kept.numbers().count() == 0
    kept.update(spark.createDataFrame(orders(n=50), SCHEMA))
    assert same(spark, kept, orders(n=50))
