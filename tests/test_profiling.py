"""Counts of defects and quality checks on hand-written rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.operators import profiling as p
from marketloom.operators import quality as q
from marketloom.operators import reshape as r
from marketloom.plans import reports


def test_duplicate_rows_treat_nulls_as_equal(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (1, None)], "a int, b string")
    assert rows(p.count_duplicate_rows(df, "dup")) == [("dup", 2)]
    assert rows(p.count_duplicate_rows(df.where("false"), "dup")) == [("dup", 0)]


def test_duplicate_rows_are_exact_when_hashes_collide(spark, rows):
    df = spark.range(0, 600, 1, 4).selectExpr("id % 200 as a", "cast(id % 50 as string) as b", "id % 3 = 0 as c")
    want = 600 - df.distinct().count()
    for bits in (1, 8, 1 << 40):
        coarse = lambda names, n=bits: [F.pmod(F.xxhash64(*names), F.lit(n)), F.lit(0)]
        assert rows(p.count_duplicate_rows(df, "dup", coarse)) == [("dup", want)]
    assert rows(p.count_duplicate_rows(df.toDF("n", "n", "check_name"), "dup")) == [("dup", want)]


def test_excess_counts_nulls(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert rows(p.one_row(df, {"x": p.count_excess("k")})) == [("x", 2)]


def test_orphans_count_rows_and_nulls(spark, rows):
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(p.count_orphans(child, parent, "k", "o")) == [("o", 3)]
    assert rows(p.count_orphans(child.where("k = 'a'"), parent, "k", "o")) == [("o", 0)]


def test_spelling_gap(spark, rows):
    df = spark.createDataFrame([(c,) for c in ("Lahore", "lahore", "Lahore ", " Lahore", None, "KHI")], "c string")
    assert rows(p.spelling_gap(df, "c")) == [(3, 5)]


def test_value_inventory_order(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a ",), ("c",), ("c",)], "c string")
    assert rows(p.value_inventory(df, "c", "v", "n")) == [
        ("c", 1, 2), ("a", 1, 1), ("a ", 2, 1), ("b", 1, 1), (None, None, 1)]


def test_verdicts_and_gate(spark):
    tables = {"t": spark.createDataFrame([(1, "a"), (1, None)], "k int, v string"),
              "u": spark.createDataFrame([(1,)], "k int")}
    declared = {"t": [q.check_unique("t: k is unique", "k"), q.check_not_null("t: v known", "v", warn=True),
                      q.check_in_set("t: v in set", "v", ["a"]), q.check_fk("t: has u", "u", "k"),
                      q.check_predicate("t: k small", F.col("k") > 5)]}
    checks = q.run_checks(tables, declared)
    assert {r.check_name: (r.failing_rows, r.result) for r in checks.collect()} == {
        "t: k is unique": (1, "FAIL"), "t: v known (warning)": (1, "WARN"), "t: v in set": (0, "PASS"),
        "t: has u": (0, "PASS"), "t: k small": (0, "PASS")}
    with pytest.raises(q.QualityGateError, match="k is unique"):
        q.gate(checks)
    q.gate(checks.where("result <> 'FAIL'"))


def test_ledger_of_keys(spark):
    """Uniqueness and orphans of several tables from one scan each and one shuffle of keys."""
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "a"), (None, None)], "id long, email string")
    children = spark.createDataFrame([(10, 1), (11, 7), (11, 7), (12, None), (13, 2)], "child long, id long")
    declared = {"parents": [q.check_unique("id once", "id"), q.check_unique("email once", "email"), q.check_not_null("email known", "email")],
                "children": [q.check_fk("child has parent", "parents", "id"), q.check_unique("child once", "child"),
                             q.check_predicate("child below 13", F.col("child") >= 13)]}
    tables = {"parents": parents, "children": children}
    want = {"id once": 3, "email once": 3, "email known": 1, "child has parent": 3, "child once": 1, "child below 13": 1}
    checked = q.run_checks(tables, declared)
    assert {r.check_name: r.failing_rows for r in checked.collect()} == want
    empty = q.run_checks({n: df.limit(0) for n, df in tables.items()}, declared)
    assert {r.check_name: (r.failing_rows, r.result) for r in empty.collect()} == {n: (0, "PASS") for n in want}
    plan = q.run_checks(tables, declared)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan ExistingRDD") == 2 and "Join" not in plan


def test_ledger_lines_come_from_unpivoted_rows(spark):
    """No array is built per row; empty texts are keys like others, NULL ones count, and a row may have several faults."""
    rows = [("", 1), ("", 2), (None, 3), (None, None), ("a", 9), ("b", 9)]
    tables = {"t": spark.createDataFrame(rows, "k string, n int"), "u": spark.createDataFrame([("a",), ("",), (None,)], "k string")}
    declared = {"t": [q.check_unique("k once", "k"), q.check_fk("has u", "u", "k"), q.check_not_null("n known", "n"),
                      q.check_not_null("k known", "k"), q.check_predicate("n small", F.col("n") > 2)],
                "u": [q.check_unique("u: k once", "k")]}
    checked = q.run_checks(tables, declared)
    assert {r.check_name: r.failing_rows for r in checked.collect()} == {
        "k once": 3, "has u": 3, "n known": 1, "k known": 2, "n small": 3, "u: k once": 1}
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "array_compact" not in plan and "filter(array" not in plan


def test_centred_mean_needs_a_full_window(spark, rows):
    df = spark.createDataFrame([(dt.date(2024, 1, 1 + i), i) for i in range(9)], "d date, n int")
    got = [r[0] for r in rows(r.centred_mean(df, "d", "n", "m").orderBy("d"), "m")]
    assert got == [None] * 3 + [3.0, 4.0, 5.0] + [None] * 3


def test_calendar_days_can_carry_several_events(spark, rows):
    days = spark.createDataFrame([(dt.date(2024, 1, i),) for i in (1, 2, 3)], "d date")
    events = spark.createDataFrame([("sale", dt.date(2024, 1, 2), dt.date(2024, 1, 3)), ("eid", dt.date(2024, 1, 3), dt.date(2024, 1, 3))],
                                   "event string, starts date, ends date")
    got = sorted(rows(r.annotate_calendar(days, "d", events)), key=str)
    assert [(d.day, e) for d, e in got] == [(1, None), (2, "sale"), (3, "eid"), (3, "sale")]


def test_payment_mix_fills_missing_methods(spark, rows):
    mix = spark.createDataFrame([(1, "Card", Decimal("40.00")), (1, "Cash on Delivery", Decimal("60.00"))],
                                "order_month int, payment_method string, share_pct decimal(18,2)")
    wide = reports.payment_mix_wide(mix)
    assert wide.columns == ["order_month", "Cash on Delivery", "Mobile Wallet", "Card"]
    assert rows(wide) == [(1, 60, 0, 40)]


def test_ratios(spark):
    drivers = spark.createDataFrame([("COD", "First order", 20, 100), ("COD", "Repeat order", 50, 100),
                                     ("Prepaid", "First order", 1, 50), ("Prepaid", "Repeat order", 1, 50)],
                                    "payment_group string, customer_type string, rto_orders bigint, shipped_orders bigint")
    assert reports.refusal_ratio(drivers).first()[0] == pytest.approx(10)
    quality = spark.createDataFrame([("First order used a mega-sale code", Decimal(75)), ("First order at any other time", Decimal(100))],
                                    "acquisition string, avg_net_revenue decimal(18,0)")
    assert reports.spend_gap(quality).first()[0] == pytest.approx(0.25)
