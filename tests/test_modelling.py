"""Fact, dimension and view rules on hand-written rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marketloom.operators import modelling as m
from marketloom.plans import mart, views
from marketloom.rules import Rules

D = dt.date


def test_is_late_is_three_valued(spark, rows):
    at = dt.datetime(2024, 1, 5, 10)
    df = spark.createDataFrame([
        ("Cancelled", at, D(2024, 1, 1)), ("Delivered", None, D(2024, 1, 1)), ("Delivered", at, D(2024, 1, 5)),
        ("Delivered", at, D(2024, 1, 4)), ("Delivered", at, None), (None, at, D(2024, 1, 1))],
        "order_status string, delivered_at timestamp_ntz, promised_date date")
    assert [r[0] for r in rows(m.with_is_late(df), "is_late")] == [None, None, False, True, False, None]


def test_censored_repeat(spark, rows):
    as_of = D(2024, 6, 30)
    first = as_of - dt.timedelta(days=90)
    df = spark.createDataFrame([
        (first + dt.timedelta(days=1), None), (first, None), (D(2024, 1, 1), D(2024, 3, 31)),
        (D(2024, 1, 1), D(2024, 4, 1)), (None, None)], "first_order_date date, second_order_date date")
    got = rows(m.with_censored_repeat(df, 90, as_of), "repeat_within_90d")
    assert [r[0] for r in got] == [None, False, True, False, None]


def _shop(spark):
    orders = spark.createDataFrame([
        ("O1", "C1", dt.datetime(2024, 1, 31, 9), "Delivered", "MEGA1111"),
        ("O2", "C1", dt.datetime(2024, 2, 1, 9), "Delivered", None),
        ("O0", "C1", dt.datetime(2024, 1, 1, 9), "Delivered", None),  # its only item is gone
        ("O3", "C2", dt.datetime(2024, 4, 1, 9), "Cancelled", None),
        ("O4", "C2", dt.datetime(2024, 4, 1, 9), "Returned to Origin", None)],
        "order_id string, customer_id string, ordered_at timestamp_ntz, order_status string, promo_code string")
    orders = orders.selectExpr(
        "order_id", "customer_id", "ordered_at", "cast(ordered_at as date) order_date", "'Lahore' city", "'Punjab' province",
        "1 city_tier", "'Card' payment_method", "'Prepaid' payment_group", "promo_code", "'X' courier",
        "date_add(cast(ordered_at as date), 3) promised_date",
        "ordered_at + interval 2 days delivered_at", "order_status", "150 shipping_fee", "false from_legacy_system")
    products = spark.createDataFrame([("P1", "Fashion", "S1", Decimal(60), Decimal(100))],
                                     "product_id string, category string, seller_id string, unit_cost decimal(14,2), list_price decimal(14,2)")
    items = spark.createDataFrame([(f"I{i}", f"O{o}", "P1", q, Decimal(90)) for i, (o, q) in enumerate([(1, 2), (1, 1), (2, 1), (3, 1), (4, 1)])],
                                  "order_item_id string, order_id string, product_id string, quantity int, unit_price decimal(14,2)")
    returns = spark.createDataFrame([("R1", "I1", "O1", "Changed mind", Decimal(90))],
                                    "return_id string, order_item_id string, order_id string, return_reason string, refund_amount decimal(14,2)")
    return orders, items, returns, products


def test_fact(spark):
    fact = {r.order_id: r for r in mart.fact_orders(*_shop(spark)).collect()}
    assert sorted(fact) == ["O1", "O2", "O3", "O4"]
    one = fact["O1"]
    assert (one.items_count, one.units, one.gmv, one.cogs, one.discount_value) == (2, 3, 270, 180, 30)
    assert (one.returned_items, one.refunded_value, one.net_revenue) == (1, 90, 180)
    assert (one.promised_days, one.delivery_days, one.is_late, one.customer_order_seq) == (3, 2, False, 1)
    assert (fact["O2"].customer_order_seq, fact["O2"].returned_items, fact["O2"].refunded_value) == (2, 0, 0)
    assert (fact["O3"].customer_order_seq, fact["O3"].net_revenue, fact["O3"].delivery_days) == (1, 0, None)
    assert (fact["O4"].customer_order_seq, fact["O4"].is_rto) == (2, True)


def _people(spark):
    return spark.createDataFrame([("C1",), ("C2",), ("C3",)], "customer_id string").selectExpr(
        "customer_id", "date'2024-01-01' signup_date", "'Lahore' city", "'Punjab' province", "1 city_tier",
        "'Direct' acquisition_channel", "'iOS' device_type")


def test_dimension(spark):
    rules = Rules(as_of=D(2024, 6, 30))
    fact = mart.fact_orders(*_shop(spark))
    dim = {r.customer_id: r for r in mart.dim_customers(_people(spark), fact, rules).collect()}
    one = dim["C1"]
    assert (one.first_order_date, one.cohort_month, one.second_order_date) == (D(2024, 1, 31), D(2024, 1, 1), D(2024, 2, 1))
    assert (one.acquired_in_mega_sale, one.repeat_within_90d, one.orders, one.delivered_orders) == (True, True, 2, 2)
    assert (dim["C2"].first_order_status, dim["C2"].repeat_within_90d, dim["C2"].net_revenue) == ("Cancelled", True, 0)
    none = dim["C3"]
    assert (none.orders, none.net_revenue, none.first_order_date, none.repeat_within_90d) == (0, 0, None, None)
    assert none.acquired_in_mega_sale is False


def test_cohort_offsets_count_boundaries(spark, rows):
    fact = mart.fact_orders(*_shop(spark))
    got = rows(views.cohort_retention(fact, mart.dim_customers(_people(spark), fact, Rules())))
    assert sorted(got) == [(D(2024, 1, 1), 0, 1, 1, 100), (D(2024, 1, 1), 1, 1, 1, 100), (D(2024, 4, 1), 0, 1, 1, 100)]


def test_month_over_month_uses_the_previous_row(spark, rows):
    df = spark.createDataFrame([(D(2024, 1, 1), 100), (D(2024, 3, 1), 150), (D(2024, 4, 1), 0), (D(2024, 5, 1), 10)],
                               "order_month date, v int")
    fact = df.selectExpr("order_month", "cast(v as decimal(14,2)) net_revenue", "cast(v as decimal(14,2)) gmv",
                         "'Delivered' order_status", "1 customer_order_seq", "'COD' payment_group")
    got = views.monthly_kpis(fact).orderBy("order_month")
    assert [r[0] for r in rows(got, "net_revenue_mom_pct")] == [None, Decimal("50.00"), Decimal("-100.00"), None]


def test_rfm_segments(spark, rows):
    df = spark.createDataFrame([(5, 5), (3, 3), (4, 1), (2, 3), (1, 1), (3, 2)], "r_score int, f_score int")
    assert [r[0] for r in rows(df.select(views.rfm_segment()))] == [
        "Champions", "Loyal", "New or promising", "At risk", "Lost", "Needs attention"]


def test_returns_by_category_keeps_categories_without_returns(spark):
    orders, items, returns, products = _shop(spark)
    fact = mart.order_facts(orders, items, returns, products)
    none = views.returns_by_category(views.product_returns(items, fact, returns.where("false")), products).first()
    assert (none.items_delivered, none.items_returned, none.return_rate_pct, none.changed_mind) == (3, 0, 0, None)
    some = views.returns_by_category(views.product_returns(items, fact, returns), products).first()
    assert (some.items_returned, some.changed_mind, some.size_or_fit, some.return_rate_pct) == (1, 1, 0, Decimal("33.33"))


def test_seller_flags_need_size_and_distance(spark):
    # Per category: one seller to judge and one large quiet seller that sets the base rate.
    spec = {"small": (49, 40), "even": (200, 20), "big": (50, 40)}
    rows_ = [(f"{cat}-{who}-{i}", f"{cat}-{who}", i < back)
             for cat, (n, back) in spec.items() for who, n, back in (("S", n, back), ("Q", 1000, 100)) for i in range(n)]
    df = spark.createDataFrame(rows_, "order_item_id string, product_id string, back boolean")
    items = df.select("order_item_id", F.lit("O").alias("order_id"), "product_id")
    products = df.select("product_id", F.col("product_id").alias("seller_id"),
                         F.substring_index("product_id", "-", 1).alias("category")).distinct()
    returns = df.where("back").select(F.col("order_item_id").alias("return_id"), "order_item_id",
                                      F.lit("Not as described").alias("return_reason"), F.lit(1).alias("refund_amount"))
    fact = spark.createDataFrame([("O", "Delivered")], "order_id string, order_status string")
    sellers = products.select("seller_id", F.col("seller_id").alias("seller_name"))
    got = {r.seller_id: r for r in views.seller_returns(views.product_returns(items, fact, returns), products, sellers).collect()}
    assert [got[f"{c}-S"].flagged for c in ("small", "even", "big")] == [False, False, True]
    assert got["small-S"].z_score > 3 and got["even-S"].z_score == 0
    assert got["big-S"].not_as_described_returns == 40


def test_seller_without_variance_has_no_z(spark):
    df = spark.createDataFrame([("I1", "P", "O")], "order_item_id string, product_id string, order_id string")
    products = spark.createDataFrame([("P", "S", "Fashion")], "product_id string, seller_id string, category string")
    fact = spark.createDataFrame([("O", "Delivered")], "order_id string, order_status string")
    returns = spark.createDataFrame([], "return_id string, order_item_id string, return_reason string, refund_amount int")
    sellers = spark.createDataFrame([("S", "n")], "seller_id string, seller_name string")
    got = views.seller_returns(views.product_returns(df, fact, returns), products, sellers).first()
    assert (got.z_score, got.flagged) == (None, False)
