"""Cleaning rules, one defect per row."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom import lookups
from marketloom.operators import cleaning as c
from marketloom.plans import clean_layer as layer
from marketloom.rules import Rules

CUSTOMERS = "customer_id string, email string, signup_date string, city string, acquisition_channel string, device_type string"
ORDERS = ("order_id string, customer_id string, order_datetime string, shipping_city string, payment_method string, "
          "promo_code string, courier string, promised_delivery_date string, delivered_at string, order_status string, "
          "shipping_fee string")


def accounts(spark):
    return spark.createDataFrame([
        ("C2", "a@x", "2024-01-05", "KHI", "Direct", "iOS"),
        ("C1", " A@X ", "2024-03-01", "Multan", "organic", "iOS"),
        ("C0", "a@X", "", "Multan", "organic", "iOS"),
        ("C5", "b@x", None, "Multan", "organic", "iOS"),
        ("C4", "B@x", "junk", "Atlantis", "organic", "iOS"),
        ("C6", None, "2024-01-01", "Multan", "organic", "iOS"),
        ("test7", "t@x", "2024-01-01", "Test City", "organic", "iOS"),
        (None, "n@x", "2024-01-01", "Multan", "organic", "iOS")], CUSTOMERS)


def test_canonical_accounts(spark):
    got = {r.raw_customer_id: r.customer_id for r in layer.customer_id_map(accounts(spark)).collect()}
    assert got == {"C0": "C2", "C1": "C2", "C2": "C2", "C4": "C4", "C5": "C4"}


def test_clean_customers(spark, rows):
    raw = accounts(spark)
    got = layer.customers(raw, layer.customer_id_map(raw), lookups.city_map(spark))
    assert sorted(rows(got, "customer_id", "email", "signup_date", "city", "city_tier", "acquisition_channel"), key=str) == [
        ("C2", "a@x", dt.date(2024, 1, 5), "Karachi", 1, "Direct"),
        ("C4", "b@x", None, None, None, "Organic Search")]


def test_canonical_map_with_a_key_that_holds_most_rows(spark):
    df = spark.range(3000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("m"))
    got = c.canonical_map(df, F.col("m"), [-F.col("k")], "k")
    assert got.where("raw_id % 3 > 0").select("canonical_id").distinct().collect()[0][0] == 2999
    assert got.count() == 3000
    assert got.where("raw_id % 3 = 0 and raw_id <> canonical_id").count() == 0


def order(**over):
    base = {"order_id": "O1", "customer_id": "C1", "order_datetime": "2025-02-01 10:00:00", "shipping_city": "lahore",
            "payment_method": "COD", "promo_code": None, "courier": "SwiftShip",
            "promised_delivery_date": "2025-02-05", "delivered_at": "2025-02-03 09:00:00", "order_status": "delivered",
            "shipping_fee": "150"}
    return tuple({**base, **over}.values())


def test_clean_orders(spark):
    raw = spark.createDataFrame([
        order(), order(),
        order(order_id="O2", customer_id="C0", shipping_city=None, order_datetime="31/12/2024 23:59",
              delivered_at="30/12/2024 12:00", promised_delivery_date="02/01/2025", shipping_fee="Rs. 200"),
        order(order_id="O3", customer_id="C9", shipping_city="Atlantis"),
        order(order_id="O4", customer_id="C2", shipping_city="Atlantis", payment_method="crypto"),
        order(order_id="O5", customer_id="TEST1"), order(order_id="O6", customer_id=None)], ORDERS)
    people, cities = accounts(spark), lookups.city_map(spark)
    id_map = layer.customer_id_map(people)
    got = {r.order_id: r for r in layer.orders(raw, id_map, layer.customers(people, id_map, cities), cities).collect()}
    assert sorted(got) == ["O1", "O2", "O3", "O4"]
    assert (got["O1"].customer_id, got["O1"].city, got["O1"].from_legacy_system) == ("C2", "Lahore", False)
    late = got["O2"]
    assert (late.customer_id, late.city, late.province, late.city_tier) == ("C2", "Karachi", "Sindh", 1)
    assert (late.delivered_at, late.delivered_before_ordered, late.from_legacy_system) == (None, True, True)
    assert (late.shipping_fee, late.promised_date, late.order_date) == (200, dt.date(2025, 1, 2), dt.date(2024, 12, 31))
    assert (got["O3"].customer_id, got["O3"].city) == ("C9", None)
    assert (got["O4"].city, got["O4"].payment_method, got["O4"].payment_group) == ("Karachi", None, "Prepaid")


def test_fill_from_parent_fills_each_column_on_its_own(spark, rows):
    child = spark.createDataFrame([(1, "p", "Lahore", None), (2, "p", None, 3), (3, None, None, None)],
                                  "i int, k string, city string, tier int")
    parent = spark.createDataFrame([("p", "Multan", 2)], "k string, city string, tier int")
    got = c.fill_from_parent(child, parent, "k", "i", ["city", "tier"]).orderBy("i")
    assert rows(got, "city", "tier") == [("Lahore", 2), ("Multan", 3), (None, None)]


def test_price_repair(spark, rows):
    df = spark.createDataFrame([(Decimal(p), None if p == 7 else Decimal(100)) for p in (90, 500, 900, 5000, 9000, 7)],
                               "price decimal(14,2), list decimal(14,2)")
    got = rows(df.select(c.repair_magnitude("price", "list", Rules().price_slips),
                         c.above_reference("price", "list", 5)))
    assert [float(p) for p, _ in got] == [90, 500, 90, 500, 90, 7]
    assert [flag for _, flag in got] == [False, False, True, True, True, False]


def test_items_and_returns(spark, rows):
    products = spark.createDataFrame([("P1", "Fashion", Decimal(100)), ("P2", "Fashion", None)],
                                     "product_id string, category string, list_price decimal(14,2)")
    orders = spark.createDataFrame([("O1",), ("O2",)], "order_id string")
    items = spark.createDataFrame([
        ("I1", "O1", "P1", "1", "90", "10"), ("I2", "O1", "P1", "0", "90", "10"), ("I3", "O1", "P1", "-1", "90", "10"),
        ("I4", "O1", "P1", "x", "90", "10"), ("I5", "O9", "P1", "1", "90", "10"), ("I6", "O1", "P9", "1", "90", "10"),
        ("I7", "O2", "P2", "2", "9000", None)],
        "order_item_id string, order_id string, product_id string, quantity string, unit_price string, discount_pct string")
    kept = layer.order_items(items, products, orders)
    assert sorted(rows(kept, "order_item_id", "quantity", "unit_price", "price_corrected")) == [
        ("I1", 1, Decimal("90.00"), False), ("I7", 2, Decimal("9000.00"), False)]

    back = spark.createDataFrame([("R1", "I1", "wrong", " Changed mind ", "2024-01-01", "90"),
                                  ("R2", "I99", "O1", "x", "2024-01-01", "90"),
                                  ("R3", "I4", "O1", "x", "2024-01-01", "90")],
                                 "return_id string, order_item_id string, order_id string, return_reason string, "
                                 "return_requested_date string, refund_amount string")
    assert rows(layer.returns(back, kept), "return_id", "order_id", "return_reason") == [("R1", "O1", "Changed mind")]


def test_sessions(spark, rows):
    raw = spark.createDataFrame([
        ("S1", None, "2026-03-02 10:00:00", "iOS", "Direct", "TREATMENT ", "2", "1", "10.50"),
        ("S1", None, "2026-03-02 10:00:00", "iOS", "Direct", " treatment", "2", "1", "10.5"),
        ("S2", None, "2026-03-02 10:00:00", "iOS", "Direct", "control", "3", "0", None),
        ("S3", None, "bad", "iOS", "Direct", None, None, None, None)],
        "session_id string, customer_id string, session_start string, device_type string, traffic_source string, "
        "experiment_group string, session_duration_sec string, completed_order string, order_value string")
    got = sorted(rows(layer.checkout_sessions(raw), "session_id", "experiment_group", "is_bot", "order_value"))
    assert got == [("S1", "treatment", True, Decimal("10.50")), ("S2", "control", False, None), ("S3", None, False, None)]


def test_null_if_before(spark, rows):
    df = spark.createDataFrame([(1, 2), (2, 1), (1, 1), (None, 1)], "later int, earlier int")
    assert rows(c.null_if_before(df, "later", "earlier", "flag"), "later", "flag") == [
        (None, True), (2, False), (1, False), (None, False)]


def test_flag_before_ignores_the_session_time_zone(spark, rows):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Karachi")
    try:
        df = spark.sql("""SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-12-31 23:59:59'), (TIMESTAMP_NTZ'2025-01-01 00:00:00'),
                       (CAST(NULL AS TIMESTAMP_NTZ)) AS t(at)""")
        assert rows(df.select(c.flag_before("at", Rules().legacy_until))) == [(True,), (False,), (False,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("few", [c.FEW_KEYS, 2, 1, 0])
def test_children_stay_where_they_lie_if_few_keys_lack_a_parent(spark, rows, few):
    """Two keys lack a parent: up to there only keys are shuffled, beyond it the rows are, with the same result."""
    kids = [(1, "a"), (2, "a"), (3, "x"), (4, "x"), (5, "y"), (6, None), (7, ""), (8, "b"), (8, "b")]
    child = spark.createDataFrame(kids, "id int, k string")
    parent = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("", 4), (None, 5), ("z", 6)], "k string, n int")
    kept = c.keep_if_parent(child, parent, "k", few)
    assert sorted(rows(kept, "id", "k")) == [(1, "a"), (2, "a"), (7, ""), (8, "b"), (8, "b")]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftAnti" in plan) == (few >= 2) and ("LeftSemi" in plan) == (few < 2)
    assert rows(c.keep_if_parent(child, parent.limit(0), "k", few)) == [] and rows(c.keep_if_parent(child.limit(0), parent, "k", few)) == []
