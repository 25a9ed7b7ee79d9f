"""The order fact and the customer dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators import modelling as m
from marketloom.rules import DEFAULT_RULES, Rules

FACT_COLUMNS = (
    "order_id", "customer_id", "ordered_at", "order_date", "order_month", "city", "province", "city_tier",
    "payment_method", "payment_group", "promo_code", "courier", "order_status", "promised_date", "delivered_at",
    "shipping_fee", "from_legacy_system", "items_count", "units", "gmv", "cogs", "discount_value",
    "returned_items", "refunded_value", "net_revenue", "promised_days", "delivery_days", "is_late", "is_rto")
DIM_COLUMNS = (
    "customer_id", "signup_date", "city", "province", "city_tier", "acquisition_channel", "device_type",
    "first_order_date", "cohort_month", "first_promo_code", "acquired_in_mega_sale", "first_order_status",
    "first_payment_group", "first_order_late", "second_order_date", "repeat_within_90d", "orders",
    "delivered_orders", "net_revenue", "last_order_date")


def order_facts(orders: DataFrame, items: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """The order fact without the running number: no shuffle by customer, for views that need none."""
    return m.order_measures(m.assemble_orders(orders, items, returns, products)).select(*FACT_COLUMNS)


def fact_orders(orders: DataFrame, items: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """The order fact. The number counts only orders that are in the fact, so it comes last."""
    return m.with_order_seq(order_facts(orders, items, returns, products))


def dim_customers(customers: DataFrame, fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per person, also without orders."""
    joined = customers.join(m.customer_history(fact), "customer_id", "left")
    counted = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("orders", "delivered_orders", "net_revenue")})
    flagged = m.with_code_flag(counted, "first_promo_code", rules.mega_sale_codes, "acquired_in_mega_sale")
    return m.with_censored_repeat(flagged, rules.repeat_days, rules.as_of).select(*DIM_COLUMNS)
