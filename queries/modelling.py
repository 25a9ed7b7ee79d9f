"""Rollups, the fact and the dimension."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.bindings import star
from marketloom.operators import modelling as m
from marketloom.operators.ranking import first_within
from marketloom.plans.mart import DIM_COLUMNS
from marketloom.session import fresh_folder, stored
from marketloom.sources.numbers import KeptNumbers
from queries import query
from queries import sql as s


@query("item_rollup", "D1", s.on_star("""
    SELECT i.order_id, COUNT(*) AS items_count, CAST(SUM(i.quantity) AS BIGINT) AS units,
           CAST(SUM(i.quantity * i.unit_price) AS DOUBLE) AS gmv, CAST(SUM(i.quantity * p.unit_cost) AS DOUBLE) AS cogs,
           CAST(SUM(i.quantity * p.list_price) AS DOUBLE) AS list_value
    FROM order_items i JOIN products p USING (product_id) GROUP BY i.order_id""", "order_items", "products"))
def _(spark, folder):
    return m.rollup_items(star.table(spark, folder, "order_items"), star.table(spark, folder, "products"))


@query("return_rollup", "D2", s.on_star("""
    SELECT order_id, COUNT(*) AS returned_items, CAST(SUM(refund_amount) AS DOUBLE) AS refunded_value
    FROM returns GROUP BY order_id""", "returns"))
def _(spark, folder):
    return m.rollup_returns(star.table(spark, folder, "returns"))


FACT_SELECT = "SELECT " + s.typed(
    "order_id customer_id ordered_at order_date order_month city province city_tier:b payment_method payment_group "
    "promo_code courier order_status promised_date delivered_at shipping_fee:b from_legacy_system items_count units:b "
    "gmv:d cogs:d discount_value:d returned_items:b refunded_value:d net_revenue:d promised_days:b delivery_days:b "
    "is_late is_rto customer_order_seq:b") + " FROM fact"
query("fact_orders", "D3 D4 D5 D6 D7 D8 D9 D10", s.on_fact(FACT_SELECT))(star.numbered_facts)


@query("order_seq", "D10", s.on_fact("""
    SELECT order_id, customer_id, customer_order_seq FROM fact"""))
def _(spark, folder):
    return star.numbered_facts(spark, folder).select("order_id", "customer_id", "customer_order_seq")


@query("order_seq_kept", "D10", s.on_fact("""
    SELECT order_id, customer_id, customer_order_seq FROM fact"""))
def _(spark, folder):
    """Numbers over three runs: all days but the last, the last, and one in the middle anew."""
    orders = stored(star.facts(spark, folder).select("order_id", "customer_id", "ordered_at"), "orders")
    kept = KeptNumbers(spark, fresh_folder(spark, "numbers"))
    day = F.to_date("ordered_at")
    last, some = orders.agg(F.max(day), F.percentile_approx(F.unix_timestamp(day.cast("timestamp")), 0.5)
                            .cast("timestamp").cast("date")).first()
    kept.update(orders.where(day < last))
    kept.update(orders, [last])
    kept.update(orders, [some])
    return kept.numbers()


@query("first_orders", "D11", s.on_fact("""
    SELECT customer_id, order_id, order_date AS first_order_date, order_month AS cohort_month, promo_code, order_status,
           payment_group, is_late FROM fact WHERE customer_order_seq = 1"""))
def _(spark, folder):
    firsts = first_within(star.facts(spark, folder), ["customer_id"], [F.asc("ordered_at"), F.asc("order_id")])
    return firsts.select("customer_id", "order_id", F.col("order_date").alias("first_order_date"),
                         F.col("order_month").alias("cohort_month"), "promo_code", "order_status", "payment_group",
                         "is_late")


@query("customer_history", "D11 D12 D13", s.on_dim(
    "SELECT " + s.typed("customer_id first_order_date cohort_month first_promo_code first_order_status "
                        "first_payment_group first_order_late second_order_date orders delivered_orders net_revenue:d "
                        "last_order_date") + " FROM history"))
def _(spark, folder):
    return m.customer_history(star.numbered_facts(spark, folder))


query("dim_customers", "D14 D15 D16", s.on_dim(
    "SELECT " + s.typed(" ".join({"city_tier": "city_tier:b", "net_revenue": "net_revenue:d"}.get(c, c)
                                 for c in DIM_COLUMNS)) + " FROM dim"))(star.dimension)
