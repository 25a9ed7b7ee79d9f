"""Star schema to clean tables: the input of modelling and analysis."""

from __future__ import annotations

import dataclasses
import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from marketloom.bindings import derive, pick
from marketloom.plans import mart
from marketloom.rules import Rules
from marketloom.session import stored

RULES = dataclasses.replace(Rules(), as_of=dt.date(2001, 8, 1), value_band=Decimal(4000000), watched_courier="Courier A",
                            seller_z=2.0, seller_min_items=10)

ITEM_ID = ("CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)"
           " || '-' || CAST(l_suppkey AS STRING)")
_PRICE = "CAST(l_extendedprice AS DECIMAL(14,2))"
_TIER = "CASE WHEN r.r_regionkey = 4 THEN NULL ELSE r.r_regionkey % 3 + 1 END"
_WHOLE_PRICE = "CAST(FLOOR(o_totalprice) AS BIGINT)"
REASONS = ("Size or fit issue", "Not as described", "Defective or damaged", "Arrived too late", "Changed mind", "Other")

TABLES = {
    "customers": f"""
        SELECT c.c_custkey AS customer_id, c.c_name AS email,
               DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INT) AS signup_date,
               n.n_name AS city, r.r_name AS province, {_TIER} AS city_tier,
               c.c_mktsegment AS acquisition_channel,
               {pick('c.c_custkey % 3', ('Android', 'iOS', 'Desktop'))} AS device_type
        FROM {{customer}} c JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
        JOIN {{region}} r ON r.r_regionkey = n.n_regionkey""",
    "sellers": """
        SELECT s_suppkey AS seller_id, s_name AS seller_name FROM {supplier}""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
               p_partkey % (SELECT COUNT(*) FROM {supplier}) AS seller_id,
               CAST(p_retailprice AS DECIMAL(14,2)) AS list_price,
               CAST(CAST(p_retailprice AS DECIMAL(14,2)) - 250 AS DECIMAL(14,2)) AS unit_cost
        FROM {part}""",
    "clean_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ordered_at,
               CAST(o_orderdate AS DATE) AS order_date, n.n_name AS city, r.r_name AS province, {_TIER} AS city_tier,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Card' WHEN '2-HIGH' THEN 'Mobile Wallet'
                    ELSE 'Cash on Delivery' END AS payment_method,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Prepaid' ELSE 'COD' END AS payment_group,
               CASE o_orderkey % 10 WHEN 0 THEN 'MEGA1111' WHEN 1 THEN 'AZADI14' WHEN 2 THEN 'WELCOME' END AS promo_code,
               {pick('o_custkey % 4', ('Courier A', 'Courier B', 'Courier C', 'Courier D'))} AS courier,
               CAST(o_orderdate AS DATE) + CAST(3 + o_custkey % 4 AS INT) AS promised_date,
               CASE WHEN {_WHOLE_PRICE} % 31 <> 0
                    THEN o_orderdate + INTERVAL '1' DAY * CAST({_WHOLE_PRICE} % 12 AS INT) END AS delivered_at,
               CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'P' THEN 'Returned to Origin'
                    WHEN o_orderpriority = '5-LOW' THEN 'In Transit' ELSE 'Cancelled' END AS order_status,
               CAST(150 + o_custkey % 3 * 50 AS INT) AS shipping_fee,
               o_orderdate < TIMESTAMP '1998-01-01 00:00:00' AS from_legacy_system
        FROM {{orders}} LEFT JOIN {{nation}} n ON n.n_nationkey = o_custkey % 25
        LEFT JOIN {{region}} r ON r.r_regionkey = n.n_regionkey""",
    "order_items": f"""
        SELECT {ITEM_ID} AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INT) AS quantity, {_PRICE} AS unit_price
        FROM {{lineitem}}""",
    "returns": f"""
        SELECT 'R' || {ITEM_ID} AS return_id, {ITEM_ID} AS order_item_id, l_orderkey AS order_id,
               {pick('l_partkey % 6', REASONS)} AS return_reason,
               CAST(CAST(l_quantity AS INT) * {_PRICE} AS DECIMAL(14,2)) AS refund_amount
        FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "sessions": f"""
        SELECT event_id AS session_id, {pick('user_id % 2', ('control', 'treatment'))} AS experiment_group,
               {pick('user_id % 3', ('Android', 'iOS', 'Desktop'))} AS device_type, value < 3 AS is_bot,
               CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS completed_order,
               CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(14,2)) END AS order_value
        FROM {{events}}""",
}

# Which derived tables each reference answer builds on.
ORDER_TABLES = ("products", "clean_orders", "order_items", "returns")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return derive(spark, folder, TABLES[name])


def _order_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: table(spark, folder, t) for n, t in
            (("orders", "clean_orders"), ("items", "order_items"), ("returns", "returns"), ("products", "products"))}


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """The fact without the running order number."""
    return mart.order_facts(**_order_tables(spark, folder))


def numbered_facts(spark: SparkSession, folder: str) -> DataFrame:
    return mart.fact_orders(**_order_tables(spark, folder))


def dimension(spark: SparkSession, folder: str, fact: DataFrame | None = None) -> DataFrame:
    fact = numbered_facts(spark, folder) if fact is None else fact
    return mart.dim_customers(table(spark, folder, "customers"), fact, RULES)


def stored_mart(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The fact and the dimension, each built once and kept, for what reads them several times."""
    fact = stored(numbered_facts(spark, folder), "fact")
    return fact, stored(dimension(spark, folder, fact), "dimension")
