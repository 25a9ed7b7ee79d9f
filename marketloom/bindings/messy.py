"""Star schema to untidy text extracts: the input of profiling and cleaning.

The defects are those the cleaning rules exist for: two date layouts, loose labels and city names,
repeated rows, repeated accounts, QA accounts, fees as text, slipped decimal points, bad quantities
and orphan returns.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from marketloom.bindings import derive, padded, pick
from marketloom.rules import Rules

RULES = dataclasses.replace(Rules(), as_of=dt.date(2001, 8, 1), legacy_until=dt.datetime(1998, 1, 1))

CITY_TEXTS = ("Karachi", " Lahore", "KHI", "lahore", "LAHORE", "Multan", "Abbotabad", "isb", "Pindi", "Faisalabad ",
              "hyderabad, sindh", "Quetta", "GRW", "sialkot", "Peshawar", "Pesh", "bwp", "Sukkur", "SARGODHA", "Mardan",
              "Atlantis", "", None, "Lahore ", "Rawalpindi Cantt")
CHANNEL_TEXTS = ("Facebook Ads", "app_store", " Direct ", "organic", "Paid Social", "Google Organic", "Referral")
CATEGORY_TEXTS = ("Fashion", "Fashion ", "Home AND Kitchen", "home & kitchen", "Garden", "ELECTRONICS", "grocery",
                  "Baby and Toys", "Beauty and Personal Care", "Footwear", "Mobile accessories", None)
PAYMENT_TEXTS = ("COD", "COD ", "Cash on Delivery", "cash_on_delivery", "CC", "Card", "WALLET", "jazzcash", "easypaisa",
                 "crypto", None)
GROUP_TEXTS = ("control", "TREATMENT ", "Control", "treatment", "beta")
REASON_TEXTS = ("Size or fit issue", " Not as described", "Defective or damaged ", "Arrived too late", "Changed mind")

_LEGACY = "o_orderdate < TIMESTAMP '1998-01-01 00:00:00'"
_WHOLE_PRICE = "CAST(FLOOR(o_totalprice) AS BIGINT)"
_ITEM = ("'I' || " + padded("l_orderkey", 9) + " || '-' || CAST(l_linenumber AS STRING) || '-' || "
         "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)")
_MONEY = "CAST(CAST({} AS DECIMAL(14,2)) AS STRING)"


def _account(key: str) -> str:
    prefix = f"CASE WHEN {key} % 194 = 5 THEN 'test' WHEN {key} % 97 = 5 THEN 'TEST' ELSE 'C' END"
    return f"{prefix} || {padded(key, 9)}"


def _slashed(day: str) -> str:
    return f"{padded(f'DAY({day})', 2)} || '/' || {padded(f'MONTH({day})', 2)} || '/' || CAST(YEAR({day}) AS STRING)"


def _clock(key: str) -> str:
    return f"{padded(f'{key} % 24', 2)} || ':' || {padded(f'{key} % 60', 2)}"


def _both_layouts(day: str, clock: str | None) -> str:
    legacy = _slashed(day) + (f" || ' ' || {clock}" if clock else "")
    iso = f"CAST({day} AS STRING)" + (f" || ' ' || {clock} || ':00'" if clock else "")
    return f"CASE WHEN {_LEGACY} THEN {legacy} ELSE {iso} END"


_DAY = "CAST(o_orderdate AS DATE)"
_PROMISED = f"({_DAY} + CAST(3 + o_custkey % 4 AS INT))"
_DELIVERED = f"({_DAY} + CAST({_WHOLE_PRICE} % 13 - 1 AS INT))"
_ORDER = f"""
        SELECT 'ORD' || {padded('o_orderkey', 9)} AS order_id, {_account('o_custkey')} AS customer_id,
               CASE WHEN o_orderkey % 997 = 11 THEN 'junk' ELSE {_both_layouts(_DAY, _clock('o_orderkey'))} END AS order_datetime,
               {pick('o_orderkey % 25', CITY_TEXTS)} AS shipping_city,
               {pick('o_orderkey % 11', PAYMENT_TEXTS)} AS payment_method,
               {pick('o_orderkey % 6', ('NONE', '', ' azadi14 ', None, 'MEGA1111', 'Welcome'))} AS promo_code,
               {pick('o_custkey % 4', ('SwiftShip', 'PakRider', 'CityExpress', 'RapidRoute'))} AS courier,
               {_both_layouts(_PROMISED, None)} AS promised_delivery_date,
               CASE WHEN {_WHOLE_PRICE} % 31 = 0 THEN ' ' WHEN {_WHOLE_PRICE} % 37 = 0 THEN NULL
                    ELSE {_both_layouts(_DELIVERED, _clock('o_custkey'))} END AS delivered_at,
               CASE o_orderstatus WHEN 'F' THEN {pick('o_orderkey % 3', ('DLVD', 'delivered', 'Delivered '))}
                    WHEN 'P' THEN {pick('o_orderkey % 2', ('RTO', 'returned_to_origin'))}
                    ELSE {pick('o_orderkey % 4', ('CNCL', 'canceled', 'shipped', 'lost'))} END AS order_status,
               CASE WHEN {_LEGACY} THEN 'Rs. ' ELSE '' END || CAST(150 + o_custkey % 3 * 50 AS STRING) AS shipping_fee
        FROM {{orders}}"""
_SESSION = f"""
        SELECT 'CS' || {padded('event_id', 9)} AS session_id,
               CASE WHEN user_id % 5 <> 0 THEN {_account('user_id')} END AS customer_id,
               CAST(CAST(ts AS DATE) AS STRING) || ' ' || {padded('HOUR(ts)', 2)} || ':' || {padded('MINUTE(ts)', 2)}
                   || ':' || {padded('SECOND(ts)', 2)} AS session_start,
               {pick('user_id % 3', ('Android', 'iOS', 'Desktop'))} AS device_type, event_type AS traffic_source,
               {pick('user_id % 5', GROUP_TEXTS)} AS experiment_group,
               CASE WHEN event_id % 59 = 0 THEN '' ELSE CAST(CAST(FLOOR(value) AS BIGINT) AS STRING) END AS session_duration_sec,
               CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS completed_order,
               CASE WHEN event_type = 'purchase' THEN {_MONEY.format('value')} END AS order_value
        FROM {{events}}"""

TABLES = {
    "raw_customers": f"""
        SELECT {_account('c_custkey')} AS customer_id,
               CASE WHEN c_custkey % 53 = 7 THEN NULL
                    WHEN c_custkey % 10 = 1 THEN ' USER' || CAST(c_custkey - 1 AS STRING) || '@Example.com '
                    ELSE 'user' || CAST(c_custkey AS STRING) || '@example.com' END AS email,
               CASE WHEN c_custkey % 41 = 0 THEN '' WHEN c_custkey % 43 = 0 THEN 'junk'
                    ELSE CAST(DATE '1994-01-01' + CAST(c_custkey * 7 % 365 AS INT) AS STRING) END AS signup_date,
               {pick('c_nationkey', CITY_TEXTS)} AS city,
               {pick('c_custkey % 7', CHANNEL_TEXTS)} AS acquisition_channel,
               {pick('c_custkey % 3', ('Android', 'iOS', 'Desktop'))} AS device_type
        FROM {{customer}}""",
    "raw_sellers": f"""
        SELECT 'S' || {padded('s_suppkey', 9)} AS seller_id, s_name AS seller_name,
               {pick('s_nationkey', CITY_TEXTS)} AS seller_city,
               CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE CAST(DATE '1993-01-01' + CAST(s_suppkey % 700 AS INT) AS STRING) END AS joined_date,
               {pick('s_suppkey % 2', ('Official Store', 'Marketplace Seller'))} AS seller_type
        FROM {{supplier}}""",
    "raw_products": f"""
        SELECT 'P' || {padded('p_partkey', 9)} AS product_id, p_name AS product_name,
               {pick('p_partkey % 12', CATEGORY_TEXTS)} AS category, p_type AS subcategory, p_brand AS brand,
               'S' || {padded('p_partkey % (SELECT COUNT(*) FROM {supplier})', 9)} AS seller_id,
               CASE WHEN p_partkey % 211 = 0 THEN 'n/a' ELSE {_MONEY.format('p_retailprice')} END AS list_price,
               {_MONEY.format('p_retailprice - 250')} AS unit_cost
        FROM {{part}}""",
    # Ingestion retries: some rows arrive twice.
    "raw_orders": f"{_ORDER}\n        UNION ALL {_ORDER} WHERE o_totalprice >= 480000",
    "raw_order_items": f"""
        SELECT {_ITEM} AS order_item_id, 'ORD' || {padded('l_orderkey', 9)} AS order_id,
               'P' || {padded('l_partkey', 9)} AS product_id,
               CASE l_partkey % 101 WHEN 0 THEN '0' WHEN 1 THEN '-1' WHEN 2 THEN 'x'
                    ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
               {_MONEY.format('l_extendedprice')} AS unit_price,
               CAST(CAST(ROUND(l_discount * 100) AS INT) AS STRING) AS discount_pct
        FROM {{lineitem}}""",
    "raw_returns": f"""
        SELECT 'R' || {_ITEM} AS return_id,
               CASE WHEN l_suppkey % 83 = 0 THEN 'GHOST' ELSE '' END || {_ITEM} AS order_item_id,
               CASE WHEN l_partkey % 7 = 0 THEN 'ORD?' ELSE 'ORD' || {padded('l_orderkey', 9)} END AS order_id,
               {pick('l_partkey % 5', REASON_TEXTS)} AS return_reason,
               CASE WHEN l_partkey % 61 = 0 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) + 3 AS STRING) END AS return_requested_date,
               {_MONEY.format('l_extendedprice')} AS refund_amount
        FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "raw_sessions": f"{_SESSION}\n        UNION ALL {_SESSION} WHERE event_type = 'signup' AND value >= 100",
}

EXTRACTS = {"customers": "raw_customers", "sellers": "raw_sellers", "products": "raw_products", "orders": "raw_orders",
            "order_items": "raw_order_items", "returns": "raw_returns", "checkout_sessions": "raw_sessions"}


def extract(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return derive(spark, folder, TABLES[EXTRACTS[name]])


def extracts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: extract(spark, folder, name) for name in EXTRACTS}
