"""Profiling of the untidy extracts and checks of the clean tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.bindings import messy, star
from marketloom.functions.parsing import LEGACY_TIMESTAMP
from marketloom.operators import profiling as p
from marketloom.operators.quality import failed
from marketloom.plans import checks, mart, profile
from marketloom.session import stored
from queries import query
from queries import sql as s
from queries.cleaning import clean_tables

RAW = tuple(messy.TABLES)


def keep_once(name, df):
    """Clean tables are read by many checks, so each is evaluated once. The city list is in the plan as it is."""
    return df if name == "city_map" else stored(df, name)


def _count(table, name, expr, source):
    return f"SELECT '{table}' AS table_name, '{name}' AS check_name, {s.big(expr)} AS rows_affected FROM {source}"


def _spellings(column):
    return f"COUNT(DISTINCT {column})"


SCORECARD = " UNION ALL ".join([
    _count("orders", "rows", "COUNT(*)", "raw_orders"),
    _count("orders", "legacy date format DD/MM/YYYY HH:MI", "COUNT(*) FILTER (order_datetime LIKE '__/__/____ __:__')", "raw_orders"),
    _count("orders", "blank shipping_city", "COUNT(*) FILTER (COALESCE(TRIM(shipping_city), '') = '')", "raw_orders"),
    _count("orders", "shipping_fee stored as text like Rs. 150", "COUNT(*) FILTER (shipping_fee LIKE 'Rs.%')", "raw_orders"),
    _count("orders", "delivered status but blank delivered_at",
           "COUNT(*) FILTER (LOWER(TRIM(order_status)) IN ('dlvd', 'delivered') AND COALESCE(TRIM(delivered_at), '') = '')", "raw_orders"),
    _count("orders", "orders from QA test accounts", "COUNT(*) FILTER (customer_id ILIKE 'test%')", "raw_orders"),
    _count("orders", "exact duplicate rows (ingestion retry)", "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_orders))", "raw_orders"),
    _count("orders", "distinct spellings of shipping_city", _spellings("shipping_city"), "raw_orders"),
    _count("orders", "distinct payment_method labels", _spellings("payment_method"), "raw_orders"),
    _count("orders", "distinct order_status labels", _spellings("order_status"), "raw_orders"),
    _count("customers", "duplicate accounts (same email after trim and lower-case)", "COUNT(*) - COUNT(DISTINCT LOWER(TRIM(email)))", "raw_customers"),
    _count("customers", "blank signup_date", "COUNT(*) FILTER (COALESCE(TRIM(signup_date), '') = '')", "raw_customers"),
    _count("products", "distinct spellings of category", _spellings("category"), "raw_products"),
    _count("order_items", "quantity zero or negative", "COUNT(*) FILTER (TRY_CAST(quantity AS BIGINT) <= 0)", "raw_order_items"),
    _count("order_items", "unit_price above 5x list price (extra zero typed)",
           "COUNT(*) FILTER (TRY_CAST(unit_price AS DECIMAL(14,2)) > 5 * TRY_CAST(list_price AS DECIMAL(14,2)))",
           "raw_order_items JOIN raw_products USING (product_id)"),
    _count("returns", "orphan returns (order_item_id not found)",
           "COUNT(*) FILTER (r.order_item_id NOT IN (SELECT order_item_id FROM raw_order_items))", "raw_returns r"),
    _count("checkout_sessions", "duplicate session rows", "COUNT(*) - COUNT(DISTINCT session_id)", "raw_sessions"),
    _count("checkout_sessions", "sessions under 3 seconds (likely bots)", "COUNT(*) FILTER (TRY_CAST(session_duration_sec AS BIGINT) < 3)", "raw_sessions"),
    _count("checkout_sessions", "distinct experiment_group labels", _spellings("experiment_group"), "raw_sessions"),
])


query("scorecard", "C1 C2 C3 C4 C5 C6 C7 C8 C9 C10 C11 C12 C13 C14 C15 C16 C17 C18 C19 C20", s.on_raw(SCORECARD, *RAW))(
    lambda spark, folder: profile.scorecard(messy.extracts(spark, folder), messy.RULES))


@query("count_duplicate_rows", "C2", s.on_raw("""
    SELECT 'repeated sessions' AS check_name, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_sessions)) AS rows_affected
    FROM raw_sessions""", "raw_sessions"))
def _(spark, folder):
    return p.count_duplicate_rows(messy.extract(spark, folder, "checkout_sessions"), "repeated sessions")


@query("count_orphans", "C16", s.on_raw("""
    SELECT 'returns without item' AS check_name, COUNT(*) FILTER (i.order_item_id IS NULL) AS rows_affected
    FROM raw_returns r LEFT JOIN (SELECT DISTINCT order_item_id FROM raw_order_items) i USING (order_item_id)""",
    "raw_returns", "raw_order_items"))
def _(spark, folder):
    return p.count_orphans(messy.extract(spark, folder, "returns"), messy.extract(spark, folder, "order_items"),
                           "order_item_id", "returns without item")


query("value_inventory", "C21", s.on_raw("""
    SELECT shipping_city AS raw_city, LENGTH(shipping_city) AS characters, COUNT(*) AS orders
    FROM raw_orders GROUP BY shipping_city ORDER BY orders DESC, raw_city NULLS LAST""", "raw_orders"))(
    lambda spark, folder: profile.city_spellings({"orders": messy.extract(spark, folder, "orders")}))

query("label_inventory", "C22", s.on_raw(" UNION ALL ".join(
    f"SELECT '{field}' AS field, {field} AS raw_value, LENGTH({field}) AS characters, COUNT(*) AS rows_count "
    f"FROM {messy.EXTRACTS[table]} GROUP BY {field}" for table, fields in profile.LABEL_FIELDS for field in fields),
    "raw_orders", "raw_sessions", "raw_products"))(
    lambda spark, folder: profile.label_inventory(messy.extracts(spark, folder)))

query("insensitive_distinct", "C23", s.on_raw("""
    SELECT COUNT(DISTINCT LOWER(RTRIM(shipping_city))) AS loose_spellings, COUNT(DISTINCT shipping_city) AS real_spellings
    FROM raw_orders""", "raw_orders"))(
    lambda spark, folder: p.spelling_gap(messy.extract(spark, folder, "orders"), "shipping_city"))

LOSS = {"orders": ("raw_orders", "clean_orders"), "customers": ("raw_customers", "clean_customers"),
        "order_items": ("raw_order_items", "clean_items"), "returns": ("raw_returns", "clean_returns"),
        "checkout_sessions": ("raw_sessions", "clean_sessions")}


@query("row_loss", "C24", s.answer(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {raw}) AS raw_rows, (SELECT COUNT(*) FROM {clean}) AS clean_rows"
    for t, (raw, clean) in LOSS.items()), s.ALL_CLEAN))
def _(spark, folder):
    raw = messy.extracts(spark, folder)
    clean = clean_tables(spark, folder, *LOSS, keep=keep_once)
    return p.row_loss({t: raw[t] for t in LOSS}, {t: clean[t] for t in LOSS})


@query("before_after", "C25", s.answer("""
    SELECT 'raw' AS layer, order_datetime AS ordered, shipping_city AS city, shipping_fee, order_status
    FROM raw_orders WHERE order_id = (SELECT id FROM picked)
    UNION ALL
    SELECT 'clean', STRFTIME(ordered_at, '%Y-%m-%d %H:%M:%S'), city, CAST(shipping_fee AS VARCHAR), order_status
    FROM clean_orders WHERE order_id = (SELECT id FROM picked)""", s.UP_TO_ORDERS,
    "picked AS (SELECT MIN(order_id) AS id FROM raw_orders WHERE order_datetime LIKE '__/__/____ __:__')"))
def _(spark, folder):
    raw, clean = messy.extract(spark, folder, "orders"), clean_tables(spark, folder, "orders")["orders"]
    pick = p.first_key(raw, F.col("order_datetime").like(LEGACY_TIMESTAMP.shape), "order_id")
    shown = ["shipping_fee", "order_status"]
    return p.before_after(
        raw.select("order_id", F.col("order_datetime").alias("ordered"), F.col("shipping_city").alias("city"), *shown),
        clean.select("order_id", F.col("ordered_at").cast("string").alias("ordered"), "city", *shown),
        "order_id", pick)


@query("sample_top", "C26", s.on_raw("""
    SELECT DISTINCT order_id, order_datetime, shipping_city, payment_method, order_status, shipping_fee
    FROM raw_orders ORDER BY order_id LIMIT 20""", "raw_orders"))
def _(spark, folder):
    columns = ["order_id", "order_datetime", "shipping_city", "payment_method", "order_status", "shipping_fee"]
    return p.sample_top(messy.extract(spark, folder, "orders").select(*columns).distinct(), columns, ["order_id"], 20)


HISTORY = ["customer_id", "customer_order_seq", "order_date", "city", "payment_group", "order_status", "gmv",
           "net_revenue", "delivery_days", "is_late", "is_rto"]


@query("entity_history", "C27", s.on_dim(
    "SELECT " + s.typed("customer_id customer_order_seq order_date city payment_group order_status gmv:d net_revenue:d "
                        "delivery_days:b is_late is_rto") + """ FROM fact
    WHERE customer_id = (SELECT MIN(customer_id) FROM dim WHERE orders >= 5) ORDER BY customer_order_seq LIMIT 20"""))
def _(spark, folder):
    fact, dim = star.stored_mart(spark, folder)
    return p.entity_history(fact, dim, "customer_id", F.col("orders") >= 5, HISTORY,
                            "customer_order_seq", 20)


# --- quality ----------------------------------------------------------------------------------

def _check(name, expr, source):
    return f"SELECT '{name}' AS check_name, {s.big(expr)} AS failing_rows FROM {source}"


# Gross less refunds of delivered orders, from the clean tables.
NET = """net AS (
    SELECT order_id, CASE WHEN MAX(order_status) = 'Delivered' THEN MAX(gmv) - COALESCE(MAX(refunds), 0) ELSE 0 END AS net_revenue
    FROM clean_orders
    JOIN (SELECT order_id, SUM(quantity * unit_price) AS gmv FROM clean_items GROUP BY 1) USING (order_id)
    LEFT JOIN (SELECT order_id, SUM(refund_amount) AS refunds FROM clean_returns GROUP BY 1) USING (order_id) GROUP BY 1)"""
CHECKS = " UNION ALL ".join([
    _check("clean.orders: order_id is unique", "COUNT(*) - COUNT(DISTINCT order_id)", "clean_orders"),
    _check("clean.orders: every timestamp parsed", "COUNT(*) - COUNT(ordered_at)", "clean_orders"),
    _check("clean.orders: every payment label mapped", "COUNT(*) - COUNT(payment_method)", "clean_orders"),
    _check("clean.orders: every status label mapped", "COUNT(*) - COUNT(order_status)", "clean_orders"),
    _check("clean.orders: no delivery before the order", "COUNT(*) FILTER (delivered_at < ordered_at)", "clean_orders"),
    _check("clean.orders: no QA test accounts", "COUNT(*) FILTER (customer_id ILIKE 'test%')", "clean_orders"),
    _check("clean.orders: every customer exists", "COUNT(*) FILTER (c.customer_id IS NULL)",
           "clean_orders o LEFT JOIN clean_customers c ON c.customer_id = o.customer_id"),
    _check("clean.orders: city known (warning)", "COUNT(*) - COUNT(city)", "clean_orders"),
    _check("clean.orders: delivered with no delivery time (warning)",
           "COUNT(*) FILTER (order_status = 'Delivered' AND delivered_at IS NULL)", "clean_orders"),
    _check("clean.customers: one account per email", "COUNT(*) - COUNT(DISTINCT email)", "clean_customers"),
    _check("clean.products: every category mapped", "COUNT(*) - COUNT(category)", "clean_products"),
    _check("clean.order_items: quantity is positive", "COUNT(*) FILTER (quantity <= 0)", "clean_items"),
    _check("clean.order_items: every item has an order", "COUNT(*) FILTER (order_id NOT IN (SELECT order_id FROM clean_orders))", "clean_items"),
    _check("clean.order_items: price never above list price", "COUNT(*) FILTER (unit_price > list_price)",
           "clean_items JOIN clean_products USING (product_id)"),
    _check("clean.returns: every return has an item", "COUNT(*) FILTER (order_item_id NOT IN (SELECT order_item_id FROM clean_items))", "clean_returns"),
    _check("clean.checkout_sessions: session_id is unique", "COUNT(*) - COUNT(DISTINCT session_id)", "clean_sessions"),
    _check("clean.checkout_sessions: group is control or treatment",
           "COUNT(*) FILTER (experiment_group NOT IN ('control', 'treatment'))", "clean_sessions"),
    _check("mart.fact_orders: net revenue never negative", "COUNT(*) FILTER (net_revenue < 0)", "net"),
])
VERDICT = """SELECT check_name, failing_rows,
       CASE WHEN failing_rows = 0 THEN 'PASS' WHEN check_name LIKE '%(warning)%' THEN 'WARN' ELSE 'FAIL' END AS result
    FROM checks"""


def quality(spark, folder):
    clean = clean_tables(spark, folder, "customers", "products", "orders", "order_items", "returns", "checkout_sessions",
                         keep=keep_once)
    fact = mart.order_facts(clean["orders"], clean["order_items"], clean["returns"], clean["products"])
    return checks.build(clean, fact, messy.RULES)


query("quality_checks", "F1 F2 F3 F4 F5 F6 F7 F8 F9 F10 F11 F12 F13 F14 F15 F16 F17 F18 F19",
      s.answer(VERDICT, s.ALL_CLEAN, NET, f"checks AS ({CHECKS})"))(quality)


@query("failing_checks", "F20", s.answer(
    f"SELECT * FROM ({VERDICT}) WHERE result = 'FAIL' ORDER BY check_name", s.ALL_CLEAN, NET, f"checks AS ({CHECKS})"))
def _(spark, folder):
    """What the gate raises for."""
    return failed(quality(spark, folder))
