"""Cleaning rules and clean tables, on untidy text derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom import lookups
from marketloom.bindings import base_table, messy, star
from marketloom.functions import parsing, text
from marketloom.functions.dates import to_day
from marketloom.operators import cleaning as c
from marketloom.plans import clean_layer as layer
from queries import query
from queries import sql as s

R = messy.RULES


def expressions(name, covers, extract, sql, *columns):
    """A rule that is a column expression over one extract."""
    query(name, covers, s.on_raw(sql, messy.EXTRACTS[extract]))(
        lambda spark, folder: messy.extract(spark, folder, extract).select(*[col() for col in columns]))


def _col(name):
    return lambda: F.col(name)


@query("drop_exact_duplicates", "B1", s.on_raw("SELECT DISTINCT * FROM raw_orders", "raw_orders"))
def _(spark, folder):
    return c.drop_exact_duplicates(messy.extract(spark, folder, "orders"))


expressions("parse_mixed_ts", "B2", "orders", f"""
    SELECT order_id, order_datetime, {s.mixed_ts('order_datetime')} AS ordered_at, {s.mixed_ts('delivered_at')} AS delivered
    FROM raw_orders""", _col("order_id"), _col("order_datetime"),
            lambda: parsing.parse_mixed_ts("order_datetime").alias("ordered_at"),
            lambda: parsing.parse_mixed_ts("delivered_at").alias("delivered"))

expressions("parse_mixed_date", "B3", "orders", f"""
    SELECT order_id, {s.mixed_date('promised_delivery_date')} AS promised_date FROM raw_orders""", _col("order_id"),
            lambda: parsing.parse_mixed_date("promised_delivery_date").alias("promised_date"))

expressions("safe_date", "B4", "customers", f"""
    SELECT customer_id, {s.iso_date('signup_date')} AS signup_date FROM raw_customers""", _col("customer_id"),
            lambda: parsing.safe_date("signup_date").alias("signup_date"))

expressions("safe_ts", "B4", "checkout_sessions", """
    SELECT session_id, TRY_STRPTIME(session_start, '%Y-%m-%d %H:%M:%S') AS session_start FROM raw_sessions""",
            _col("session_id"), lambda: parsing.safe_ts("session_start").alias("session_start"))

expressions("safe_num", "B5", "order_items", """
    SELECT order_item_id, TRY_CAST(quantity AS BIGINT) AS quantity, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
           TRY_CAST(discount_pct AS BIGINT) AS discount_pct FROM raw_order_items""", _col("order_item_id"),
            lambda: parsing.safe_num("quantity", "int").alias("quantity"),
            lambda: parsing.safe_num("unit_price", layer.MONEY).alias("unit_price"),
            lambda: parsing.safe_num("discount_pct", "int").alias("discount_pct"))

expressions("strip_currency", "B6", "orders", """
    SELECT order_id, shipping_fee AS fee_text, CAST(LTRIM(REPLACE(shipping_fee, 'Rs.', '')) AS BIGINT) AS fee FROM raw_orders""",
            _col("order_id"), lambda: F.col("shipping_fee").alias("fee_text"),
            lambda: text.strip_currency("shipping_fee").alias("fee"))

expressions("null_if_sentinel", "B7", "orders", """
    SELECT order_id, CASE WHEN UPPER(TRIM(promo_code)) NOT IN ('', 'NONE') THEN UPPER(TRIM(promo_code)) END AS promo_code
    FROM raw_orders""", _col("order_id"), lambda: text.null_if("promo_code", lookups.NO_PROMO).alias("promo_code"))

expressions("map_labels_closed", "B8", "orders", f"""
    SELECT order_id, {s.label_case('payment_method', lookups.PAYMENT_METHODS)} AS payment_method,
           {s.label_case('order_status', lookups.ORDER_STATUSES)} AS order_status FROM raw_orders""", _col("order_id"),
            lambda: text.map_labels("payment_method", lookups.PAYMENT_METHODS).alias("payment_method"),
            lambda: text.map_labels("order_status", lookups.ORDER_STATUSES).alias("order_status"))

expressions("map_categories", "B8", "products", f"""
    SELECT product_id, {s.label_case("REGEXP_REPLACE(category, ' and ', ' & ', 'gi')", lookups.CATEGORIES)} AS category
    FROM raw_products""", _col("product_id"),
            lambda: text.map_labels(text.and_to_ampersand("category"), lookups.CATEGORIES).alias("category"))

expressions("map_labels_open", "B9", "customers", f"""
    SELECT customer_id, {s.label_case('acquisition_channel', lookups.CHANNELS, 'TRIM(acquisition_channel)')} AS channel
    FROM raw_customers""", _col("customer_id"),
            lambda: text.map_labels("acquisition_channel", lookups.CHANNELS, F.trim("acquisition_channel")).alias("channel"))

expressions("payment_group", "B10", "orders", """
    SELECT order_id, CASE WHEN LOWER(TRIM(payment_method)) IN ('cod', 'cash on delivery', 'cash_on_delivery')
                          THEN 'COD' ELSE 'Prepaid' END AS payment_group FROM raw_orders""", _col("order_id"),
            lambda: text.map_labels("payment_method", lookups.PAYMENT_GROUPS, F.lit("Prepaid")).alias("payment_group"))

expressions("normalise_labels", "B11", "checkout_sessions", """
    SELECT session_id, LOWER(TRIM(experiment_group)) AS experiment_group FROM raw_sessions""", _col("session_id"),
            lambda: text.norm("experiment_group").alias("experiment_group"))


@query("standardise_join", "B12 A2 B-T8", s.on_raw("""
    SELECT r.order_id, m.city, m.province, CAST(m.city_tier AS BIGINT) AS city_tier
    FROM raw_orders r LEFT JOIN city_map m ON m.raw_key = LOWER(TRIM(r.shipping_city))""", "raw_orders", extra=[s.CITY_MAP]))
def _(spark, folder):
    orders = messy.extract(spark, folder, "orders").select("order_id", "shipping_city")
    return c.standardise(orders, "shipping_city", lookups.city_map(spark))


@query("fill_from_parent", "B13", s.on_raw("""
    SELECT r.order_id, COALESCE(m.city, h.city) AS city, COALESCE(m.province, h.province) AS province,
           CAST(COALESCE(m.city_tier, h.city_tier) AS BIGINT) AS city_tier
    FROM raw_orders r LEFT JOIN city_map m ON m.raw_key = LOWER(TRIM(r.shipping_city))
    LEFT JOIN (SELECT c.customer_id, p.city, p.province, p.city_tier FROM raw_customers c
               JOIN city_map p ON p.raw_key = LOWER(TRIM(c.city))) h ON h.customer_id = r.customer_id""",
                                            "raw_orders", "raw_customers", extra=[s.CITY_MAP]))
def _(spark, folder):
    cities = lookups.city_map(spark)
    homes = c.standardise(messy.extract(spark, folder, "customers").select("customer_id", "city"), "city", cities)
    orders = messy.extract(spark, folder, "orders").select("order_id", "customer_id", "shipping_city")
    placed = c.standardise(orders, "shipping_city", cities)
    return c.fill_from_parent(placed, homes, "customer_id", "order_id", layer.PLACE).drop("customer_id")


query("customer_id_map", "B14 B-T9", s.answer(
    "SELECT * FROM id_map", s.UP_TO_CUSTOMERS))(
    lambda spark, folder: layer.customer_id_map(messy.extract(spark, folder, "customers"), R))


@query("canonical_documents", "B14", """
    SELECT doc_id, FIRST_VALUE(doc_id) OVER (PARTITION BY LOWER(TRIM(text)) ORDER BY n_chars, doc_id) AS canonical_id
    FROM documents WHERE text IS NOT NULL""")
def _(spark, folder):
    # Whole texts are compared through their SHA-256, so that texts are not shuffled.
    documents = base_table(spark, folder, "documents")
    match = F.sha2(text.norm("text"), 256)
    return c.canonical_map(documents, match, [F.col("n_chars"), F.col("doc_id")], "doc_id", "doc_id", "canonical_id")


@query("keep_canonical", "B15", s.answer(
    "SELECT customer_id, email FROM raw_customers WHERE customer_id IN (SELECT customer_id FROM id_map)", s.UP_TO_CUSTOMERS))
def _(spark, folder):
    accounts = messy.extract(spark, folder, "customers")
    id_map = layer.customer_id_map(accounts, R)
    kept = c.keep_canonical(accounts, id_map, "customer_id", "raw_customer_id", "customer_id")
    return kept.select("customer_id", "email")


@query("reattribute", "B16", s.answer("""
    SELECT o.order_id, COALESCE(i.customer_id, o.customer_id) AS customer_id
    FROM raw_orders o LEFT JOIN id_map i ON i.raw_customer_id = o.customer_id""", s.UP_TO_ORDERS))
def _(spark, folder):
    id_map = layer.customer_id_map(messy.extract(spark, folder, "customers"), R)
    orders = messy.extract(spark, folder, "orders").select("order_id", "customer_id")
    return c.reattribute(orders, id_map, "customer_id", "order_id", "raw_customer_id", "customer_id")


@query("exclude_prefix", "B17", s.on_raw("""
    SELECT customer_id, email FROM raw_customers WHERE UPPER(LEFT(customer_id, 4)) <> 'TEST'""", "raw_customers"))
def _(spark, folder):
    return c.exclude_prefix(messy.extract(spark, folder, "customers"), "customer_id", "TEST").select("customer_id", "email")


@query("null_if_before", "B18", s.on_raw(f"""
    SELECT order_id, CASE WHEN d < o THEN NULL ELSE d END AS delivered, COALESCE(d < o, FALSE) AS impossible
    FROM (SELECT order_id, {s.mixed_ts('order_datetime')} AS o, {s.mixed_ts('delivered_at')} AS d FROM raw_orders)""",
                                         "raw_orders"))
def _(spark, folder):
    parsed = messy.extract(spark, folder, "orders").select(
        "order_id", parsing.parse_mixed_ts("order_datetime").alias("ordered"),
        parsing.parse_mixed_ts("delivered_at").alias("delivered"))
    return c.null_if_before(parsed, "delivered", "ordered", "impossible").drop("ordered")


@query("repair_magnitude", "B19", s.on_star("""
    SELECT i.order_item_id,
           CAST(CASE WHEN i.unit_price > 50 * p.list_price THEN CAST(i.unit_price / 100 + 1e-7 AS DECIMAL(14,2))
                     WHEN i.unit_price > 5 * p.list_price THEN CAST(i.unit_price / 10 + 1e-7 AS DECIMAL(14,2))
                     ELSE i.unit_price END AS DOUBLE) AS unit_price,
           i.unit_price > 5 * p.list_price AS price_corrected
    FROM order_items i JOIN products p USING (product_id)""", "order_items", "products"))
def _(spark, folder):
    items = star.table(spark, folder, "order_items").select("order_item_id", "product_id", "unit_price")
    priced = items.join(star.table(spark, folder, "products").select("product_id", "list_price"), "product_id")
    return priced.select("order_item_id", c.repair_magnitude("unit_price", "list_price", R.price_slips).alias("unit_price"),
                         c.above_reference("unit_price", "list_price", 5).alias("price_corrected"))


@query("drop_non_positive", "B20", s.on_raw("""
    SELECT order_item_id, TRY_CAST(quantity AS BIGINT) AS quantity FROM raw_order_items
    WHERE TRY_CAST(quantity AS BIGINT) >= 1""", "raw_order_items"))
def _(spark, folder):
    items = messy.extract(spark, folder, "order_items")
    return c.drop_non_positive(items.select("order_item_id", parsing.safe_num("quantity", "int").alias("quantity")), "quantity")


@query("keep_if_parent", "B21", s.on_raw("""
    SELECT order_item_id, order_id FROM raw_order_items
    WHERE order_id IN (SELECT order_id FROM raw_orders WHERE UPPER(LEFT(customer_id, 4)) <> 'TEST')""",
                                         "raw_order_items", "raw_orders"))
def _(spark, folder):
    real = c.exclude_prefix(messy.extract(spark, folder, "orders"), "customer_id", "TEST")
    items = messy.extract(spark, folder, "order_items").select("order_item_id", "order_id")
    return c.keep_if_parent(items, real, "order_id")


@query("drop_orphans", "B22", s.on_raw("""
    SELECT r.return_id, r.order_item_id, i.order_id FROM raw_returns r JOIN raw_order_items i USING (order_item_id)""",
                                       "raw_returns", "raw_order_items"))
def _(spark, folder):
    returns = messy.extract(spark, folder, "returns").select("return_id", "order_item_id", "order_id")
    return c.drop_orphans(returns, messy.extract(spark, folder, "order_items"), "order_item_id", ["order_id"])


expressions("flag_below", "B23", "checkout_sessions", """
    SELECT session_id, COALESCE(TRY_CAST(session_duration_sec AS BIGINT), 3) < 3 AS is_bot FROM raw_sessions""",
            _col("session_id"), lambda: c.flag_below(parsing.safe_num("session_duration_sec", "int"), 3).alias("is_bot"))

expressions("flag_before", "B24", "orders", f"""
    SELECT order_id, COALESCE(YEAR({s.mixed_ts('order_datetime')}) < 1998, FALSE) AS from_legacy_system FROM raw_orders""",
            _col("order_id"),
            lambda: c.flag_before(parsing.parse_mixed_ts("order_datetime"), R.legacy_until).alias("from_legacy_system"))

expressions("to_day", "B25", "orders", f"""
    SELECT order_id, CAST({s.mixed_ts('order_datetime')} AS DATE) AS order_date FROM raw_orders""", _col("order_id"),
            lambda: to_day(parsing.parse_mixed_ts("order_datetime")).alias("order_date"))


# --- clean tables -----------------------------------------------------------------------------

def clean_tables(spark, folder, *tables, keep=lambda name, df: df):
    return layer.build(messy.extracts(spark, folder), R, keep, tables)


def clean_table(name, covers, columns, source, *parts):
    query(f"clean_{name}", covers, s.answer(f"SELECT {s.typed(columns)} FROM {source}", *parts))(
        lambda spark, folder: clean_tables(spark, folder, name)[name].select(*[c.split(":")[0] for c in columns.split()]))


clean_table("customers", "B-T1", "customer_id email signup_date city province city_tier:b acquisition_channel device_type",
            "clean_customers", s.UP_TO_CUSTOMERS)

query("clean_sellers", "B-T2", s.on_raw(f"""
    SELECT seller_id, seller_name, seller_city, {s.iso_date('joined_date')} AS joined_date, seller_type FROM raw_sellers""",
                                        "raw_sellers"))(
    lambda spark, folder: layer.sellers(messy.extract(spark, folder, "sellers")))

query("clean_products", "B-T3", s.on_raw(
    "SELECT " + s.typed("product_id product_name category subcategory brand seller_id list_price:d unit_cost:d")
    + " FROM clean_products", "raw_products", extra=[s.CLEAN_PRODUCTS]))(
    lambda spark, folder: layer.products(messy.extract(spark, folder, "products")))

clean_table("orders", "B-T4 B13 B16", "order_id customer_id ordered_at order_date city province city_tier:b "
            "payment_method payment_group promo_code courier promised_date delivered_at delivered_before_ordered "
            "order_status shipping_fee:b from_legacy_system", "clean_orders", s.UP_TO_ORDERS)
clean_table("order_items", "B-T5", "order_item_id order_id product_id quantity:b discount_pct:b unit_price:d price_corrected",
            "clean_items", s.UP_TO_ITEMS)
clean_table("returns", "B-T6", "return_id order_item_id order_id return_reason return_requested_date refund_amount:d",
            "clean_returns", s.ALL_CLEAN)

query("clean_checkout_sessions", "B-T7", s.on_raw(
    "SELECT " + s.typed("session_id customer_id session_start device_type traffic_source experiment_group "
                        "session_duration_sec:b completed_order:b order_value:d is_bot") + " FROM clean_sessions",
    "raw_sessions", extra=[s.CLEAN_SESSIONS]))(
    lambda spark, folder: layer.checkout_sessions(messy.extract(spark, folder, "checkout_sessions"), R))
