"""Clean tables from raw text extracts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom import lookups
from marketloom.functions.dates import to_day
from marketloom.functions.parsing import parse_mixed_date, parse_mixed_ts, safe_date, safe_num, safe_ts
from marketloom.functions.text import and_to_ampersand, map_labels, norm, null_if, strip_currency
from marketloom.operators import cleaning as c
from marketloom.operators.skew import spread_join
from marketloom.rules import DEFAULT_RULES, Rules
from marketloom.session import run_at_once

MONEY = "decimal(14,2)"
PLACE = ("city", "province", "city_tier")


def customer_id_map(raw_customers: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """B-T9: every real account with the id of its person's earliest account."""
    real = c.exclude_prefix(raw_customers, "customer_id", rules.qa_prefix)
    earliest = [safe_date("signup_date"), F.col("customer_id")]
    return c.canonical_map(real, norm("email"), earliest, "customer_id", "raw_customer_id", "customer_id")


def customers(raw_customers: DataFrame, id_map: DataFrame, cities: DataFrame) -> DataFrame:
    """B-T1: one row per person."""
    own = c.keep_canonical(raw_customers, id_map, "customer_id", "raw_customer_id", "customer_id")
    placed = c.standardise(own, "city", cities)
    channel = F.trim("acquisition_channel")
    return placed.select("customer_id", norm("email").alias("email"), safe_date("signup_date").alias("signup_date"),
                         *PLACE,
                         map_labels("acquisition_channel", lookups.CHANNELS, default=channel)
                         .alias("acquisition_channel"),
                         "device_type")


def sellers(raw_sellers: DataFrame) -> DataFrame:
    """B-T2."""
    return raw_sellers.select("seller_id", "seller_name", "seller_city",
                              safe_date("joined_date").alias("joined_date"), "seller_type")


def products(raw_products: DataFrame) -> DataFrame:
    """B-T3: typed, categories standardised."""
    return raw_products.select("product_id", "product_name",
                               map_labels(and_to_ampersand("category"), lookups.CATEGORIES).alias("category"),
                               "subcategory", "brand", "seller_id",
                               safe_num("list_price", MONEY).alias("list_price"),
                               safe_num("unit_cost", MONEY).alias("unit_cost"))


def parse_orders(raw_orders: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Distinct, non-QA orders with typed columns; places and customers still as typed in."""
    real = c.exclude_prefix(c.drop_exact_duplicates(raw_orders), "customer_id", rules.qa_prefix)
    payment_group = map_labels("payment_method", lookups.PAYMENT_GROUPS, default=F.lit(lookups.DEFAULT_PAYMENT_GROUP))
    typed = real.select(
        "order_id", "customer_id", parse_mixed_ts("order_datetime").alias("ordered_at"), "shipping_city",
        map_labels("payment_method", lookups.PAYMENT_METHODS).alias("payment_method"),
        payment_group.alias("payment_group"),
        null_if("promo_code", lookups.NO_PROMO).alias("promo_code"), "courier",
        parse_mixed_date("promised_delivery_date").alias("promised_date"),
        parse_mixed_ts("delivered_at").alias("delivered_at"),
        map_labels("order_status", lookups.ORDER_STATUSES).alias("order_status"),
        strip_currency("shipping_fee").alias("shipping_fee"))
    timed = c.null_if_before(typed, "delivered_at", "ordered_at", "delivered_before_ordered")
    return timed.withColumns({"order_date": to_day("ordered_at"),
                              "from_legacy_system": c.flag_before("ordered_at", rules.legacy_until)})


def orders(raw_orders: DataFrame, id_map: DataFrame, clean_customers: DataFrame, cities: DataFrame,
           rules: Rules = DEFAULT_RULES) -> DataFrame:
    """B-T4: orders of real customers, pointed at the person, with a standard place.

    Only canonical accounts are people, so an account's person and home are joined to each other
    first; the wide orders then shuffle once for both.
    """
    homes = id_map.join(clean_customers.select("customer_id", *[F.col(p).alias(f"_home_{p}") for p in PLACE]),
                        "customer_id", "left")
    accounts = homes.withColumnsRenamed({"customer_id": "_person", "raw_customer_id": "customer_id"})
    linked = spread_join(parse_orders(raw_orders, rules), accounts, "customer_id", "order_id", "left")
    placed = c.coalesce_with(c.standardise(linked, "shipping_city", cities), {p: f"_home_{p}" for p in PLACE})
    return placed.select("order_id", F.coalesce("_person", "customer_id").alias("customer_id"), "ordered_at",
                         "order_date", *PLACE, "payment_method", "payment_group", "promo_code", "courier",
                         "promised_date", "delivered_at", "delivered_before_ordered", "order_status",
                         "shipping_fee", "from_legacy_system")


def order_items(raw_items: DataFrame, clean_products: DataFrame, clean_orders: DataFrame,
                rules: Rules = DEFAULT_RULES) -> DataFrame:
    """B-T5: lines with a known product, a valid quantity and a surviving order; prices repaired.

    The list price that the repair looked up stays on the line, for the checks.
    """
    typed = raw_items.select("order_item_id", "order_id", "product_id", safe_num("quantity", "int").alias("quantity"),
                             safe_num("unit_price", MONEY).alias("_price"),
                             safe_num("discount_pct", "int").alias("discount_pct"))
    kept = c.keep_if_parent(c.drop_non_positive(typed, "quantity"), clean_orders, "order_id")
    valid = kept.join(clean_products.select("product_id", "list_price"), "product_id")
    smallest_slip = min(times for times, _ in rules.price_slips)
    return valid.select("order_item_id", "order_id", "product_id", "quantity", "discount_pct", "list_price",
                        c.repair_magnitude("_price", "list_price", rules.price_slips).alias("unit_price"),
                        c.above_reference("_price", "list_price", smallest_slip).alias("price_corrected"))


def returns(raw_returns: DataFrame, clean_items: DataFrame) -> DataFrame:
    """B-T6: returns of known items; the order comes from the item."""
    typed = raw_returns.select("return_id", "order_item_id", "order_id", F.trim("return_reason").alias("return_reason"),
                               safe_date("return_requested_date").alias("return_requested_date"),
                               safe_num("refund_amount", MONEY).alias("refund_amount"))
    return c.drop_orphans(typed, clean_items, "order_item_id", ["order_id"]).select(*typed.columns)


def checkout_sessions(raw_sessions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """B-T7: typed sessions, one per distinct content, scripted traffic flagged."""
    typed = raw_sessions.select(
        "session_id", "customer_id", safe_ts("session_start").alias("session_start"), "device_type", "traffic_source",
        norm("experiment_group").alias("experiment_group"),
        safe_num("session_duration_sec", "int").alias("session_duration_sec"),
        safe_num("completed_order", "int").alias("completed_order"), safe_num("order_value", MONEY).alias("order_value"))
    flagged = typed.withColumn("is_bot", c.flag_below("session_duration_sec", rules.bot_seconds))
    return c.drop_exact_duplicates(flagged)


# What each clean table is built from, step by step; tables of one step do not need each other.
STEPS = (
    {"city_map": (), "customer_id_map": (), "sellers": (), "products": (), "checkout_sessions": ()},
    {"customers": ("customer_id_map", "city_map")},
    {"orders": ("customer_id_map", "customers", "city_map")},
    {"order_items": ("products", "orders")},
    {"returns": ("order_items",)},
)
TABLES = tuple(name for step in STEPS for name in step)


def with_needs(tables: Iterable[str]) -> set[str]:
    """The tables and everything they are built from."""
    wanted = set(tables)
    for step in reversed(STEPS):
        for name in wanted & set(step):
            wanted.update(step[name])
    return wanted


def build(raw: Mapping[str, DataFrame], rules: Rules = DEFAULT_RULES, keep=lambda name, df: df,
          tables: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    """Clean tables by name. ``keep(name, df)`` may store a table and hand back the stored one."""
    out: dict[str, DataFrame] = {}
    makers = {
        "city_map": lambda: lookups.city_map(raw["orders"].sparkSession),
        "customer_id_map": lambda: customer_id_map(raw["customers"], rules),
        "customers": lambda: customers(raw["customers"], out["customer_id_map"], out["city_map"]),
        "sellers": lambda: sellers(raw["sellers"]),
        "products": lambda: products(raw["products"]),
        "orders": lambda: orders(raw["orders"], out["customer_id_map"], out["customers"], out["city_map"], rules),
        "order_items": lambda: order_items(raw["order_items"], out["products"], out["orders"], rules),
        "returns": lambda: returns(raw["returns"], out["order_items"]),
        "checkout_sessions": lambda: checkout_sessions(raw["checkout_sessions"], rules),
    }
    wanted = with_needs(tables)
    for step in STEPS:
        names = [name for name in step if name in wanted]
        out.update(zip(names, run_at_once(lambda name: keep(name, makers[name]()), names)))
    return out
