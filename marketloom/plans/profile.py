"""The scorecard of defects in the raw extracts. Check names are fixed values, as published."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.parsing import LEGACY_TIMESTAMP, safe_num
from marketloom.functions.text import is_blank, norm
from marketloom.lookups import ORDER_STATUSES
from marketloom.operators import profiling as p
from marketloom.rules import DEFAULT_RULES, Rules

MONEY = "decimal(14,2)"
LABEL_FIELDS = (("orders", ("payment_method", "order_status")), ("checkout_sessions", ("experiment_group",)),
                ("products", ("category",)))


def scorecard(raw: Mapping[str, DataFrame], rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The nineteen counts. Each table is read once for its plain counts, once for its spellings."""
    orders, customers, products = raw["orders"], raw["customers"], raw["products"]
    items, returns, sessions = raw["order_items"], raw["returns"], raw["checkout_sessions"]
    delivered = norm("order_status").isin(*ORDER_STATUSES["Delivered"])

    def spellings(df, names):
        return p.count_spellings(p.label_inventory([(df, list(names))]), names)

    return p.scorecard({
        "orders": [
            p.one_row(orders, {
                "rows": p.count_rows(),
                "legacy date format DD/MM/YYYY HH:MI": p.count_like("order_datetime", LEGACY_TIMESTAMP.shape),
                "blank shipping_city": p.count_blank("shipping_city"),
                "shipping_fee stored as text like Rs. 150": p.count_like("shipping_fee", "Rs.%"),
                "delivered status but blank delivered_at": p.count_where(delivered & is_blank("delivered_at")),
                "orders from QA test accounts": p.count_prefix("customer_id", rules.qa_prefix)}),
            p.count_duplicate_rows(orders, "exact duplicate rows (ingestion retry)"),
            spellings(orders, {"shipping_city": "distinct spellings of shipping_city",
                               "payment_method": "distinct payment_method labels",
                               "order_status": "distinct order_status labels"})],
        "customers": [p.one_row(customers, {
            "duplicate accounts (same email after trim and lower-case)": p.count_excess(norm("email")),
            "blank signup_date": p.count_blank("signup_date")})],
        "products": [spellings(products, {"category": "distinct spellings of category"})],
        "order_items": [
            p.one_row(items, {"quantity zero or negative": p.count_where(safe_num("quantity", "int") <= 0)}),
            p.count_above_ratio(items, products, "product_id", safe_num("unit_price", MONEY),
                                safe_num("list_price", MONEY), 5,
                                "unit_price above 5x list price (extra zero typed)")],
        "returns": [p.count_orphans(returns, items, "order_item_id", "orphan returns (order_item_id not found)")],
        "checkout_sessions": [
            p.one_row(sessions, {
                "duplicate session rows": p.count_excess("session_id"),
                "sessions under 3 seconds (likely bots)":
                    p.count_where(safe_num("session_duration_sec", "int") < rules.bot_seconds)}),
            spellings(sessions, {"experiment_group": "distinct experiment_group labels"})],
    })


def city_spellings(raw: Mapping[str, DataFrame]) -> DataFrame:
    return p.value_inventory(raw["orders"], "shipping_city", "raw_city", "orders")


def label_inventory(raw: Mapping[str, DataFrame]) -> DataFrame:
    found = p.label_inventory([(raw[table], fields) for table, fields in LABEL_FIELDS])
    return found.orderBy("field", F.desc("rows_count"), F.asc_nulls_last("raw_value"), "characters")


def build(raw: Mapping[str, DataFrame], rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    return {"profile_data_quality_scorecard": scorecard(raw, rules), "profile_city_spellings": city_spellings(raw),
            "profile_label_inventory": label_inventory(raw)}
