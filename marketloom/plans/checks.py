"""The eighteen checks on the cleaned data. Check names are fixed values, as published."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.text import has_prefix
from marketloom.operators import quality as q
from marketloom.operators.modelling import DELIVERED
from marketloom.rules import AB_GROUPS, DEFAULT_RULES, Rules


def declared(rules: Rules = DEFAULT_RULES) -> dict[str, list]:
    return {
        "orders": [
            q.check_unique("clean.orders: order_id is unique", "order_id"),
            q.check_not_null("clean.orders: every timestamp parsed", "ordered_at"),
            q.check_not_null("clean.orders: every payment label mapped", "payment_method"),
            q.check_not_null("clean.orders: every status label mapped", "order_status"),
            q.check_predicate("clean.orders: no delivery before the order", F.col("delivered_at") < F.col("ordered_at")),
            q.check_predicate("clean.orders: no QA test accounts", has_prefix("customer_id", rules.qa_prefix)),
            q.check_fk("clean.orders: every customer exists", "customers", "customer_id"),
            q.check_not_null("clean.orders: city known", "city", warn=True),
            q.check_predicate("clean.orders: delivered with no delivery time",
                              (F.col("order_status") == DELIVERED) & F.col("delivered_at").isNull(), warn=True)],
        "customers": [q.check_unique("clean.customers: one account per email", "email")],
        "products": [q.check_not_null("clean.products: every category mapped", "category")],
        "order_items": [
            q.check_predicate("clean.order_items: quantity is positive", F.col("quantity") <= 0),
            q.check_fk("clean.order_items: every item has an order", "orders", "order_id"),
            q.check_predicate("clean.order_items: price never above list price", F.col("unit_price") > F.col("list_price"))],
        "returns": [q.check_fk("clean.returns: every return has an item", "order_items", "order_item_id")],
        "checkout_sessions": [
            q.check_unique("clean.checkout_sessions: session_id is unique", "session_id"),
            q.check_in_set("clean.checkout_sessions: group is control or treatment", "experiment_group", AB_GROUPS)],
        "fact_orders": [q.check_predicate("mart.fact_orders: net revenue never negative", F.col("net_revenue") < 0)],
    }


def build(clean: Mapping[str, DataFrame], fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Clean items carry the list price that their repair looked up, so no check joins anything."""
    return q.run_checks({**clean, "fact_orders": fact}, declared(rules))
