"""Fact and dimension building."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.dates import days_between, month_bucket, to_day
from marketloom.functions.money import cents, total, total_times
from marketloom.operators.ranking import number_in_steps

DELIVERED = "Delivered"
RETURNED = "Returned to Origin"
SHIPPED = (DELIVERED, RETURNED)


def is_status(status: str, column: str = "order_status") -> Column:
    return F.coalesce(F.col(column) == status, F.lit(False))


# --- order grain ------------------------------------------------------------------------------

def rollup_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items, units and money per order."""
    charged = items.select("order_id", "product_id", "quantity", cents("unit_price").alias("gmv"))
    listed = products.select("product_id", cents("unit_cost").alias("cogs"), cents("list_price").alias("list_value"))
    sums = ("gmv", "cogs", "list_value")
    lines = charged.join(listed, "product_id")
    return lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("items_count"), F.sum("quantity").alias("units"),
                                         *[total_times("quantity", c).alias(c) for c in sums])


def rollup_returns(returns: DataFrame) -> DataFrame:
    """Returned items and refunds per order."""
    refunds = returns.select("order_id", cents("refund_amount").alias("refunded_value"))
    return refunds.groupBy("order_id").agg(F.count(F.lit(1)).alias("returned_items"),
                                           total("refunded_value").alias("refunded_value"))


def with_discount_value(df: DataFrame) -> DataFrame:
    """List value not charged."""
    return df.withColumn("discount_value", F.col("list_value") - F.col("gmv")).drop("list_value")


def with_net_revenue(df: DataFrame) -> DataFrame:
    """Charged less refunded for delivered orders, 0 for all others."""
    kept = F.col("gmv") - F.col("refunded_value")
    return df.withColumn("net_revenue", F.when(is_status(DELIVERED), kept).otherwise(F.lit(0)))


def _arrived() -> Column:
    return is_status(DELIVERED) & F.col("delivered_at").isNotNull()


def with_lead_times(df: DataFrame) -> DataFrame:
    """Days promised, and days taken by orders that arrived at a known time."""
    return df.withColumns({
        "promised_days": days_between("order_date", "promised_date"),
        "delivery_days": F.when(_arrived(), days_between("order_date", to_day("delivered_at")))})


def with_is_late(df: DataFrame) -> DataFrame:
    """By calendar day; NULL where no arrival time is known, false where nothing was promised."""
    late = F.coalesce(to_day("delivered_at") > F.col("promised_date"), F.lit(False))
    return df.withColumn("is_late", F.when(_arrived(), late))


def with_status_flag(df: DataFrame, status: str, name: str) -> DataFrame:
    """D9."""
    return df.withColumn(name, is_status(status))


def with_order_seq(df: DataFrame) -> DataFrame:
    """Each customer's orders numbered in time; every status counts.

    Numbers run within a customer's day and earlier days add their counts, so a customer with much of all
    orders is dealt over as many tasks as there are days. Orders of unknown time come first.
    """
    order = [F.asc_nulls_first("ordered_at"), F.asc("order_id")]
    return number_in_steps(df, ["customer_id"], F.to_date("ordered_at"), order, "customer_order_seq")


def assemble_orders(orders: DataFrame, items: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """D3: one row per order with at least one valid item; no returns count as 0.

    Items and returns collapse to order grain first, so all three sides meet on one order_id
    shuffle.
    """
    return (orders.join(rollup_items(items, products), "order_id")
            .join(rollup_returns(returns), "order_id", "left")
            .withColumns({"returned_items": F.coalesce("returned_items", F.lit(0)),
                          "refunded_value": F.coalesce("refunded_value", F.lit(0)),
                          "order_month": month_bucket("order_date")}))


def order_measures(df: DataFrame) -> DataFrame:
    """D5-D9 on assembled orders."""
    df = with_net_revenue(with_discount_value(df))
    df = with_is_late(with_lead_times(df))
    return with_status_flag(df, RETURNED, "is_rto")


# --- customer grain ---------------------------------------------------------------------------

def nth_event(n: int, column: str, seq: str = "customer_order_seq") -> Column:
    """Aggregate that picks a column of the n-th order."""
    return F.max(F.when(F.col(seq) == n, F.col(column)))


def entity_totals() -> dict[str, Column]:
    """Aggregates per customer."""
    return {"orders": F.count(F.lit(1)), "delivered_orders": F.count_if(is_status(DELIVERED)),
            "net_revenue": F.sum("net_revenue"), "last_order_date": F.max("order_date")}


def customer_history(fact: DataFrame) -> DataFrame:
    """D11-D13 in one pass over the numbered orders; partial aggregates absorb heavy customers."""
    firsts = {"first_order_date": "order_date", "cohort_month": "order_month", "first_promo_code": "promo_code",
              "first_order_status": "order_status", "first_payment_group": "payment_group",
              "first_order_late": "is_late"}
    aggregates = {name: nth_event(1, column) for name, column in firsts.items()}
    aggregates["second_order_date"] = nth_event(2, "order_date")
    aggregates.update(entity_totals())
    return fact.groupBy("customer_id").agg(*[expr.alias(name) for name, expr in aggregates.items()])


def with_code_flag(df: DataFrame, column: str, codes: Sequence[str], name: str) -> DataFrame:
    """True for one of the codes; NULL is false."""
    return df.withColumn(name, F.coalesce(F.col(column).isin(*codes), F.lit(False)))


def with_censored_repeat(df: DataFrame, days: int, as_of: dt.date, name: str = "repeat_within_90d") -> DataFrame:
    """Came back within ``days``; NULL where the extract ends too early to tell, or never ordered."""
    seen_long_enough = days_between("first_order_date", F.lit(as_of)) >= days
    came_back = F.coalesce(days_between("first_order_date", "second_order_date") <= days, F.lit(False))
    return df.withColumn(name, F.when(seen_long_enough, came_back))
