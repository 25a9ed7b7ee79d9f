"""The nineteen analysis views and the smaller questions asked of them.

Every view is an aggregate whose map-side part shrinks the fact to groups before anything is
shuffled. Windows run only over such results (months, labels, half-years, segments).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import stats
from marketloom.functions.dates import days_between, half_of_year, month_number
from marketloom.functions.rates import percent, rounded_mean, share_of
from marketloom.operators.modelling import DELIVERED, SHIPPED, is_status
from marketloom.operators.ranking import ntile_scores
from marketloom.operators.skew import spread_join
from marketloom.rules import DEFAULT_RULES, Rules
from marketloom.session import stored

#: Views with a row for each customer or seller; all others are small.
PER_CUSTOMER = ("rfm", "seller_returns")


# --- shared measures --------------------------------------------------------------------------

def _rows() -> Column:
    return F.count(F.lit(1))


def _cod() -> Column:
    return F.col("payment_group") == "COD"


def _shipped() -> Column:
    return F.col("order_status").isin(*SHIPPED)


def cod_share() -> Column:
    return percent(F.count_if(_cod()), _rows()).alias("cod_share_pct")


def rto_rate() -> Column:
    return share_of(F.col("is_rto"), _shipped())


def late_rate() -> Column:
    return share_of(F.col("is_late"), F.col("is_late").isNotNull())


def repeat_rate() -> Column:
    repeat = F.col("repeat_within_90d")
    return share_of(repeat, repeat.isNotNull()).alias("repeat_90d_pct")


def mean_net_revenue() -> Column:
    return rounded_mean(F.sum("net_revenue"), F.count("net_revenue"), 0).alias("avg_net_revenue")


# --- sales ------------------------------------------------------------------------------------

def headline_kpis(fact: DataFrame) -> DataFrame:
    """One row."""
    return fact.agg(_rows().alias("orders"), F.count_distinct("customer_id").alias("ordering_customers"),
                    F.sum("gmv").alias("gmv"), F.sum("net_revenue").alias("net_revenue"),
                    rounded_mean(F.sum("gmv"), _rows(), 0).alias("avg_order_value"), cod_share(),
                    rto_rate().alias("rto_rate_pct"), late_rate().alias("late_delivery_pct"))


def monthly_kpis(fact: DataFrame) -> DataFrame:
    """Change is against the previous month present, so the first row has none."""
    monthly = fact.groupBy("order_month").agg(
        _rows().alias("orders"), F.count_if(is_status(DELIVERED)).alias("delivered_orders"),
        F.sum("gmv").alias("gmv"), F.sum("net_revenue").alias("net_revenue"),
        F.count_if(F.col("customer_order_seq") == 1).alias("new_customers"),
        rounded_mean(F.sum("gmv"), _rows(), 0).alias("avg_order_value"), cod_share())
    before = F.lag("net_revenue").over(Window.orderBy("order_month"))
    return monthly.withColumn("net_revenue_mom_pct", percent(F.col("net_revenue") - before, before))


def daily_orders(fact: DataFrame) -> DataFrame:
    """Days without orders have no row."""
    return fact.groupBy("order_date").agg(_rows().alias("orders"), F.sum("gmv").alias("gmv"))


def share_within(fact: DataFrame, period: str, column: str) -> DataFrame:
    """Orders per label and their share of the period."""
    counted = fact.groupBy(period, column).agg(_rows().alias("orders"))
    return counted.withColumn("share_pct", percent("orders", F.sum("orders").over(Window.partitionBy(period))))


def payment_mix(fact: DataFrame) -> DataFrame:
    return share_within(fact, "order_month", "payment_method")


def city_tier_growth(fact: DataFrame) -> DataFrame:
    """Half-years by tier; orders without a tier are left out before shares are taken."""
    keyed = fact.where(F.col("city_tier").isNotNull()).groupBy(
        F.year("order_date").alias("order_year"), half_of_year("order_date").alias("half"), "city_tier")
    counted = keyed.agg(_rows().alias("orders"), cod_share())
    whole = F.sum("orders").over(Window.partitionBy("order_year", "half"))
    return counted.select("order_year", "half", "city_tier", "orders",
                          percent("orders", whole).alias("order_share_pct"), "cod_share_pct")


# --- refused parcels --------------------------------------------------------------------------

def rto_by(fact: DataFrame, keys: Sequence[Column | str], counted: bool = True) -> DataFrame:
    """Refused share of shipped orders by any keys; NULL keys form a group."""
    refused = F.count_if(F.col("is_rto"))
    measures = [_rows().alias("shipped_orders")] + ([refused.alias("rto_orders")] if counted else [])
    return fact.where(_shipped()).groupBy(*keys).agg(*measures, percent(refused, _rows()).alias("rto_rate_pct"))


def rto_drivers(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """E5: by payment, first or repeat order, and order value."""
    limit = f"{rules.value_band:,f}"
    customer_type = F.when(F.col("customer_order_seq") == 1, "First order").otherwise("Repeat order")
    band = F.when(F.col("gmv") > F.lit(rules.value_band), f"Above PKR {limit}").otherwise(f"PKR {limit} or less")
    return rto_by(fact, ["payment_group", customer_type.alias("customer_type"), band.alias("order_value_band")])


def rto_by_tier(fact: DataFrame) -> DataFrame:
    return rto_by(fact, ["city_tier", "payment_group"], counted=False)


def rto_cost(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Handling cost and refused value."""
    refused = F.count_if(F.col("is_rto"))
    refused_gmv = F.sum(F.when(F.col("is_rto"), F.col("gmv")).otherwise(F.lit(0)))
    return fact.groupBy(F.year("order_date").alias("order_year"), "payment_group").agg(
        refused.alias("rto_orders"), (refused * rules.rto_unit_cost).alias("est_rto_cost_pkr"),
        refused_gmv.alias("refused_gmv_pkr"))


# --- delivery ---------------------------------------------------------------------------------

def courier_scorecard(fact: DataFrame) -> DataFrame:
    """E8."""
    mean_days = rounded_mean(F.sum("delivery_days"), F.count("delivery_days"))
    return fact.groupBy("courier", "city_tier").agg(
        _rows().alias("orders"), mean_days.alias("avg_delivery_days"), late_rate().alias("late_rate_pct"),
        rto_rate().alias("rto_rate_pct"))


def delivery_monthly(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One courier's share beside overall lateness and refusals."""
    name = f"{rules.watched_courier.lower().replace(' ', '_')}_share_pct"
    watched = F.count_if(F.col("courier") == rules.watched_courier)
    return fact.groupBy("order_month").agg(percent(watched, _rows()).alias(name), late_rate().alias("late_rate_pct"),
                                           rto_rate().alias("rto_rate_pct"))


def worst_groups(fact: DataFrame, key: str, min_n: int = 500, n: int = 5) -> DataFrame:
    """Groups with the worst late rate among those with enough delivered orders."""
    delivered = fact.where(is_status(DELIVERED)).groupBy(key).agg(
        _rows().alias("delivered_orders"), late_rate().alias("late_rate_pct"))
    return (delivered.where(F.col("delivered_orders") >= min_n)
            .orderBy(F.desc_nulls_last("late_rate_pct"), F.asc(key)).limit(n))


def monthly_net_revenue(fact: DataFrame) -> DataFrame:
    """E21a."""
    return fact.groupBy("order_month").agg(F.sum("net_revenue").alias("net_revenue"))


# --- customers --------------------------------------------------------------------------------

def first_order_experience(dim: DataFrame) -> DataFrame:
    """Repeat rate by how the first order went; unlabelled and too recent customers are left out."""
    status, late = F.col("first_order_status"), F.col("first_order_late")
    label = (F.when(status == "Returned to Origin", "Refused at door (RTO)")
             .when(status == "Cancelled", "Cancelled")
             .when((status == DELIVERED) & late, "Delivered late")
             .when((status == DELIVERED) & ~late, "Delivered on time"))
    known = dim.where(F.col("repeat_within_90d").isNotNull() & label.isNotNull())
    return known.groupBy(label.alias("first_order_experience")).agg(_rows().alias("customers"), repeat_rate())


def repeat_by_late(dim: DataFrame) -> DataFrame:
    """Repeat rate by whether the first order was late."""
    known = dim.where(F.col("repeat_within_90d").isNotNull() & F.col("first_order_late").isNotNull())
    return known.groupBy("first_order_late").agg(_rows().alias("customers"), repeat_rate())


#: Months in one word of a mask, leaving out the sign.
_MASK_BITS = 63


def activity_masks(fact: DataFrame, first: int, months: int) -> DataFrame:
    """``customer_id``, ``cohort`` (months after ``first`` of the first order) and ``active``, the customer's
    months of activity as bits of an array of words.

    A customer whose first order has no known time has no cohort. One aggregate: words are OR-ed in the map tasks.
    """
    at = F.when(F.col("order_month").isNotNull(), month_number("order_month") - first)
    words = [F.bit_or(F.when(F.floor(at / _MASK_BITS) == w, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(_MASK_BITS)))))
             for w in range(-(-months // _MASK_BITS))]
    masks = fact.groupBy("customer_id").agg(F.min(at).alias("cohort"), F.count_if(F.col("order_month").isNull()).alias("_unknown"),
                                            *[w.alias(f"_w{i}") for i, w in enumerate(words)])
    return masks.where("_unknown = 0").select("customer_id", "cohort", F.array(*[f"_w{i}" for i in range(len(words))]).alias("active"))


def cohort_retention(fact: DataFrame, people: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Customers active n months after their first order, any status counting as activity.

    ``fact`` needs customer_id and order_month alone, ``people`` customer_id. Orders collapse to a bit mask
    per customer, whose bits are counted per cohort; no row per order or month meets another table.
    """
    ends = fact.agg(F.min("order_month").alias("low"), F.max("order_month").alias("high")).first()
    if ends.low is None:
        first = months = 0
    else:
        first = ends.low.year * 12 + ends.low.month - 1
        months = ends.high.year * 12 + ends.high.month - first
    masks = activity_masks(fact, first, months).join(people.select("customer_id"), "customer_id", "left_semi")

    def active(offset: int) -> Column:
        at = F.col("cohort") + offset
        word = F.get("active", F.floor(at / _MASK_BITS).cast("int"))
        return F.coalesce(F.call_function("getbit", word, F.pmod(at, F.lit(_MASK_BITS))), F.lit(0))

    offsets = range(rules.max_cohort_offset + 1)
    sizes = masks.groupBy("cohort").agg(_rows().alias("cohort_size"), *[F.sum(active(n)).alias(f"_n{n}") for n in offsets])
    cells = F.array(*[F.struct(F.lit(n).alias("months_since_first"), F.col(f"_n{n}").alias("active_customers")) for n in offsets])
    month = F.make_date(F.floor((F.col("cohort") + first) / 12).cast("int"), F.pmod(F.col("cohort") + first, F.lit(12)) + 1, F.lit(1))
    return (sizes.select(month.alias("cohort_month"), "cohort_size", F.inline(cells)).where("active_customers > 0")
            .select("cohort_month", "months_since_first", "cohort_size", "active_customers",
                    percent("active_customers", "cohort_size").alias("retention_pct")))


def cohort_curve(retention: DataFrame, month) -> DataFrame:
    """One cohort in order of months."""
    return retention.where(F.col("cohort_month") == F.lit(month)).orderBy("months_since_first")


def acquisition_quality(dim: DataFrame) -> DataFrame:
    """E12."""
    label = F.when(F.col("acquired_in_mega_sale"), "First order used a mega-sale code").otherwise(
        "First order at any other time")
    return dim.where(F.col("first_order_date").isNotNull()).groupBy(label.alias("acquisition")).agg(
        _rows().alias("customers"), repeat_rate(), rounded_mean(F.sum("orders"), _rows()).alias("avg_orders"),
        mean_net_revenue())


def channel_quality(dim: DataFrame) -> DataFrame:
    """E13."""
    return dim.where(F.col("first_order_date").isNotNull()).groupBy("acquisition_channel").agg(
        _rows().alias("customers"), repeat_rate(), mean_net_revenue())


def rfm_base(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Recency of any order, frequency of delivered ones and money, for customers with a delivery."""
    return fact.groupBy("customer_id").agg(
        days_between(F.max("order_date"), F.lit(rules.as_of)).alias("recency_days"),
        F.count_if(is_status(DELIVERED)).alias("frequency"),
        F.sum("net_revenue").alias("monetary")).where("frequency > 0")


def rfm_segment() -> Column:
    r, f = F.col("r_score"), F.col("f_score")
    return (F.when((r >= 4) & (f >= 4), "Champions").when((r >= 3) & (f >= 3), "Loyal")
            .when((r >= 4) & (f <= 2), "New or promising").when((r <= 2) & (f >= 3), "At risk")
            .when((r <= 2) & (f <= 2), "Lost").otherwise("Needs attention"))


def rfm(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Equal-size scores over all customers, ties broken by customer id."""
    scores = {"r_score": ["-recency_days"], "f_score": ["frequency", "monetary"], "m_score": ["monetary"]}
    scored = ntile_scores(rfm_base(fact, rules), "customer_id", scores, rules.rfm_buckets)
    return scored.withColumn("segment", rfm_segment())


def rfm_summary(rfm_view: DataFrame) -> DataFrame:
    """The revenue share is over the six segments."""
    grouped = rfm_view.groupBy("segment").agg(
        _rows().alias("customers"), rounded_mean(F.sum("recency_days"), _rows(), 0).alias("avg_recency_days"),
        rounded_mean(F.sum("frequency"), _rows()).alias("avg_delivered_orders"), F.sum("monetary").alias("net_revenue"))
    whole = F.sum("net_revenue").over(Window.partitionBy())
    return grouped.withColumn("revenue_share_pct", percent("net_revenue", whole))


# --- returns ----------------------------------------------------------------------------------

def product_returns(items: DataFrame, fact: DataFrame, returns: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """What E14 and E15 count, per product, from one pass over the items.

    Returns collapse to items and the fact has one row per order, so no item repeats, and a best seller
    leaves as one row. ``items_delivered`` counts items of delivered orders; ``sold_back`` and the columns
    after it only their returns, all others the returns of any order. An item returned more than once
    counts with each of its returns in ``sold_rows``.
    """
    reasons = {name: F.count_if(F.col("return_reason") == reason) for name, reason in rules.return_reasons.items()}
    misdescribed = F.count_if(F.col("return_reason") == rules.misdescribed_reason)
    back = returns.select("order_item_id", "return_reason", "refund_amount").groupBy("order_item_id").agg(
        _rows().alias("items_returned"), *[n.alias(name) for name, n in reasons.items()],
        F.sum("refund_amount").alias("refunded_value"), misdescribed.alias("misdescribed"))
    delivered = fact.where(is_status(DELIVERED)).select("order_id", F.lit(True).alias("delivered"))
    joined = (items.select("order_item_id", "order_id", "product_id").join(delivered, "order_id", "left")
              .join(back, "order_item_id", "left"))
    on_delivered = lambda c: F.sum(F.when(F.col("delivered"), c))
    returned = F.coalesce("items_returned", F.lit(0))
    return joined.groupBy("product_id").agg(
        F.count("delivered").alias("items_delivered"),
        *[F.sum(c).alias(c) for c in ("items_returned", *reasons, "refunded_value")],
        on_delivered(F.greatest(returned, F.lit(1))).alias("sold_rows"), on_delivered(returned).alias("sold_back"),
        on_delivered(F.coalesce("misdescribed", F.lit(0))).alias("sold_misdescribed"))


def returns_by_category(per_product: DataFrame, products: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Returns of any order against delivered items; categories without returns stay, those without
    delivered items do not."""
    reasons = list(rules.return_reasons)
    sums = ["items_delivered", "items_returned", *reasons, "refunded_value"]
    counted = (per_product.join(products.select("product_id", "category"), "product_id").groupBy("category")
               .agg(*[F.sum(c).alias(c) for c in sums]).where("items_delivered > 0"))
    # Items without a category are counted, but no return is ascribed to a missing category.
    known = {c: F.when(F.col("category").isNotNull(), F.col(c)) for c in ("items_returned", *reasons, "refunded_value")}
    back = F.coalesce("items_returned", F.lit(0))
    return counted.withColumns(known).select(
        "category", "items_delivered", back.alias("items_returned"),
        percent(back, "items_delivered").alias("return_rate_pct"), *reasons, "refunded_value")


def seller_returns(per_product: DataFrame, products: DataFrame, sellers: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """A seller's return rate in a category against the category's own rate."""
    measures = {"items_delivered": "sold_rows", "items_returned": "sold_back", "not_as_described_returns": "sold_misdescribed"}
    # Read twice below; one row per seller and category is kept.
    by_seller = stored(per_product.where("sold_rows > 0").join(products.select("product_id", "seller_id", "category"), "product_id")
                       .groupBy("seller_id", "category").agg(*[F.sum(c).alias(name) for name, c in measures.items()]),
                       "seller_returns")
    by_category = by_seller.groupBy("category").agg(
        F.sum("items_returned").alias("_returned"), F.sum("items_delivered").alias("_delivered"))

    base = F.col("_returned").cast("double") / F.col("_delivered")
    z = stats.binomial_z("items_returned", "items_delivered", base)
    flagged = F.coalesce((F.col("items_delivered") >= rules.seller_min_items) & (z > rules.seller_z), F.lit(False))
    return (spread_join(by_seller, by_category, "category", "seller_id").join(sellers.select("seller_id", "seller_name"), "seller_id")
            .select("seller_id", "seller_name", "category", *measures,
                    percent("items_returned", "items_delivered").alias("return_rate_pct"),
                    percent("_returned", "_delivered").alias("category_return_rate_pct"),
                    F.round(z, 2).cast("decimal(18,2)").alias("z_score"), flagged.alias("flagged")))


def flagged(seller_returns_view: DataFrame) -> DataFrame:
    """The shortlist, worst first."""
    return seller_returns_view.where("flagged").orderBy(F.desc_nulls_last("z_score"), "seller_id", "category")


# --- experiment -------------------------------------------------------------------------------

def ab_test(sessions: DataFrame) -> DataFrame:
    """Revenue is NULL where no session had a value."""
    return sessions.groupBy("experiment_group", "device_type", "is_bot").agg(
        _rows().alias("sessions"), F.sum("completed_order").alias("orders"), F.sum("order_value").alias("revenue"))


def ordered(view: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A view in reading order, NULLs first."""
    return view.orderBy(*[F.asc_nulls_first(k) for k in keys])


def build(clean: Mapping[str, DataFrame], fact: DataFrame, dim: DataFrame,
          rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """All nineteen views by name."""
    items, products, returns = clean["order_items"], clean["products"], clean["returns"]
    rfm_view = rfm(fact, rules)
    per_product = stored(product_returns(items, fact, returns, rules), "product_returns")
    return {
        "headline_kpis": headline_kpis(fact), "monthly_kpis": monthly_kpis(fact), "daily_orders": daily_orders(fact),
        "payment_mix": payment_mix(fact), "rto_drivers": rto_drivers(fact, rules), "rto_by_tier": rto_by_tier(fact),
        "rto_cost": rto_cost(fact, rules), "courier_scorecard": courier_scorecard(fact),
        "delivery_monthly": delivery_monthly(fact, rules), "first_order_experience": first_order_experience(dim),
        "cohort_retention": cohort_retention(fact, dim, rules), "acquisition_quality": acquisition_quality(dim),
        "channel_quality": channel_quality(dim),
        "returns_by_category": returns_by_category(per_product, products, rules),
        "seller_returns": seller_returns(per_product, products, clean["sellers"], rules),
        "rfm": rfm_view, "rfm_summary": rfm_summary(rfm_view), "ab_test": ab_test(clean["checkout_sessions"]),
        "city_tier_growth": city_tier_growth(fact),
    }
