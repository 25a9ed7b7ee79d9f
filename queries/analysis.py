"""The analysis views."""

from __future__ import annotations

import datetime as dt
import functools
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.bindings import messy, star
from marketloom.operators import distinct
from marketloom.plans import views
from marketloom.session import stored
from queries import query
from queries import sql as s

R = star.RULES
_COD = "COUNT(*) FILTER (payment_group = 'COD')"
_RTO = s.pct("COUNT(*) FILTER (is_rto)", "COUNT(*) FILTER (shipped)")
_LATE = s.pct("COUNT(*) FILTER (is_late)", "COUNT(is_late)")
_REPEAT = s.pct("COUNT(*) FILTER (repeat_within_90d)", "COUNT(repeat_within_90d)")


def on_facts(name, covers, sql, numbered=False, *extra):
    """A view that needs only the fact."""
    def register(view):
        build = star.numbered_facts if numbered else star.facts
        query(name, covers, s.on_fact(sql, *extra))(lambda spark, folder: view(build(spark, folder)))
        return view

    return register


def on_dimension(name, covers, sql, *extra):
    """A view that needs only the dimension."""
    def register(view):
        query(name, covers, s.on_dim(sql, *extra))(lambda spark, folder: view(star.dimension(spark, folder)))
        return view

    return register


on_facts("headline_kpis", "E1", f"""
    SELECT COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS ordering_customers, {s.dbl('SUM(gmv)')} AS gmv,
           {s.dbl('SUM(net_revenue)')} AS net_revenue, {s.money_mean('SUM(gmv)', 'COUNT(*)')} AS avg_order_value,
           {s.pct(_COD, 'COUNT(*)')} AS cod_share_pct, {_RTO} AS rto_rate_pct, {_LATE} AS late_delivery_pct
    FROM fact""")(views.headline_kpis)



@query("customers_by_period", "E1 E11", s.on_fact("""
    SELECT 'month' AS grain, order_month AS period, COUNT(DISTINCT customer_id) AS customers FROM fact GROUP BY ALL
    UNION ALL SELECT 'quarter', CAST(DATE_TRUNC('quarter', order_month) AS DATE), COUNT(DISTINCT customer_id) FROM fact GROUP BY ALL
    UNION ALL SELECT 'all', NULL, COUNT(DISTINCT customer_id) FROM fact"""))
def _(spark, folder):
    """One pass makes bitmaps of months; all coarser periods add these up."""
    months = stored(distinct.bitmaps(star.facts(spark, folder), "customer_id", ["order_month"]), "months")
    quarters = months.withColumn("quarter", F.trunc("order_month", "quarter"))
    found = [("month", "order_month", distinct.counted(months, ["order_month"], "customers")),
             ("quarter", "quarter", distinct.counted(quarters, ["quarter"], "customers")),
             ("all", None, distinct.counted(months, [], "customers"))]
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(grain).alias("grain"), (F.col(c) if c else F.lit(None)).cast("date").alias("period"), "customers")
        for grain, c, df in found])


@query("accounts_by_courier", "E1", s.on_raw("""
    SELECT courier, COUNT(DISTINCT customer_id) AS accounts FROM raw_orders GROUP BY courier
    UNION ALL SELECT 'all', COUNT(DISTINCT customer_id) FROM raw_orders""", "raw_orders"))
def _(spark, folder):
    """Ids that are text, numbered by a dictionary that later rows extend."""
    orders = messy.extract(spark, folder, "orders").select("order_id", "customer_id", "courier")
    known = stored(distinct.dictionary(orders.where("courier < 'P'"), "customer_id", "number"), "known")
    known = stored(distinct.extended(known, orders, "customer_id", "number"), "known")
    maps = stored(distinct.bitmaps(distinct.numbered_by(orders, known, "customer_id", "order_id"), "number", ["courier"]), "maps")
    return distinct.counted(maps, ["courier"], "accounts").unionByName(
        distinct.counted(maps, [], "accounts").withColumn("courier", F.lit("all")))


MONTHLY = f"""monthly AS (
    SELECT order_month, COUNT(*) AS orders, COUNT(*) FILTER (order_status = 'Delivered') AS delivered_orders,
           SUM(gmv) AS gmv, SUM(net_revenue) AS net_revenue,
           COUNT(*) FILTER (customer_order_seq = 1) AS new_customers, {_COD} AS cod
    FROM fact GROUP BY order_month)"""
MONTHLY_SELECT = f"""
    SELECT order_month, orders, delivered_orders, {s.dbl('gmv')} AS gmv, {s.dbl('net_revenue')} AS net_revenue,
           new_customers, {s.money_mean('gmv', 'orders')} AS avg_order_value, {s.pct('cod', 'orders')} AS cod_share_pct,
           {s.money_pct('(net_revenue - LAG(net_revenue) OVER w)', 'LAG(net_revenue) OVER w')} AS net_revenue_mom_pct
    FROM monthly WINDOW w AS (ORDER BY order_month)"""
on_facts("monthly_kpis", "E2 D4", MONTHLY_SELECT, True, MONTHLY)(views.monthly_kpis)

on_facts("daily_orders", "E3", f"""
    SELECT order_date, COUNT(*) AS orders, {s.dbl('SUM(gmv)')} AS gmv FROM fact GROUP BY order_date""")(views.daily_orders)

MIX = f"""mix AS (
    SELECT order_month, payment_method, n AS orders, {s.pct('n', 'CAST(SUM(n) OVER (PARTITION BY order_month) AS BIGINT)')} AS share_pct
    FROM (SELECT order_month, payment_method, COUNT(*) AS n FROM fact GROUP BY ALL))"""
on_facts("payment_mix", "E4", "SELECT * FROM mix", False, MIX)(views.payment_mix)

DRIVERS = f"""drivers AS (
    SELECT payment_group, CASE customer_order_seq WHEN 1 THEN 'First order' ELSE 'Repeat order' END AS customer_type,
           CASE WHEN gmv > 4000000 THEN 'Above PKR 4,000,000' ELSE 'PKR 4,000,000 or less' END AS order_value_band,
           COUNT(*) AS shipped_orders, COUNT(*) FILTER (is_rto) AS rto_orders,
           {s.pct('COUNT(*) FILTER (is_rto)', 'COUNT(*)')} AS rto_rate_pct
    FROM fact WHERE shipped GROUP BY ALL)"""
on_facts("rto_drivers", "E5", "SELECT * FROM drivers", True, DRIVERS)(functools.partial(views.rto_drivers, rules=R))

on_facts("rto_by_tier", "E6", f"""
    SELECT {s.big('city_tier')} AS city_tier, payment_group, COUNT(*) AS shipped_orders,
           {s.pct('COUNT(*) FILTER (is_rto)', 'COUNT(*)')} AS rto_rate_pct
    FROM fact WHERE shipped GROUP BY ALL""")(views.rto_by_tier)

on_facts("rto_cost", "E7", f"""
    SELECT {s.big('YEAR(order_date)')} AS order_year, payment_group, COUNT(*) FILTER (is_rto) AS rto_orders,
           COUNT(*) FILTER (is_rto) * 420 AS est_rto_cost_pkr,
           {s.dbl('COALESCE(SUM(gmv) FILTER (is_rto), 0)')} AS refused_gmv_pkr
    FROM fact GROUP BY ALL""")(functools.partial(views.rto_cost, rules=R))

CARD = f"""card AS (
    SELECT courier, {s.big('city_tier')} AS city_tier, COUNT(*) AS orders,
           {s.mean2('SUM(delivery_days)', 'COUNT(delivery_days)')} AS avg_delivery_days,
           {_LATE} AS late_rate_pct, {_RTO} AS rto_rate_pct
    FROM fact GROUP BY ALL)"""
on_facts("courier_scorecard", "E8 D7", "SELECT * FROM card", False, CARD)(views.courier_scorecard)

DELIVERY = f"""delivery AS (
    SELECT order_month, {s.pct("COUNT(*) FILTER (courier = 'Courier A')", 'COUNT(*)')} AS courier_a_share_pct,
           {_LATE} AS late_rate_pct, {_RTO} AS rto_rate_pct
    FROM fact GROUP BY order_month)"""
on_facts("delivery_monthly", "E9", "SELECT * FROM delivery", False, DELIVERY)(
    functools.partial(views.delivery_monthly, rules=R))

EXPERIENCE = f"""experience AS (
    SELECT CASE first_order_status WHEN 'Returned to Origin' THEN 'Refused at door (RTO)' WHEN 'Cancelled' THEN 'Cancelled'
                WHEN 'Delivered' THEN CASE first_order_late WHEN TRUE THEN 'Delivered late' WHEN FALSE THEN 'Delivered on time' END
           END AS first_order_experience, COUNT(*) AS customers, {_REPEAT} AS repeat_90d_pct
    FROM dim WHERE repeat_within_90d IS NOT NULL GROUP BY 1 HAVING first_order_experience IS NOT NULL)"""
on_dimension("first_order_experience", "E10 D16", "SELECT * FROM experience", EXPERIENCE)(views.first_order_experience)

RETENTION = f"""retention AS (
    SELECT cohort_month, months_since_first, cohort_size, COUNT(DISTINCT customer_id) AS active_customers,
           {s.pct('COUNT(DISTINCT customer_id)', 'cohort_size')} AS retention_pct
    FROM (SELECT d.customer_id, d.cohort_month, z.cohort_size,
                 {s.big("DATE_DIFF('month', d.cohort_month, f.order_month)")} AS months_since_first
          FROM dim d JOIN fact f USING (customer_id)
          JOIN (SELECT cohort_month, COUNT(*) AS cohort_size FROM dim GROUP BY cohort_month) z USING (cohort_month))
    WHERE months_since_first BETWEEN 0 AND 12 GROUP BY cohort_month, months_since_first, cohort_size)"""


def retention(spark, folder):
    activity = stored(star.facts(spark, folder).select("customer_id", "order_month"), "activity")
    return views.cohort_retention(activity, star.table(spark, folder, "customers"), R)


query("cohort_retention", "E11", s.on_dim("SELECT * FROM retention", RETENTION))(retention)


@query("cohort_curve", "E23", s.on_dim(
    "SELECT * FROM retention WHERE cohort_month = DATE '1995-01-01' ORDER BY months_since_first", RETENTION))
def _(spark, folder):
    return views.cohort_curve(retention(spark, folder), dt.date(1995, 1, 1))


QUALITY = f"""quality AS (
    SELECT CASE WHEN acquired_in_mega_sale THEN 'First order used a mega-sale code' ELSE 'First order at any other time' END
               AS acquisition, COUNT(*) AS customers, {_REPEAT} AS repeat_90d_pct,
           {s.mean2('SUM(orders)', 'COUNT(*)')} AS avg_orders, {s.money_mean('SUM(net_revenue)', 'COUNT(*)')} AS avg_net_revenue
    FROM dim WHERE first_order_date IS NOT NULL GROUP BY 1)"""
on_dimension("acquisition_quality", "E12 D15", "SELECT * FROM quality", QUALITY)(views.acquisition_quality)

CHANNELS = f"""channels AS (
    SELECT acquisition_channel, COUNT(*) AS customers, {_REPEAT} AS repeat_90d_pct,
           {s.money_mean('SUM(net_revenue)', 'COUNT(*)')} AS avg_net_revenue
    FROM dim WHERE first_order_date IS NOT NULL GROUP BY 1)"""
on_dimension("channel_quality", "E13", "SELECT * FROM channels", CHANNELS)(views.channel_quality)

on_dimension("repeat_by_late", "E21", f"""
    SELECT first_order_late, COUNT(*) AS customers, {_REPEAT} AS repeat_90d_pct
    FROM dim WHERE repeat_within_90d IS NOT NULL AND first_order_late IS NOT NULL GROUP BY 1""")(views.repeat_by_late)

_REASON_COUNTS = ", ".join(f"COUNT(*) FILTER (return_reason = {s.literal(text)}) AS {name}"
                           for name, text in R.return_reasons.items())
BY_CATEGORY = f"""by_category AS (
    SELECT category, items_delivered, COALESCE(items_returned, 0) AS items_returned,
           {s.pct('COALESCE(items_returned, 0)', 'items_delivered')} AS return_rate_pct,
           {', '.join(R.return_reasons)}, {s.dbl('refunded_value')} AS refunded_value
    FROM (SELECT p.category, COUNT(*) AS items_delivered FROM order_items JOIN products p USING (product_id)
          JOIN fact f USING (order_id) WHERE f.order_status = 'Delivered' GROUP BY 1)
    LEFT JOIN (SELECT p.category, COUNT(*) AS items_returned, {_REASON_COUNTS}, SUM(refund_amount) AS refunded_value
               FROM returns JOIN order_items i USING (order_item_id) JOIN products p USING (product_id) GROUP BY 1)
    USING (category))"""


def product_returns(spark, folder):
    t = functools.partial(star.table, spark, folder)
    return views.product_returns(t("order_items"), star.facts(spark, folder), t("returns"), R)


def by_category(spark, folder):
    return views.returns_by_category(product_returns(spark, folder), star.table(spark, folder, "products"), R)


query("returns_by_category", "E14", s.on_fact("SELECT * FROM by_category", BY_CATEGORY))(by_category)

SELLER_RETURNS = (*s.ctes(star.TABLES, ["sellers"]), """seller_counts AS (
    SELECT p.seller_id, p.category, COUNT(*) AS n, COUNT(r.return_id) AS back,
           COUNT(*) FILTER (r.return_reason = 'Not as described') AS misdescribed
    FROM order_items i JOIN products p USING (product_id)
    JOIN fact f ON f.order_id = i.order_id AND f.order_status = 'Delivered'
    LEFT JOIN returns r USING (order_item_id) GROUP BY ALL)""", f"""seller_returns AS (
    SELECT seller_id, seller_name, category, n AS items_delivered, back AS items_returned,
           misdescribed AS not_as_described_returns, {s.pct('back', 'n')} AS return_rate_pct,
           {s.pct('all_back', 'all_n')} AS category_return_rate_pct, ROUND(z, 2) AS z_score,
           COALESCE(n >= 10 AND z > 2, FALSE) AS flagged
    FROM (SELECT *, (CAST(back AS DOUBLE) / n - base) / NULLIF(SQRT(base * (1 - base) / n), 0) AS z
          FROM (SELECT *, CAST(all_back AS DOUBLE) / all_n AS base
                FROM (SELECT *, CAST(SUM(back) OVER c AS BIGINT) AS all_back, CAST(SUM(n) OVER c AS BIGINT) AS all_n
                      FROM seller_counts WINDOW c AS (PARTITION BY category))))
    JOIN sellers USING (seller_id))""")


def seller_returns(spark, folder):
    return views.seller_returns(product_returns(spark, folder), star.table(spark, folder, "products"),
                                star.table(spark, folder, "sellers"), R)


query("seller_returns", "E15 G7", s.on_fact("SELECT * FROM seller_returns", *SELLER_RETURNS))(seller_returns)


@query("flagged_sellers", "E22", s.on_fact(
    "SELECT * FROM seller_returns WHERE flagged ORDER BY z_score DESC, seller_id, category", *SELLER_RETURNS))
def _(spark, folder):
    return views.flagged(seller_returns(spark, folder))


RFM = (f"""rfm_base AS (
    SELECT customer_id, {s.big(f'{s.AS_OF} - MAX(order_date)')} AS recency_days,
           COUNT(*) FILTER (order_status = 'Delivered') AS frequency, SUM(net_revenue) AS monetary
    FROM fact GROUP BY 1 HAVING frequency > 0)""", """rfm_scored AS (
    SELECT *, NTILE(5) OVER (ORDER BY recency_days DESC, customer_id) AS r_score,
           NTILE(5) OVER (ORDER BY frequency, monetary, customer_id) AS f_score,
           NTILE(5) OVER (ORDER BY monetary, customer_id) AS m_score FROM rfm_base)""", """rfm AS (
    SELECT *, CASE WHEN r_score > 3 AND f_score > 3 THEN 'Champions' WHEN r_score > 2 AND f_score > 2 THEN 'Loyal'
                   WHEN r_score > 3 AND f_score < 3 THEN 'New or promising' WHEN r_score < 3 AND f_score > 2 THEN 'At risk'
                   WHEN r_score < 3 AND f_score < 3 THEN 'Lost' ELSE 'Needs attention' END AS segment FROM rfm_scored)""")
RFM_SUMMARY = (*RFM, f"""rfm_summary AS (
    SELECT segment, COUNT(*) AS customers, {s.money_mean('SUM(recency_days)', 'COUNT(*)')} AS avg_recency_days,
           {s.mean2('SUM(frequency)', 'COUNT(*)')} AS avg_delivered_orders, {s.dbl('SUM(monetary)')} AS net_revenue,
           {s.money_pct('SUM(monetary)', '(SUM(SUM(monetary)) OVER ())')} AS revenue_share_pct
    FROM rfm GROUP BY segment)""")
on_facts("rfm", "E16", "SELECT " + s.typed(
    "customer_id recency_days frequency monetary:d r_score:b f_score:b m_score:b segment") + " FROM rfm", False, *RFM)(
    functools.partial(views.rfm, rules=R))


def rfm_summary(fact):
    return views.rfm_summary(views.rfm(fact, R))


on_facts("rfm_summary", "E17", "SELECT * FROM rfm_summary", False, *RFM_SUMMARY)(rfm_summary)

GROWTH = f"""growth AS (
    SELECT {s.big('YEAR(order_date)')} AS order_year, {s.big('(MONTH(order_date) + 5) // 6')} AS half, {s.big('city_tier')} AS city_tier,
           COUNT(*) AS orders, {s.pct('COUNT(*)', 'CAST(SUM(COUNT(*)) OVER (PARTITION BY YEAR(order_date), (MONTH(order_date) + 5) // 6) AS BIGINT)')} AS order_share_pct,
           {s.pct(_COD, 'COUNT(*)')} AS cod_share_pct
    FROM fact WHERE city_tier IS NOT NULL GROUP BY YEAR(order_date), (MONTH(order_date) + 5) // 6, city_tier)"""
on_facts("city_tier_growth", "E19", "SELECT * FROM growth", False, GROWTH)(views.city_tier_growth)

on_facts("worst_groups", "E20", f"""
    SELECT city, COUNT(*) AS delivered_orders, {_LATE} AS late_rate_pct FROM fact WHERE order_status = 'Delivered'
    GROUP BY city HAVING COUNT(*) >= 50 ORDER BY late_rate_pct DESC NULLS LAST, city LIMIT 5""")(
    functools.partial(views.worst_groups, key="city", min_n=50))

on_facts("monthly_net_revenue", "E21", f"""
    SELECT order_month, {s.dbl('SUM(net_revenue)')} AS net_revenue FROM fact GROUP BY order_month""")(views.monthly_net_revenue)


on_facts("courier_scorecard_ordered", "E24", "SELECT * FROM card ORDER BY courier, city_tier NULLS FIRST", False, CARD)(
    lambda fact: views.ordered(views.courier_scorecard(fact), ["courier", "city_tier"]))
