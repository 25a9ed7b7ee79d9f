"""Report tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketloom import lookups
from marketloom.bindings import star
from marketloom.operators import reshape as r
from marketloom.plans import reports, views
from queries import analysis as a
from queries import query
from queries import sql as s
from queries.experiment import rounded

DAILY = """daily AS (
    SELECT order_date, COUNT(*) AS orders, CAST(SUM(gmv) AS DOUBLE) AS gmv FROM fact GROUP BY order_date)"""
SMOOTHED = (DAILY, """smoothed AS (
    SELECT *, CASE WHEN COUNT(*) OVER w = 7 THEN CAST(SUM(orders) OVER w AS DOUBLE) / 7 END AS avg_7d
    FROM daily WINDOW w AS (ORDER BY order_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))""")
# A calendar in the years of the given orders.
SEASONS = (("Spring sale", "1996-03-01", "1996-03-29"), ("Spring sale", "1999-03-01", "1999-03-29"),
           ("Founders day", "1997-06-17", "1997-06-17"), ("Winter sale", "2000-11-11", "2000-12-12"))
CALENDAR = "calendar(event, starts, ends) AS (VALUES " + ", ".join(
    f"('{e}', DATE '{x}', DATE '{y}')" for e, x, y in SEASONS) + ")"
COHORTS_UNTIL = dt.date(2000, 12, 1)


def daily(spark, folder):
    return views.daily_orders(star.facts(spark, folder))


def smoothed(spark, folder):
    return r.centred_mean(daily(spark, folder), "order_date", "orders", "avg_7d")


@query("growth_ratio", "H1", s.on_fact("""
    SELECT MIN(order_month) AS first_period, MAX(order_month) AS last_period,
           ROUND(CAST(ARG_MAX(net_revenue, order_month) AS DOUBLE) / CAST(ARG_MIN(net_revenue, order_month) AS DOUBLE), 6) AS growth
    FROM monthly""", a.MONTHLY))
def _(spark, folder):
    monthly = views.monthly_net_revenue(star.facts(spark, folder))
    return rounded(r.growth_ratio(monthly, "order_month", "net_revenue"), "growth")


query("rolling_mean_7", "H2", s.on_fact(
    "SELECT order_date, orders, gmv, ROUND(avg_7d, 6) AS avg_7d FROM smoothed", *SMOOTHED))(
    lambda spark, folder: rounded(smoothed(spark, folder), "avg_7d"))

query("busiest_day", "H3", s.on_fact("SELECT * FROM daily ORDER BY orders DESC, order_date LIMIT 1", DAILY))(
    lambda spark, folder: r.peak_row(daily(spark, folder), "orders", "order_date"))

query("latest_month", "H3", s.on_fact(
    "SELECT * FROM delivery ORDER BY late_rate_pct DESC NULLS LAST, order_month LIMIT 1", a.DELIVERY))(
    lambda spark, folder: r.peak_row(views.delivery_monthly(star.facts(spark, folder), star.RULES), "late_rate_pct", "order_month"))

query("worst_courier_and_tier", "H3", s.on_fact(
    "SELECT * FROM card WHERE city_tier IS NOT NULL ORDER BY late_rate_pct DESC NULLS LAST, courier, city_tier LIMIT 1", a.CARD))(
    lambda spark, folder: reports.worst_courier_and_tier(views.courier_scorecard(star.facts(spark, folder))))

query("peak_to_median", "H4", s.on_fact(
    "SELECT ROUND(MAX(orders) / MEDIAN(avg_7d), 6) AS peak_to_median FROM smoothed", *SMOOTHED))(
    lambda spark, folder: rounded(r.peak_to_median(smoothed(spark, folder), "orders", "avg_7d"), "peak_to_median"))

query("calendar_join", "H5", s.on_fact("""
    SELECT d.order_date, d.orders, c.event FROM daily d
    LEFT JOIN calendar c ON d.order_date BETWEEN c.starts AND c.ends""", DAILY, CALENDAR))(
    lambda spark, folder: r.annotate_calendar(daily(spark, folder), "order_date", lookups.calendar(spark, SEASONS))
    .select("order_date", "orders", "event"))

_METHODS = ("Cash on Delivery", "Mobile Wallet", "Card")
query("pivot_mix", "H6", s.on_fact("SELECT order_month, " + ", ".join(
    f"CAST(COALESCE(MAX(share_pct) FILTER (payment_method = '{m}'), 0) AS DOUBLE) AS \"{m}\"" for m in _METHODS)
    + " FROM mix GROUP BY order_month", a.MIX))(
    lambda spark, folder: reports.payment_mix_wide(views.payment_mix(star.facts(spark, folder))))

query("courier_matrix", "H7", s.on_fact("SELECT courier, " + ", ".join(
    f"MAX(late_rate_pct) FILTER (city_tier = {t}) AS \"Tier {t} cities\"" for t in (1, 2, 3))
    + " FROM card WHERE city_tier IS NOT NULL GROUP BY courier", a.CARD))(
    lambda spark, folder: reports.courier_matrix(views.courier_scorecard(star.facts(spark, folder))))

MATRIX = "matrix AS (SELECT STRFTIME(cohort_month, '%Y-%m') AS cohort_month, " + ", ".join(
    f"MAX(retention_pct) FILTER (months_since_first = {o}) AS \"{o}\"" for o in range(1, 7)) + f"""
    FROM retention WHERE cohort_month <= DATE '{COHORTS_UNTIL}' AND months_since_first BETWEEN 1 AND 6 GROUP BY 1)"""


def matrix(spark, folder):
    return reports.cohort_matrix(a.retention(spark, folder), COHORTS_UNTIL)


query("cohort_matrix", "H8", s.on_dim("SELECT * FROM matrix", a.RETENTION, MATRIX))(matrix)

query("mean_month1", "H9", s.on_dim("""
    SELECT ROUND(AVG("1") FILTER (cohort_month LIKE '%-11'), 6) AS in_month,
           ROUND(AVG("1") FILTER (cohort_month NOT LIKE '%-11'), 6) AS other_months FROM matrix""", a.RETENTION, MATRIX))(
    lambda spark, folder: rounded(reports.mean_month1(matrix(spark, folder)).select(
        F.col("in_month").cast("double"), F.col("other_months").cast("double")), "in_month", "other_months"))

query("refusal_ratio", "H10", s.on_fact("""
    SELECT ROUND((SUM(rto_orders) FILTER (cod) / SUM(shipped_orders) FILTER (cod))
               / (SUM(rto_orders) FILTER (pre) / SUM(shipped_orders) FILTER (pre)), 6) AS ratio
    FROM (SELECT CAST(rto_orders AS DOUBLE) AS rto_orders, shipped_orders,
                 payment_group = 'COD' AND customer_type = 'First order' AS cod, payment_group = 'Prepaid' AS pre
          FROM drivers)""", a.DRIVERS))(
    lambda spark, folder: rounded(reports.refusal_ratio(
        views.rto_drivers(star.numbered_facts(spark, folder), star.RULES)), "ratio"))

_REASONS = list(star.RULES.return_reasons)
query("reason_shares", "H11", s.on_fact("SELECT category, return_rate_pct, " + ", ".join(
    f"ROUND(100.0::DOUBLE * COALESCE({c}, 0) / items_delivered, 6) AS {c}" for c in _REASONS) + " FROM by_category", a.BY_CATEGORY))(
    lambda spark, folder: rounded(reports.reason_shares(a.by_category(spark, folder)), *_REASONS))

query("rfm_unpivot", "H12", s.on_fact("""
    SELECT segment, 'Share of customers' AS measure, ROUND(100.0::DOUBLE * customers / SUM(customers) OVER (), 6) AS pct
    FROM rfm_summary UNION ALL SELECT segment, 'Share of net revenue', revenue_share_pct FROM rfm_summary""", *a.RFM_SUMMARY))(
    lambda spark, folder: rounded(reports.rfm_shares(a.rfm_summary(star.facts(spark, folder))), "pct"))

query("tier_periods", "H13", s.on_fact(
    "SELECT *, order_year || ' H' || half AS period FROM growth ORDER BY order_year, half, city_tier", a.GROWTH))(
    lambda spark, folder: reports.tier_periods(views.city_tier_growth(star.facts(spark, folder))))

query("first_order_bars", "H13", s.on_dim("SELECT * FROM experience", a.EXPERIENCE))(
    lambda spark, folder: reports.in_listed_order(views.first_order_experience(star.dimension(spark, folder)),
                                                  "first_order_experience", reports.EXPERIENCE_ORDER))

query("channel_bars", "H13", s.on_dim(
    "SELECT * FROM channels ORDER BY repeat_90d_pct DESC NULLS LAST, acquisition_channel", a.CHANNELS))(
    lambda spark, folder: reports.channel_bars(views.channel_quality(star.dimension(spark, folder))))

query("spend_gap", "H14", s.on_dim("""
    SELECT ROUND(1 - MAX(avg_net_revenue) FILTER (acquisition LIKE '%code') / MAX(avg_net_revenue) FILTER (acquisition NOT LIKE '%code'), 6)
        AS gap FROM quality""", a.QUALITY))(
    lambda spark, folder: rounded(reports.spend_gap(views.acquisition_quality(star.dimension(spark, folder))), "gap"))
