"""Tables behind the charts, from the exported views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom import lookups
from marketloom.operators import experiment as x
from marketloom.operators import reshape as r
from marketloom.rules import AB_DEVICES, DEFAULT_RULES, Rules

EXPERIENCE_ORDER = ("Delivered on time", "Cancelled", "Delivered late", "Refused at door (RTO)")


def in_listed_order(df: DataFrame, column: str, values) -> DataFrame:
    """Only the listed values, in the listed order."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return df.where(F.col(column).isin(*values)).orderBy(place)


def daily_trend(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    smoothed = r.centred_mean(daily, "order_date", "orders", "avg_7d")
    return r.annotate_calendar(smoothed, "order_date", calendar)


def payment_mix_wide(mix: DataFrame) -> DataFrame:
    names = {m: m for m in ("Cash on Delivery", "Mobile Wallet", "Card")}
    return r.pivot_values(mix, "order_month", "payment_method", "share_pct", names, fill=0)


def courier_matrix(card: DataFrame) -> DataFrame:
    tiers = {t: f"Tier {t} cities" for t in (1, 2, 3)}
    return r.pivot_values(card.na.drop(subset=["city_tier"]), "courier", "city_tier", "late_rate_pct", tiers)


def worst_courier_and_tier(card: DataFrame) -> DataFrame:
    """H3: the courier and tier with the highest late rate."""
    return r.peak_row(card.na.drop(subset=["city_tier"]), "late_rate_pct", "courier", "city_tier")


def channel_bars(channels: DataFrame) -> DataFrame:
    """Channels, best repeat rate first."""
    return channels.orderBy(F.desc_nulls_last("repeat_90d_pct"), "acquisition_channel")


def cohort_matrix(retention: DataFrame, until: dt.date, offsets=range(1, 7)) -> DataFrame:
    """H8: cohorts up to a month, one column per month after the first order."""
    kept = retention.where((F.col("cohort_month") <= F.lit(until)) & F.col("months_since_first").isin(*offsets))
    labelled = kept.withColumn("cohort_month", F.date_format("cohort_month", "yyyy-MM"))
    return r.pivot_values(labelled, "cohort_month", "months_since_first", "retention_pct", {o: str(o) for o in offsets})


def mean_month1(matrix: DataFrame, month: int = 11) -> DataFrame:
    """H9: month-1 retention of cohorts of one calendar month against all others."""
    return r.mean_by(matrix, F.col("cohort_month").endswith(f"-{month:02d}"), "1", "in_month", "other_months")


def refusal_ratio(drivers: DataFrame) -> DataFrame:
    """First cash orders against prepaid orders."""
    cod_first = (F.col("payment_group") == "COD") & (F.col("customer_type") == "First order")
    return r.ratio_of_rates(drivers, "rto_orders", "shipped_orders", cod_first,
                            F.col("payment_group") == lookups.DEFAULT_PAYMENT_GROUP, "ratio")


def reason_shares(by_category: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    shares = r.shares(by_category, list(rules.return_reasons), "items_delivered", ["category", "return_rate_pct"])
    return shares.orderBy(F.desc("return_rate_pct"), "category")


def rfm_shares(summary: DataFrame) -> DataFrame:
    shared = r.with_share(summary, "customers", "customer_share_pct")
    return r.melt(shared, "segment", {"customer_share_pct": "Share of customers",
                                      "revenue_share_pct": "Share of net revenue"}, "measure", "pct")


def tier_periods(growth: DataFrame) -> DataFrame:
    return r.with_period_label(growth, "order_year", "half").orderBy("order_year", "half", "city_tier")


def spend_gap(quality: DataFrame) -> DataFrame:
    """How much less mega-sale customers spend."""
    sale = F.col("acquisition") == "First order used a mega-sale code"
    return r.relative_gap(quality, "avg_net_revenue", sale, ~sale, "gap")


def ab_results(ab: DataFrame) -> DataFrame:
    return x.two_proportion_test(x.segment_counts(ab, AB_DEVICES))


def sample_ratio(ab: DataFrame) -> DataFrame:
    return x.srm_verdict(x.srm_test(x.srm_counts(ab)))


def build(views: Mapping[str, DataFrame], rules: Rules = DEFAULT_RULES,
          cohorts_until: dt.date = dt.date(2025, 12, 1)) -> dict[str, DataFrame]:
    daily = views["daily_orders"]
    matrix = cohort_matrix(views["cohort_retention"], cohorts_until)
    smoothed = r.centred_mean(daily, "order_date", "orders", "avg_7d")
    return {
        "growth": r.growth_ratio(views["monthly_kpis"], "order_month", "net_revenue"),
        "daily_trend": daily_trend(daily, lookups.calendar(daily.sparkSession)),
        "busiest_day": r.peak_row(daily, "orders", "order_date"),
        "peak_to_median": r.peak_to_median(smoothed, "orders", "avg_7d"),
        "payment_mix_wide": payment_mix_wide(views["payment_mix"]),
        "refusal_ratio": refusal_ratio(views["rto_drivers"]),
        "courier_matrix": courier_matrix(views["courier_scorecard"]),
        "worst_courier_and_tier": worst_courier_and_tier(views["courier_scorecard"]),
        "latest_month": r.peak_row(views["delivery_monthly"], "late_rate_pct", "order_month"),
        "first_order_bars": in_listed_order(views["first_order_experience"], "first_order_experience", EXPERIENCE_ORDER),
        "cohort_matrix": matrix.orderBy("cohort_month"), "mean_month1": mean_month1(matrix),
        "channel_bars": channel_bars(views["channel_quality"]),
        "spend_gap": spend_gap(views["acquisition_quality"]),
        "reason_shares": reason_shares(views["returns_by_category"], rules),
        "rfm_shares": rfm_shares(views["rfm_summary"]), "tier_periods": tier_periods(views["city_tier_growth"]),
        "ab_test_results": ab_results(views["ab_test"]), "sample_ratio": sample_ratio(views["ab_test"]),
    }
