"""Column functions on one value per case."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom import lookups
from marketloom.functions import dates, money, parsing, rates, text


def each(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").select("out").collect()]


def test_mixed_timestamps(spark):
    got = each(spark, ["31/12/2024 23:59", "2025-01-01 00:00:01", "junk", "", " ", None, "31/02/2024 10:00", "2025",
                       "2025-01-01"], parsing.parse_mixed_ts)
    assert got == [dt.datetime(2024, 12, 31, 23, 59), dt.datetime(2025, 1, 1, 0, 0, 1), None, None, None, None, None,
                   None, dt.datetime(2025, 1, 1)]


def test_timestamps_ignore_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 on this day does not exist in New York.
        assert each(spark, ["10/03/2024 02:30"], parsing.parse_mixed_ts) == [dt.datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_mixed_dates(spark):
    assert each(spark, ["02/01/2024", "2024-01-02", "2/1/2024", None], parsing.parse_mixed_date) == [
        dt.date(2024, 1, 2), dt.date(2024, 1, 2), None, None]


def test_safe_numbers(spark):
    assert each(spark, ["12", " 12 ", "1.5", "x", "", None], lambda c: parsing.safe_num(c, "int")) == [
        12, 12, None, None, None, None]
    assert each(spark, ["12.345", "n/a"], lambda c: parsing.safe_num(c, "decimal(14,2)")) == [Decimal("12.35"), None]


def test_currency(spark):
    assert each(spark, ["Rs. 150", "150", "RS.150", "free", None], text.strip_currency) == [150, 150, 150, None, None]


def test_promo_sentinels(spark):
    assert each(spark, ["NONE", "", " azadi14 ", None, "none"], lambda c: text.null_if(c, lookups.NO_PROMO)) == [
        None, None, "AZADI14", None, None]


def test_payment_labels(spark):
    values = ["COD ", "CC", "WALLET", "crypto", None]
    assert each(spark, values, lambda c: text.map_labels(c, lookups.PAYMENT_METHODS)) == [
        "Cash on Delivery", "Card", "Mobile Wallet", None, None]
    assert each(spark, values, lambda c: text.map_labels(c, lookups.PAYMENT_GROUPS, F.lit("Prepaid"))) == [
        "COD", "Prepaid", "Prepaid", "Prepaid", "Prepaid"]


def test_status_labels(spark):
    assert each(spark, ["DLVD", "canceled", "RTO", "shipped", "lost"],
                lambda c: text.map_labels(c, lookups.ORDER_STATUSES)) == [
        "Delivered", "Cancelled", "Returned to Origin", "In Transit", None]


def test_categories(spark):
    assert each(spark, ["Home AND Kitchen", "Fashion ", "Garden", "Baby and Toys"],
                lambda c: text.map_labels(text.and_to_ampersand(c), lookups.CATEGORIES)) == [
        "Home & Kitchen", "Fashion", None, "Baby & Toys"]


def test_channels_keep_unknown_labels(spark):
    assert each(spark, ["Facebook Ads", "app_store", " Direct "],
                lambda c: text.map_labels(c, lookups.CHANNELS, F.trim(c))) == ["Paid Social", "App Store", "Direct"]


def test_city_map_has_every_spelling_once(spark):
    cities = lookups.city_map(spark)
    assert cities.count() == cities.select("raw_key").distinct().count() == 33
    assert {r.raw_key: r.city for r in cities.collect()}["abbotabad"] == "Abbottabad"


def test_prefix(spark):
    assert each(spark, ["TEST001", "test002", "C1", None], lambda c: text.has_prefix(c, "TEST")) == [
        True, True, False, None]


def test_month_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)), (dt.date(2023, 12, 1), dt.date(2025, 1, 1))],
                               "a date, b date")
    assert [r[0] for r in df.select(dates.months_between_buckets("a", "b")).collect()] == [1, 13]


@pytest.mark.parametrize("part, whole, want", [
    (201, 20000, "1.01"),  # 1.005: a half that doubles cannot hold
    (1, 800, "0.13"), (1, 3, "33.33"), (0, 5, "0.00"), (5, 0, None), (2, 3, "66.67")])
def test_percent_rounds_half_up(spark, part, whole, want):
    df = spark.createDataFrame([(part, whole)], "a bigint, b bigint")
    got = df.select(rates.percent("a", "b")).first()[0]
    assert got == (None if want is None else Decimal(want))


def test_percent_holds_sums_of_a_trillion_rows(spark):
    big = Decimal("9") * 10 ** 21
    df = spark.createDataFrame([(big, big)], "a decimal(38,2), b decimal(38,2)")
    assert df.select(rates.percent("a", "b")).first()[0] == Decimal("100.00")


def test_money_totals_are_exact(spark):
    rows = [(1, i % 9 - 2, Decimal(p)) for i, p in enumerate(
        ["0.01", "999999999999.99", "0.07", "1.15", "-3.33", "123456789.01", "0.29", "70000.10"] * 50)]
    rows += [(2, 3, None), (2, None, Decimal("1.00")), (3, None, None)]
    df = spark.createDataFrame(rows, "g int, q int, p decimal(14,2)")
    got = df.select("g", "q", money.cents("p").alias("c")).groupBy("g").agg(money.total_times("q", "c").alias("t"))
    want = df.groupBy("g").agg(F.sum(F.col("q") * F.col("p")).alias("t"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_money_totals_beyond_64_bits(spark):
    line = 9 * 10 ** 18  # cents; two of them overflow a bigint
    df = spark.range(1000).select(F.lit(line).alias("c"))
    assert df.agg(money.total("c")).first()[0] == Decimal(line) * 1000 / 100


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lines_beyond_64_bits_are_summed(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        huge, usual = (2 ** 31 - 1, Decimal("999999999999.99")), (3, Decimal("1.10"))
        for rows in ([huge], [huge, usual, huge, (None, Decimal(1))], [usual]):
            df = spark.createDataFrame(rows, "q int, p decimal(14,2)")
            got = df.select("q", money.cents("p").alias("c")).agg(money.total_times("q", "c")).first()[0]
            assert got == sum(q * p for q, p in rows if q is not None)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("part, whole, want", [
    (5000, 100_000_001, "0.00"), (500_000, 10_000_000_001, "0.00"), (5000, 99_999_999, "0.01"), (1, 20_000, "0.01"),
    (-1, 20_000, "-0.01"), (-1, 20_001, "0.00"), (1, -20_000, "-0.01"), (10**13 + 1, 2 * 10**17, "0.01"), (0, 7, "0.00")])
def test_percent_is_rounded_once(spark, part, whole, want):
    df = spark.createDataFrame([(part, whole)], "a bigint, b bigint")
    assert df.select(rates.percent("a", "b")).first()[0] == Decimal(want)
    assert df.select(rates.rounded_mean(F.col("a") * 100, "b")).first()[0] == Decimal(want)
