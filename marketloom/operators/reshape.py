"""Reshaping of results for reports. Inputs are aggregates: days, months, labels, segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.rates import ratio


def growth_ratio(df: DataFrame, order: str, column: str, name: str = "growth") -> DataFrame:
    """H1: last value over first value."""
    return df.agg(F.min(order).alias("first_period"), F.max(order).alias("last_period"),
                  ratio(F.max_by(column, order), F.min_by(column, order)).alias(name))


def centred_mean(df: DataFrame, order: str, column: str, name: str, n: int = 7) -> DataFrame:
    """H2: mean of the n rows around each row; NULL where fewer than n exist.

    The input has one row per day, so the one sorted run this needs is bounded by the calendar.
    """
    around = Window.orderBy(order).rowsBetween(-(n // 2), n // 2)
    full = F.count(F.col(column)).over(around) == n
    return df.withColumn(name, F.when(full, F.avg(column).over(around)))


def peak_row(df: DataFrame, column: str, *tie_break: str) -> DataFrame:
    """H3: the row with the highest value, the first one on ties."""
    return df.orderBy(F.desc_nulls_last(column), *[F.asc(c) for c in tie_break]).limit(1)


def peak_to_median(df: DataFrame, column: str, mean: str, name: str = "peak_to_median") -> DataFrame:
    """H4: highest value over the median of the moving mean."""
    return df.agg((F.max(column) / F.median(mean)).alias(name))


def annotate_calendar(df: DataFrame, date: str, calendar: DataFrame) -> DataFrame:
    """H5: each day with the named ranges it lies in; days outside all ranges keep NULL.

    Ranges are listed day by day and matched by equality; the optimizer sees how large that is.
    """
    days = calendar.select("event", F.explode(F.sequence("starts", "ends")).alias(date))
    return df.join(days, date, "left")


def pivot_values(df: DataFrame, row: str, column: str, value: str, values: Mapping[object, str],
                 fill: object | None = None) -> DataFrame:
    """H6-H8: one output column per listed value, in the listed order."""
    def cell(key, name):
        picked = F.max(F.when(F.col(column) == key, F.col(value)))
        return (picked if fill is None else F.coalesce(picked, F.lit(fill))).alias(name)

    return df.groupBy(row).agg(*[cell(key, name) for key, name in values.items()])


def mean_by(df: DataFrame, condition: Column, value: str, yes: str, no: str) -> DataFrame:
    """H9: plain mean of the rows that meet a condition and of the rest."""
    return df.agg(F.avg(F.when(condition, F.col(value))).alias(yes), F.avg(F.when(~condition, F.col(value))).alias(no))


def ratio_of_rates(df: DataFrame, hits: str, n: str, top: Column, bottom: Column, name: str) -> DataFrame:
    """Pooled rate of one set of groups over the pooled rate of another."""
    def rate(where):
        return ratio(F.sum(F.when(where, F.col(hits))), F.sum(F.when(where, F.col(n)))).cast("double")

    return df.agg((rate(top) / F.nullif(rate(bottom), F.lit(0.0))).alias(name))


def shares(df: DataFrame, parts: Sequence[str], whole: str, keep: Sequence[str]) -> DataFrame:
    """Parts as percentages of the whole; NULL parts are 0."""
    return df.select(*keep, *[(100 * F.coalesce(F.col(p), F.lit(0)) / F.col(whole)).alias(p) for p in parts])


def with_share(df: DataFrame, column: str, name: str) -> DataFrame:
    """Each row's percentage of the column total; the input is a handful of segments."""
    return df.withColumn(name, 100 * F.col(column) / F.sum(column).over(Window.partitionBy()))


def melt(df: DataFrame, key: str, measures: Mapping[str, str], name: str, value: str) -> DataFrame:
    """One row per key and measure, measures relabelled."""
    cells = [F.struct(F.lit(label).alias(name), F.col(c).cast("double").alias(value)) for c, label in measures.items()]
    return df.select(key, F.inline(F.array(*cells)))


def with_period_label(df: DataFrame, year: str, half: str, name: str = "period") -> DataFrame:
    """``2024 H1``."""
    return df.withColumn(name, F.concat(F.col(year).cast("string"), F.lit(" H"), F.col(half).cast("string")))


def relative_gap(df: DataFrame, column: str, top: Column, bottom: Column, name: str) -> DataFrame:
    """How much less one row has than another, as a share of the other."""
    a, b = F.max(F.when(top, F.col(column))), F.max(F.when(bottom, F.col(column)))
    return df.agg((1 - a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))).alias(name))
