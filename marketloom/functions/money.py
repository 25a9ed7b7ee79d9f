"""Exact sums of money without wide decimals in the inner loop.

Spark multiplies and adds decimals of more than 18 digits as objects, which costs more than all else
in rolling up order lines. Here a line is a whole number of cents, and its upper and lower bits are
summed apart as integers: the lower sum stays in range for 8 * 10^12 rows per group, the upper one
far beyond the money there is. Only the two totals per group become a decimal.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.text import as_col

MONEY = "decimal(14,2)"
TOTAL = "decimal(26,2)"
_LOW_BITS = 20


def cents(price: Column | str) -> Column:
    """A decimal(14,2) as whole cents. Below 2^53, so the way over double is exact once rounded."""
    return F.round(as_col(price).cast(MONEY).cast("double") * 100).cast("bigint")


def _exact_total(amount: Column) -> Column:
    """Aggregate: the sum of whole numbers as a decimal."""
    high = F.sum(F.shiftright(amount, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(amount.bitwiseAND((1 << _LOW_BITS) - 1)).cast("decimal(20,0)")
    return high * F.lit(1 << _LOW_BITS) + low


def total_times(quantity: Column | str, whole_cents: Column | str) -> Column:
    """Aggregate: the exact sum of quantity times cents as money; NULL without any value.

    Lines above 9 * 10^18 cents, which no integer holds, are summed apart as decimals.
    """
    count, amount = as_col(quantity).cast("bigint"), as_col(whole_cents)
    too_large = F.abs(count.cast("double") * amount.cast("double")) > 9e18
    usual = _exact_total(F.when(~too_large, count * amount))
    unusual = F.sum(F.when(too_large, count.cast("decimal(19,0)") * amount.cast("decimal(19,0)")))
    whole = F.coalesce(usual.cast("decimal(38,0)") + unusual, usual.cast("decimal(38,0)"), unusual)
    return (whole.cast("decimal(34,0)") * F.lit(Decimal("0.01"))).cast(TOTAL)


def total(whole_cents: str) -> Column:
    """Aggregate: the exact sum of a cents column as money; NULL without any value."""
    return (_exact_total(F.col(whole_cents)) * F.lit(Decimal("0.01"))).cast(TOTAL)
