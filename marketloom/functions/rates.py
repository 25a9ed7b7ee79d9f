"""Percentages and averages, rounded half up on exact decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.text import as_col

# Counts or money; 10^22 is beyond both.
_AMOUNT = "decimal(24,2)"


def _exact(c: Column | str) -> Column:
    return as_col(c).cast(_AMOUNT)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole as a decimal of 10 places; NULL where the whole is 0."""
    return _exact(part) / F.nullif(_exact(whole), F.lit(0).cast(_AMOUNT))


def _rounded_quotient(part: Column, whole: Column, scale: int) -> Column:
    """part / whole rounded once, halves away from zero; NULL where the whole is 0.

    Both sides become whole hundredths, and the quotient is taken in whole numbers: with n the part times
    10^scale and d the whole, (2 n + d) div 2 d is n / d rounded half up, for any n and d above zero.
    """
    def hundredths(c: Column) -> Column:
        return F.abs(c * F.lit(100)).cast("decimal(26,0)")

    n = (hundredths(part) * F.lit(2 * 10 ** scale)).cast("decimal(34,0)")
    d = F.nullif(hundredths(whole), F.lit(0).cast("decimal(26,0)")).cast("decimal(34,0)")
    quotient = F.call_function("div", n + d, d * F.lit(2))
    sign = F.when((part < 0) != (whole < 0), F.lit(-1)).otherwise(F.lit(1))
    places = F.lit(Decimal(1).scaleb(-scale)) if scale else F.lit(Decimal(1))
    return ((sign * quotient).cast("decimal(20,0)") * places).cast(f"decimal(18,{scale})")


def percent(part: Column | str, whole: Column | str, scale: int = 2) -> Column:
    """100 * part / whole, rounded; NULL where the whole is 0."""
    return _rounded_quotient((_exact(part) * F.lit(100)).cast("decimal(26,2)"), _exact(whole), scale)


def rounded_mean(total: Column | str, n: Column | str, scale: int = 2) -> Column:
    """total / n, rounded; NULL where n is 0."""
    return _rounded_quotient(_exact(total), _exact(n), scale)


def share_of(n_true: Column, n_known: Column) -> Column:
    """Percentage of rows where a condition holds among those where it can be judged."""
    return percent(F.count_if(n_true), F.count_if(n_known))
