"""Calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.text import as_col


def to_day(c: Column | str) -> Column:
    """The calendar day of a timestamp."""
    return as_col(c).cast("date")


def month_bucket(c: Column | str) -> Column:
    """The first day of the month."""
    return F.trunc(as_col(c), "MM")


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_col(end), as_col(start))


def months_between_buckets(start: Column | str, end: Column | str) -> Column:
    """Month boundaries crossed, not whole months lived: Jan 31 to Feb 1 is 1."""
    a, b = as_col(start), as_col(end)
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def month_number(c: Column | str) -> Column:
    """Months since the start of year 0."""
    return F.year(as_col(c)) * 12 + F.month(as_col(c)) - 1


def half_of_year(c: Column | str) -> Column:
    return F.when(F.month(as_col(c)) <= 6, F.lit(1)).otherwise(F.lit(2))
