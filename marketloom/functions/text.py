"""Text rules. Spark compares bytes, so every loose comparison is spelled out here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, NULL where nothing is left."""
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def is_blank(c: Column | str) -> Column:
    return blank_to_null(c).isNull()


def norm(c: Column | str) -> Column:
    """The comparison key of a label or email."""
    return F.lower(F.trim(as_col(c)))


def null_if(c: Column | str, sentinels: Sequence[str]) -> Column:
    """Trimmed upper-case text, NULL for every sentinel."""
    text = F.upper(F.trim(as_col(c)))
    return F.when(~text.isin(*sentinels), text)


def has_prefix(c: Column | str, prefix: str) -> Column:
    """Case-insensitive prefix test; NULL for NULL."""
    return F.lower(as_col(c)).startswith(prefix.lower())


def strip_currency(c: Column | str, mark: str = "Rs.") -> Column:
    """``Rs. 150`` as the integer 150; NULL where no integer is left."""
    digits = F.regexp_replace(as_col(c), "(?i)" + mark.replace(".", "[.]") + "| ", "")
    return digits.try_cast("int")


def map_labels(c: Column | str, labels: Mapping[str, Sequence[str]], default: Column | None = None) -> Column:
    """A label standardised by its trimmed lower-case form.

    ``labels`` maps the standard label to the forms that mean it. Without ``default`` an unknown
    label is NULL (closed list); ``default=trim(c)`` keeps it (open list); a literal default also
    covers NULL input.
    """
    key = norm(c)
    out = None
    for label, forms in labels.items():
        hit = key.isin(*forms)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out if default is None else out.otherwise(default)


def and_to_ampersand(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), "(?i) and ", " & ")
