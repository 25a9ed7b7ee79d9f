"""Safe conversions: a value that does not fit becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.text import as_col, blank_to_null


@dataclass(frozen=True)
class TextDate:
    """A text layout: the LIKE shape that selects it and where its parts start (1-based)."""

    shape: str
    year: int
    month: int
    day: int
    clock: int | None = None

    def to_iso(self, c: Column) -> Column:
        date = F.concat_ws("-", c.substr(self.year, 4), c.substr(self.month, 2), c.substr(self.day, 2))
        return date if self.clock is None else F.concat_ws(" ", date, c.substr(self.clock, 5))


LEGACY_TIMESTAMP = TextDate("__/__/____ __:__", year=7, month=4, day=1, clock=12)
LEGACY_DATE = TextDate("__/__/____", year=7, month=4, day=1)

# Casting alone would also take a bare year or a trailing zone, so the shape is asked for first.
_ISO_DATE = "____-__-__"
_ISO_TIMESTAMP = (_ISO_DATE + " __:__:__", _ISO_DATE + " __:__", _ISO_DATE)


def safe_date(c: Column | str) -> Column:
    """ISO date text to date."""
    text = F.trim(as_col(c))
    return F.when(text.like(_ISO_DATE), text.try_cast("date"))


def safe_ts(c: Column | str) -> Column:
    """ISO date-time text to a zone-less timestamp, so no session time zone can shift it."""
    text = F.trim(as_col(c))
    shaped = reduce(or_, [text.like(shape) for shape in _ISO_TIMESTAMP])
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def safe_num(c: Column | str, kind: str) -> Column:
    """Text to a number of the given type."""
    return blank_to_null(c).try_cast(kind)


def _mixed(c: Column | str, layouts: Sequence[TextDate], convert) -> Column:
    # The layout decides the conversion: a value that has a layout's shape but no valid
    # content is NULL and is not tried as ISO.
    out = convert(c)
    for layout in reversed(layouts):
        out = F.when(as_col(c).like(layout.shape), convert(layout.to_iso(as_col(c)))).otherwise(out)
    return out


def parse_mixed_ts(c: Column | str, layouts: Sequence[TextDate] = (LEGACY_TIMESTAMP,)) -> Column:
    """B2: a timestamp that comes in several text layouts; ISO where no layout applies."""
    return _mixed(c, layouts, safe_ts)


def parse_mixed_date(c: Column | str, layouts: Sequence[TextDate] = (LEGACY_DATE,)) -> Column:
    """A date that comes in several text layouts; ISO where no layout applies."""
    return _mixed(c, layouts, safe_date)
