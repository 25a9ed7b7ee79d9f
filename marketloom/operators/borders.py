"""Rows at given places of a total order, found without sorting the rows.

A histogram of at most ``CELLS`` cells is counted before the shuffle and added up; its running totals tell
in which cell each wanted place lies, and only those cells are cut again, finer each time. A cell that
holds a single value goes on to the next column of the order. Once the cells around the wanted places hold
few rows, these few are ranked. Every other row is only counted, and later compared with the rows found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells of a histogram, and the rows around one place that are ranked by one task.
CELLS, AT_ONCE = 4096, 1 << 16
# Text is compared by its bytes; so many after the common start become a number.
_BYTES = 6


@dataclass(frozen=True)
class Key:
    """A column of an order. NULL comes first in rising order and last in falling order."""

    name: str
    falls: bool = False

    @classmethod
    def of(cls, text: str) -> Key:
        return cls(text.removeprefix("-"), text.startswith("-"))

    def sort(self) -> Column:
        return F.desc_nulls_last(self.name) if self.falls else F.asc_nulls_first(self.name)


@dataclass
class Span:
    """Rows that agree in the leading columns and lie between two values of the next one."""

    equal: list  # values of the leading columns
    low: object
    high: object
    before: int  # rows of the order that come before the span
    rows: int
    places: list[int] = field(default_factory=list)
    whole: bool = False  # all rows that agree in the leading columns, NULLs of the next one too

    @property
    def depth(self) -> int:
        return len(self.equal)


def _literal(value: object, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def _within(span: Span, order: Sequence[Key], kinds: dict[str, T.DataType]) -> Column:
    terms = [F.col(k.name).eqNullSafe(_literal(v, kinds[k.name])) for k, v in zip(order, span.equal)]
    if span.depth < len(order) and not span.whole:
        key = order[span.depth].name
        terms += [F.col(key) >= _literal(span.low, kinds[key]), F.col(key) <= _literal(span.high, kinds[key])]
    return reduce(Column.__and__, terms, F.lit(True))


def _as_number(column: Column, kind: T.DataType, low: object, high: object) -> Column:
    """A number that never falls as the value rises, exact enough to tell ``low`` from ``high``."""
    if isinstance(kind, T.StringType):
        shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        part = F.substring(F.encode(F.substring(column, shared + 1, _BYTES), "utf-8"), 1, _BYTES)
        return F.conv(F.rpad(F.hex(part), 2 * _BYTES, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):  # zone-less: no clock change may turn it back
        clock = (F.hour(column) * 60 + F.minute(column)) * 60 + F.date_part(F.lit("SECOND"), column)
        return F.unix_date(column.cast("date")).cast("double") * 86400 + clock.cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.IntegralType):
        return (column.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")).cast("double")
    if isinstance(kind, T.DecimalType):
        return (column - _literal(low, kind)).cast("double")
    return column.cast("double")


def _cell(span: Span, key: Key, kind: T.DataType, cells: int) -> Column:
    """The place of a row's cell among those of its span, NULL for a NULL."""
    number = _as_number(F.col(key.name), kind, span.low, span.high)
    ends = [_as_number(_literal(v, kind), kind, span.low, span.high) for v in (span.low, span.high)]
    width = F.greatest(ends[1] - ends[0], F.lit(5e-324))
    at = F.least(F.floor((number - ends[0]) / width * cells), F.lit(cells - 1)).cast("int")
    return F.when(F.col(key.name).isNotNull(), F.lit(cells - 1) - at if key.falls else at)


def _cut(df: DataFrame, spans: list[Span], order: Sequence[Key], kinds: dict[str, T.DataType], cells: int) -> list[Span]:
    """The cells of these spans that hold a wanted place, from one pass over the rows of the spans."""
    if not spans:
        return []
    which = reduce(lambda c, i: c.when(_within(spans[i], order, kinds), i), range(len(spans)), F.when(F.lit(False), -1))
    at = reduce(lambda c, i: c.when(F.col("_span") == i, _cell(spans[i], order[spans[i].depth], kinds[order[spans[i].depth].name], cells)),
                range(len(spans)), F.when(F.lit(False), -1))
    depths = sorted({s.depth for s in spans})
    ends = [f(order[d].name).alias(f"{n}{d}") for d in depths for n, f in (("low", F.min), ("high", F.max))]
    counted = (df.withColumn("_span", which).where("_span is not null").groupBy("_span", at.alias("_cell"))
               .agg(F.count(F.lit(1)).alias("n"), *ends).collect())  # at most spans * (cells + 1) rows
    out = []
    for i, span in enumerate(spans):
        nulls = 1 if order[span.depth].falls else -1
        before, left = span.before, span.places
        for r in sorted((r for r in counted if r["_span"] == i),
                        key=lambda r: (nulls, 0) if r["_cell"] is None else (0, r["_cell"])):
            held, left = [p for p in left if p < before + r["n"]], [p for p in left if p >= before + r["n"]]
            low, high = r[f"low{span.depth}"], r[f"high{span.depth}"]
            if held and (low == high or low != low):  # NaN is the largest value, and equals no other
                out.append(Span([*span.equal, low], None, None, before, r["n"], held, True))
            elif held:
                out.append(Span(span.equal, low, high, before, r["n"], held))
            before += r["n"]
    return out


def _bounded(df: DataFrame, spans: list[Span], order: Sequence[Key], kinds: dict[str, T.DataType]) -> list[Span]:
    """Spans that go on to a new column, with that column's ends; one pass for all of them."""
    if not spans:
        return []
    ask = [f(F.when(_within(s, order, kinds), F.col(order[s.depth].name))).alias(f"{n}{i}")
           for i, s in enumerate(spans) for n, f in (("low", F.min), ("high", F.max))]
    got = df.agg(*ask).first()
    return [replace(s, low=got[f"low{i}"], high=got[f"high{i}"]) for i, s in enumerate(spans)]


def rows_at(df: DataFrame, order: Sequence[str], places: Sequence[int], *, cells: int = CELLS, at_once: int = AT_ONCE) -> dict[int, list]:
    """The order's columns at each of the 0-based ``places`` that exist, by place.

    ``order`` lists columns, each after "-" if it falls (NULL first, or last if it falls). Rows that tie in all of
    them are equal here. ``df`` is read a few times, so it should be stored; it is never shuffled.
    """
    keys, kinds = [Key.of(c) for c in order], {f.name: f.dataType for f in df.schema.fields}
    df = df.select(*dict.fromkeys(k.name for k in keys))
    rows = df.count()
    wanted = sorted({p for p in places if 0 <= p < rows})
    found: dict[int, list] = {}
    few: list[Span] = []
    todo = [Span([], None, None, 0, rows, wanted, True)] if wanted else []
    while todo:
        bounded = _bounded(df, [s for s in todo if s.whole], keys, kinds) + [s for s in todo if not s.whole]
        only_nulls = [s for s in bounded if s.low is None]
        cut = [replace(s, equal=[*s.equal, None]) for s in only_nulls]
        cut += _cut(df, [s for s in bounded if s.low is not None], keys, kinds, cells)
        seen, todo = [(s.depth, s.before, s.rows) for s in bounded], []
        for span in cut:
            if span.depth == len(keys):
                found.update({p: span.equal for p in span.places})
            elif span.rows <= at_once or (span.depth, span.before, span.rows) in seen:
                few.append(span)  # values that no number tells apart are ranked however many they are
            else:
                todo.append(span)
    if few:
        which = reduce(lambda c, i: c.when(_within(few[i], keys, kinds), i), range(len(few)), F.when(F.lit(False), -1))
        near = df.withColumn("_span", which).where("_span is not null")
        ranked = near.withColumn("_rank", F.row_number().over(Window.partitionBy("_span").orderBy(*[k.sort() for k in keys])) - 1)
        asked = reduce(Column.__or__, [(F.col("_span") == i) & F.col("_rank").isin([p - s.before for p in s.places]) for i, s in enumerate(few)])
        for r in ranked.where(asked).collect():  # a row for each place
            found[few[r["_span"]].before + r["_rank"]] = [r[k.name] for k in keys]
    return found


def at_or_after(df: DataFrame, order: Sequence[str], row: Sequence) -> Column:
    """Whether a row of ``df`` comes at the given row's place of the order or after it."""
    out = F.lit(True)
    for key, value in reversed(list(zip(map(Key.of, order), row))):
        column, end = F.col(key.name), _literal(value, df.schema[key.name].dataType)
        if key.falls:
            later = F.lit(False) if value is None else column.isNull() | (column < end)
        else:
            later = column.isNotNull() if value is None else column > end
        out = F.coalesce(later, F.lit(False)) | (column.eqNullSafe(end) & out)
    return out
