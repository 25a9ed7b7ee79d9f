"""Counting defects. Checks on one table share one pass over it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.text import as_col, has_prefix, is_blank
from marketloom.session import stored

_LOOSE = "UTF8_LCASE_RTRIM"


# --- expressions for a shared aggregate -------------------------------------------------------

def count_rows() -> Column:
    """C1."""
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; NULL does not hold."""
    return F.count_if(condition)


def count_like(column: Column | str, pattern: str) -> Column:
    """Rows with the LIKE pattern, in any case."""
    return F.count_if(as_col(column).ilike(pattern))


def count_blank(column: Column | str) -> Column:
    """NULL or only spaces."""
    return F.count_if(is_blank(column))


def count_prefix(column: Column | str, prefix: str) -> Column:
    """Ids with the prefix, in any case."""
    return F.count_if(has_prefix(column, prefix))


def count_excess(key: Column | str) -> Column:
    """C11, C17: rows beyond one per key. NULL keys are all in excess."""
    return F.count(F.lit(1)) - F.count_distinct(as_col(key))


# --- whole-table counts -----------------------------------------------------------------------

def one_row(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """All checks of one table in one aggregate, one result row per check."""
    named = {f"c{i}": (name, expr) for i, (name, expr) in enumerate(checks.items())}
    totals = df.agg(*[expr.cast("bigint").alias(c) for c, (_, expr) in named.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(c).alias("rows_affected"))
                     for c, (name, _) in named.items()])
    return totals.select(F.inline(rows))


def row_prints(names: Sequence[str]) -> list[Column]:
    """A row's content in 128 bits."""
    return [F.xxhash64(*names), F.xxhash64(F.lit(1), *names)]


def count_duplicate_rows(df: DataFrame, name: str, prints: Callable[[Sequence[str]], Sequence[Column]] = row_prints) -> DataFrame:
    """Rows beyond one per distinct content.

    Rows are counted by a hash, so the shuffle holds 16 bytes for each. Only rows whose hash comes up again are
    compared in full, so hashes that collide change nothing.
    """
    rows = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    marks = {f"_h{i}": p for i, p in enumerate(prints(rows.columns))}
    marked = rows.withColumns(marks)
    # Kept, so that its size decides how it meets the rows.
    again = stored(marked.groupBy(*marks).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeats")
    copies = marked.join(again, list(marks), "left_semi").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    return one_row(copies, {name: F.coalesce(F.sum(F.col("n") - 1), F.lit(0))})


def count_orphans(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Children whose key no parent has, NULL keys included.

    Children are counted per key before the join, so a hot key joins as one row.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lost = per_key.join(parent.select(key), key, "left_anti")
    return one_row(lost, {name: F.coalesce(F.sum("n"), F.lit(0))})


def count_above_ratio(child: DataFrame, parent: DataFrame, key: str, value: Column, reference: Column,
                      times: int, name: str) -> DataFrame:
    """Children whose value exceeds ``times`` the parent's reference."""
    joined = (child.select(key, value.alias("_value"))
              .join(parent.select(key, reference.alias("_reference")), key))
    return one_row(joined, {name: F.count_if(F.col("_value") > F.col("_reference") * F.lit(times))})


def label_inventory(tables: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Field, raw value, length in characters and rows, for many label fields.

    Each table is read once for all its fields and collapses to its distinct labels at once.
    """
    parts = [df.select(*fields).unpivot([], list(fields), "field", "raw_value")
             .groupBy("field", "raw_value").agg(F.count(F.lit(1)).alias("rows_count"))
             for df, fields in tables]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.select("field", "raw_value", F.length("raw_value").alias("characters"), "rows_count")


def value_inventory(df: DataFrame, column: str, value: str, rows: str) -> DataFrame:
    """Exact spellings of one column, most frequent first."""
    found = df.groupBy(F.col(column).alias(value)).agg(F.count(F.lit(1)).alias(rows))
    return (found.select(value, F.length(value).alias("characters"), rows)
            .orderBy(F.desc(rows), F.asc_nulls_last(value), "characters"))


def count_spellings(inventory: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Exact distinct values per field, read off a label inventory."""
    return one_row(inventory, {name: F.count_if((F.col("field") == field) & F.col("raw_value").isNotNull())
                               for field, name in names.items()})


def spelling_gap(df: DataFrame, column: str) -> DataFrame:
    """Distinct values when case and trailing spaces count and when they do not."""
    spellings = df.groupBy(column).agg(F.lit(1).alias("_seen"))
    loose = F.collate(F.col(column), _LOOSE)
    return spellings.agg(F.count_distinct(loose).alias("loose_spellings"),
                         F.count(column).alias("real_spellings"))


def scorecard(parts: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """C20: all checks of all tables, one row each."""
    stacked = [part.select(F.lit(table).alias("table_name"), "check_name", "rows_affected")
               for table, checks in parts.items() for part in checks]
    return reduce(DataFrame.unionByName, stacked)


def row_loss(raw: Mapping[str, DataFrame], clean: Mapping[str, DataFrame]) -> DataFrame:
    """Rows before and after cleaning."""
    def sizes(tables, layer):
        return [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), F.lit(layer).alias("layer"), "n")
                for t, df in tables.items()]

    counted = reduce(DataFrame.unionByName, sizes(raw, "raw") + sizes(clean, "clean"))
    return counted.groupBy("table_name").agg(
        F.max(F.when(F.col("layer") == "raw", F.col("n"))).alias("raw_rows"),
        F.max(F.when(F.col("layer") == "clean", F.col("n"))).alias("clean_rows"))


def first_key(df: DataFrame, condition: Column, key: str) -> DataFrame:
    """The smallest key among the rows that meet the condition, as one row."""
    return df.where(condition).agg(F.min(key).alias(key))


def before_after(raw: DataFrame, clean: DataFrame, key: str, pick: DataFrame) -> DataFrame:
    """The picked record in its raw and its clean form, both as text."""
    def shown(df, layer):
        chosen = df.join(F.broadcast(pick), key, "left_semi")
        return chosen.select(F.lit(layer).alias("layer"), *[F.col(c).cast("string") for c in raw.columns if c != key])

    return shown(raw, "raw").unionByName(shown(clean.select(*raw.columns), "clean"))


def sample_top(df: DataFrame, columns: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n rows in an order; every task forwards at most n."""
    return df.select(*columns).orderBy(*order).limit(n)


def entity_history(fact: DataFrame, dim: DataFrame, key: str, has_enough: Column,
                   columns: Sequence[str], order: str, n: int) -> DataFrame:
    """The events of the first entity that qualifies, in order."""
    chosen = first_key(dim, has_enough, key)
    return fact.join(F.broadcast(chosen), key, "left_semi").select(*columns).orderBy(order).limit(n)
