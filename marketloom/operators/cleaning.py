"""Row-level and table-level cleaning rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.text import as_col, has_prefix, norm
from marketloom.operators.ranking import first_within
from marketloom.operators.skew import spread_join
from marketloom.session import stored


# --- rows -------------------------------------------------------------------------------------

def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """B1: one row per distinct content; copies collapse in the map tasks."""
    return df.distinct()


def exclude_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Drop ids with the prefix in any case, and NULL ids."""
    return df.where(~has_prefix(column, prefix))


def drop_non_positive(df: DataFrame, column: str) -> DataFrame:
    """Keep rows with a known quantity above zero."""
    return df.where(F.col(column) > 0)


# Keys of which a copy on every executor and the driver is small: some 100 bytes each while they are looked up.
FEW_KEYS = 1_000_000


def keep_if_parent(child: DataFrame, parent: DataFrame, key: str, few: int = FEW_KEYS) -> DataFrame:
    """Keep children whose parent survives.

    Children's keys alone are shuffled to meet the parents, of which a task looks up each key once. Where few of the keys have no parent, the children are
    compared with those where they lie; else the children meet the parents themselves.
    """
    keys = child.select(key).where(F.col(key).isNotNull())
    # Kept, so that there is one answer to how many they are.
    lost = stored(keys.join(parent.select(key).hint("shuffle_hash"), key, "left_anti").distinct(), "lost")
    if lost.count() <= few:
        return child.where(F.col(key).isNotNull()).join(F.broadcast(lost), key, "left_anti")
    return child.join(parent.select(key), key, "left_semi")


def drop_orphans(child: DataFrame, parent: DataFrame, key: str, carry: Sequence[str]) -> DataFrame:
    """Drop children without a parent; ``carry`` columns come from the parent, not the child."""
    return child.drop(*carry).join(parent.select(key, *carry), key)


# --- lookups and entities ---------------------------------------------------------------------

def standardise(df: DataFrame, column: str, lookup: DataFrame, lookup_key: str = "raw_key") -> DataFrame:
    """Replace a spelling by the lookup's columns; unknown spellings give NULL.

    A list of spellings is small, and the optimizer broadcasts it once it has seen that it is.
    """
    return (df.withColumn("_key", norm(column)).drop(column)
            .join(lookup.withColumnRenamed(lookup_key, "_key"), "_key", "left").drop("_key"))


def fill_from_parent(df: DataFrame, parent: DataFrame, key: str, spread_by: str,
                     columns: Sequence[str]) -> DataFrame:
    """Fill each missing column on its own from the parent row."""
    home = parent.select(key, *[F.col(c).alias(f"_home_{c}") for c in columns])
    joined = spread_join(df, home, key, spread_by, "left")
    return coalesce_with(joined, {c: f"_home_{c}" for c in columns})


def coalesce_with(df: DataFrame, fallbacks: Mapping[str, str]) -> DataFrame:
    """Fill columns from their fallback columns, which are dropped."""
    filled = {c: F.coalesce(c, other) for c, other in fallbacks.items()}
    return df.withColumns(filled).drop(*fallbacks.values())


def canonical_map(df: DataFrame, match: Column, order: Sequence[Column], key: str,
                  raw_name: str = "raw_id", name: str = "canonical_id") -> DataFrame:
    """Every account with the id of its person's first account. Unmatchable rows drop out.

    First means smallest by ``order``, unknown values last. Keys are taken off the rows once and
    kept, since they are narrow and the rows may not be (whole texts, say). Map tasks forward only
    their first account per match key, and the way back is a spread join, so a key that holds a
    large part of all accounts does not land on one task.
    """
    ranks = [f"_rank{i}" for i in range(len(order))]
    keyed = df.select(match.alias("_match"), F.col(key).alias(raw_name), *[c.alias(r) for c, r in zip(order, ranks)])
    accounts = stored(keyed.where(F.col("_match").isNotNull()), "accounts")
    first = first_within(accounts, ["_match"], [F.asc_nulls_last(r) for r in ranks])
    return (spread_join(accounts.drop(*ranks), first.select("_match", F.col(raw_name).alias("_first")), "_match", raw_name)
            .select(raw_name, F.col("_first").alias(name)))


def keep_canonical(df: DataFrame, id_map: DataFrame, key: str,
                   raw_name: str = "raw_id", name: str = "canonical_id") -> DataFrame:
    """Keep only the rows that stand for their person."""
    own = id_map.where(F.col(raw_name) == F.col(name)).select(F.col(raw_name).alias(key))
    return df.join(own, key, "left_semi")


def reattribute(child: DataFrame, id_map: DataFrame, key: str, spread_by: str,
                raw_name: str = "raw_id", name: str = "canonical_id") -> DataFrame:
    """Point children at the canonical parent; unmapped children keep theirs."""
    links = id_map.select(F.col(raw_name).alias(key), F.col(name).alias("_canonical"))
    joined = spread_join(child, links, key, spread_by, "left")
    return joined.withColumn(key, F.coalesce("_canonical", key)).drop("_canonical")


# --- values and flags -------------------------------------------------------------------------

def null_if_before(df: DataFrame, later: str, earlier: str, flag: str) -> DataFrame:
    """An event that precedes its cause loses its time and is flagged."""
    impossible = F.coalesce(F.col(later) < F.col(earlier), F.lit(False))
    return df.withColumns({flag: impossible, later: F.when(~impossible, F.col(later))})


def repair_magnitude(price: Column | str, reference: Column | str,
                     slips: Sequence[tuple[int, int]]) -> Column:
    """Undo extra zeros. ``slips`` lists (times above reference, divisor), largest first."""
    price, reference = as_col(price), as_col(reference)
    out = None
    for times, divisor in slips:
        above = price > reference * F.lit(times)
        repaired = F.round(price / F.lit(divisor), 2)
        out = F.when(above, repaired) if out is None else out.when(above, repaired)
    return out.otherwise(price).cast("decimal(14,2)")


def above_reference(price: Column | str, reference: Column | str, times: int) -> Column:
    return F.coalesce(as_col(price) > as_col(reference) * F.lit(times), F.lit(False))


def flag_below(column: Column | str, limit) -> Column:
    """True below the limit; NULL is false."""
    return F.coalesce(as_col(column) < F.lit(limit), F.lit(False))


def flag_before(column: Column | str, moment: dt.datetime) -> Column:
    """True before the moment; NULL is false."""
    # As text, because a datetime literal would be read in the driver's time zone.
    return F.coalesce(as_col(column) < F.lit(moment.isoformat(" ")).cast("timestamp_ntz"), F.lit(False))
