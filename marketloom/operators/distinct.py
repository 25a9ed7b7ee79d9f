"""Exact distinct counts by bitmaps, which add up: months to quarters, runs to a year, without the rows.

A bitmap holds 32,768 whole-number ids of one bucket in 4 KB. Map tasks set the bits of their rows and send bitmaps,
no ids; bitmaps of one bucket are OR-ed, whoever made them. This suits ids that are given out in a row, as keys of
a dimension are: a bucket then is full, one bit an id. Where a task meets few ids of each bucket, distinct ids are the
smaller thing to send. Text goes through a dictionary that numbers its values without gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.ranking import global_positions
from marketloom.operators.skew import spread_join

BUCKET, BITS = "id_bucket", "id_bits"


def dictionary(df: DataFrame, text: str, number: str) -> DataFrame:
    """Every value of a column but NULL, once, with a number from 0 on and no gaps."""
    values = df.select(text).where(F.col(text).isNotNull()).distinct()
    return global_positions(values, [F.asc(text)], number)


def extended(known: DataFrame, df: DataFrame, text: str, number: str) -> DataFrame:
    """A dictionary with the new values of ``df`` after those it has, so that numbers in stored bitmaps stay right."""
    new = dictionary(df.select(text).distinct().join(known, text, "left_anti"), text, number)
    first = known.agg(F.coalesce(F.max(number) + 1, F.lit(0))).first()[0]
    return known.unionByName(new.withColumn(number, F.col(number) + first))


def numbered_by(df: DataFrame, known: DataFrame, text: str, spread_by: str) -> DataFrame:
    """``df`` with the dictionary's number; NULL where the text is NULL or not in it. A text may be that of many rows;
    ``spread_by`` tells rows without one apart."""
    return spread_join(df, known, text, spread_by, "left")


def bitmaps(df: DataFrame, ids: str, by: Sequence[str]) -> DataFrame:
    """``by``, bucket, bits: the ids of each group. NULL is no id; a group of NULLs alone has an empty bitmap.

    Ids are whole numbers, negative ones included.
    """
    value = F.col(ids).cast("bigint")
    return (df.groupBy(*by, F.bitmap_bucket_number(value).alias(BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias(BITS)))


def merged(maps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several tables put together."""
    return maps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(maps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """The number of different ids of each group; without groups one row, also for no bitmaps."""
    once = merged(maps, by).select(*by, F.bitmap_count(BITS).alias("_n"))
    return once.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))
