"""Places, row numbers and equal-size buckets over orders that no single task could hold.

For places, rows are range-sorted over all tasks, each keeps its place in that sort on shared storage, and
places turn into numbers by adding up the sizes of the sort partitions before it (one small row per
partition). Buckets need no sort: ``borders`` finds the rows at which they start.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators.borders import at_or_after, rows_at
from marketloom.session import run_at_once, stored

# monotonically_increasing_id puts the partition number above bit 33 and the place below.
_PLACE_BITS = 33


def global_positions(df: DataFrame, order: Sequence[Column], column: str) -> DataFrame:
    """0-based place of every row in the total order. ``order`` must leave no ties.

    Hand in only the columns that are needed: they are all sorted and stored.
    """
    placed = stored(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "places")
    placed = placed.withColumn("_part", F.shiftright("_slot", _PLACE_BITS))
    # One row per sort partition, so spark.sql.shuffle.partitions bounds both window and broadcast.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(column, F.col("_before") + F.col("_slot").bitwiseAND((1 << _PLACE_BITS) - 1))
            .drop("_slot", "_part", "_before"))


def first_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of every group. Each map task keeps only n rows per group before the shuffle."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def number_in_steps(df: DataFrame, group: Sequence[str], step: Column, order: Sequence[Column], column: str) -> DataFrame:
    """1-based row number of each row in its group, where a group may be large but a group's step is not.

    ``step`` (a day, say) must never fall along ``order``; NULL comes first in both, and rows of one
    step are numbered in one task. Earlier steps add their row counts, one small row per group and step.
    ``order`` must leave no ties.
    """
    stepped = df.withColumn("_step", step)
    keys = [*group, "_step"]
    counts = stepped.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy(F.asc_nulls_first("_step")).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(k).alias(f"_own{i}") for i, k in enumerate(keys)],
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_own{i}"))
    return (stepped.withColumn("_within", within).join(before, same)
            .select(*df.columns, (F.col("_before") + F.col("_within")).cast("int").alias(column)))


def bucket_of(position: Column, rows: Column | int, buckets: int) -> Column:
    """NTILE of a 0-based position: the first ``rows % buckets`` buckets hold one row more."""
    rows = F.lit(rows) if isinstance(rows, int) else rows
    small = F.floor(rows / buckets)
    extra = rows % buckets
    in_large = extra * (small + 1)
    large_bucket = F.floor(position / (small + 1))
    small_bucket = extra + F.floor((position - in_large) / F.greatest(small, F.lit(1)))
    return (F.when(position < in_large, large_bucket).otherwise(small_bucket) + 1).cast("int")


def bucket_starts(rows: int, buckets: int) -> list[int]:
    """0-based place of the first row of each bucket but the first; buckets without a row start beyond the last."""
    small, extra = divmod(rows, buckets)
    return [b * small + min(b, extra) for b in range(1, buckets)]


def ntile_scores(df: DataFrame, key: str, scores: Mapping[str, Sequence[str]], buckets: int, **tuning: int) -> DataFrame:
    """One NTILE column per entry of ``scores``, each over the whole table in its own order.

    ``key`` tells rows apart (one of them may be NULL) and breaks ties upwards. An order lists columns, each
    after "-" if it falls. Only the rows at which buckets start are looked for (``tuning`` goes to that); every
    row is then compared with them, so no row is sorted, shuffled or joined.
    """
    base = stored(df, "scored")
    starts = bucket_starts(base.count(), buckets)
    orders = {name: [*order, key] for name, order in scores.items()}
    firsts = run_at_once(lambda order: rows_at(base, order, starts, **tuning), orders.values())
    columns = {}
    for (name, order), found in zip(orders.items(), firsts):
        passed = [at_or_after(base, order, row).cast("int") for row in found.values()]
        columns[name] = sum(passed, F.lit(1))
    return base.withColumns(columns)
