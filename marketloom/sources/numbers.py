"""Running numbers that are kept from run to run, so that a new extract numbers only the days it changes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import file_system

#: The day of rows without a time, before all others.
NO_DAY = -(1 << 31)
_ROWS, _COUNTS, _DAYS, _RUN = "rows", "counts", "days", "run"


def day_of(time: Column | str) -> Column:
    """Days since 1970; rows without a time share a day of their own, which comes first."""
    return F.coalesce(F.unix_date(F.to_date(time)), F.lit(NO_DAY))


@dataclass(frozen=True)
class KeptNumbers:
    """D10 over many runs: numbers of each customer's orders in time, kept below one shared folder.

    A run stores, for the days it is given, each order's number within its customer's day and one count per customer and
    day. A number is the counts of the customer's earlier days plus the number within the day, so a day that changes,
    also in the middle, moves later numbers without touching later orders. Of a day that several runs hold, the last run counts.

    A run's list of days is written last; a run without one did not end and counts for nothing. Two runs must not be
    under way at once. Ties in time are broken by the order's id; orders without a time come first.
    """

    spark: SparkSession
    root: str
    customer: str = "customer_id"
    time: str = "ordered_at"
    order: str = "order_id"
    column: str = "customer_order_seq"

    def _path(self, part: str, run: int | None = None) -> str:
        return f"{self.root.rstrip('/')}/{part}" + ("" if run is None else f"/{_RUN}={run}")

    def runs(self) -> list[int]:
        """Runs that ended, in order."""
        files, home = file_system(self.spark, self._path(_DAYS))
        found = [f.getPath() for f in files.listStatus(home)] if files.exists(home) else []
        return sorted(int(p.getName().split("=")[1]) for p in found
                      if p.getName().startswith(f"{_RUN}=") and files.exists(file_system(self.spark, f"{p.toString()}/_SUCCESS")[1]))

    def update(self, orders: DataFrame, days: Iterable[dt.date | None] | None = None) -> None:
        """Number the orders of some days anew. ``orders`` holds all orders of these days.

        Without ``days`` these are the days that occur. With them only their orders are read, and a day without
        orders is emptied; ``None`` stands for orders without a time.
        """
        rows = orders.select(self.customer, self.time, self.order)
        if days is not None:
            rows = rows.where(self._on(list(days)))
        rows = rows.withColumn("day", day_of(self.time))
        within = Window.partitionBy(self.customer, "day").orderBy(F.asc_nulls_first(self.time), F.asc(self.order))
        numbered = rows.select(self.customer, self.order, "day", F.row_number().over(within).alias("within"))
        run = max(self.runs(), default=0) + 1
        self._write(_by_day(numbered), _ROWS, run)
        stored = self._read(_ROWS, [run], self._rows_schema(orders.schema))
        # The last number of a customer's day is its count.
        self._write(stored.groupBy(self.customer, "day").agg(F.max("within").alias("n")), _COUNTS, run)
        if days is None:
            listed = stored.select("day").distinct()
        else:
            listed = self.spark.createDataFrame([(_number(d),) for d in set(days)], "day int")
        self._write(listed.coalesce(1), _DAYS, run)

    def numbers(self, days: Iterable[dt.date | None] | None = None) -> DataFrame:
        """Customer, order and running number, of all orders or of those of some days.

        Only the wanted days' orders are read, with the small counts of these and earlier days.
        """
        runs = self.runs()
        if not runs:
            raise FileNotFoundError(f"no numbers are kept in {self.root}")
        schema = self.spark.read.parquet(self._path(_COUNTS, runs[-1])).schema
        order = self.spark.read.parquet(self._path(_ROWS)).schema[self.order]
        rows = self._read(_ROWS, runs, T.StructType([schema[self.customer], order, *_DAY_AND_WITHIN]))
        counts = self._read(_COUNTS, runs, schema)
        if days is not None:
            wanted = [_number(d) for d in set(days)]
            rows, counts = rows.where(F.col("day").isin(wanted)), counts.where(F.col("day") <= max(wanted, default=NO_DAY))
        # One row per day and run.
        latest = (self._read(_DAYS, runs, T.StructType([_DAY_AND_WITHIN[0]])).groupBy("day").agg(F.max(_RUN).alias(_RUN)))
        earlier = Window.partitionBy(self.customer).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
        before = (counts.join(latest, ["day", _RUN])
                  .select(F.col(self.customer).alias("_customer"), F.col("day").alias("_day"),
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")))
        return (rows.join(latest, ["day", _RUN])
                .join(before, F.col(self.customer).eqNullSafe(F.col("_customer")) & (F.col("day") == F.col("_day")))
                .select(self.customer, self.order, (F.col("_before") + F.col("within")).cast("int").alias(self.column)))

    def compact(self) -> None:
        """Turn all runs into one. What still reads the earlier ones must be done; numbers stay as they are."""
        runs = self.runs()
        if len(runs) < 2:
            return
        run = runs[-1] + 1
        counts = self.spark.read.parquet(self._path(_COUNTS, runs[-1])).schema
        order = self.spark.read.parquet(self._path(_ROWS)).schema[self.order]
        days = self._read(_DAYS, runs, T.StructType([_DAY_AND_WITHIN[0]]))
        latest = days.groupBy("day").agg(F.max(_RUN).alias(_RUN))
        for part, schema in ((_ROWS, T.StructType([counts[self.customer], order, *_DAY_AND_WITHIN])), (_COUNTS, counts)):
            self._write(_by_day(self._read(part, runs, schema).join(latest, ["day", _RUN]).drop(_RUN)), part, run)
        self._write(latest.select("day").coalesce(1), _DAYS, run)
        for old in runs:
            for part in (_DAYS, _COUNTS, _ROWS):
                files, path = file_system(self.spark, self._path(part, old))
                files.delete(path, True)

    def _on(self, days: list[dt.date | None]) -> Column:
        """Rows of these days, as ranges of the time itself, which reach the scan."""
        on = F.lit(False)
        for day in days:
            on = on | (F.col(self.time).isNull() if day is None else
                       (F.col(self.time) >= F.lit(day)) & (F.col(self.time) < F.lit(day + dt.timedelta(days=1))))
        return on

    def _rows_schema(self, given: T.StructType) -> T.StructType:
        return T.StructType([given[self.customer], given[self.order], *_DAY_AND_WITHIN])

    def _write(self, df: DataFrame, part: str, run: int) -> None:
        """A run that did not end may have left the folder; it is written over."""
        (df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
         .parquet(self._path(part, run)))

    def _read(self, part: str, runs: list[int], schema: T.StructType) -> DataFrame:
        """Rows of the given runs alone, with the run."""
        given = T.StructType([*schema.fields, T.StructField(_RUN, T.IntegerType())])
        return (self.spark.read.schema(given).option("basePath", self._path(part))
                .parquet(*[self._path(part, r) for r in runs]).select(*given.names))


_DAY_AND_WITHIN = (T.StructField("day", T.IntegerType()), T.StructField("within", T.IntegerType()))


def _by_day(df: DataFrame) -> DataFrame:
    """A day lies in one file, or in several if it is large, and days follow each other there: the files' statistics
    tell which parts hold a wanted day."""
    return df.hint("rebalance", F.col("day")).sortWithinPartitions("day")


def _number(day: dt.date | None) -> int:
    return NO_DAY if day is None else (day - dt.date(1970, 1, 1)).days
