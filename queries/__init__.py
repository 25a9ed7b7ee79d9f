"""Every operator as a query over the given tables, beside the same answer in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    covers: str
    sql: str | None


REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: exact sums as double, every integer as bigint."""
    def cast(field):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*[cast(f) for f in df.schema])


def query(name: str, covers: str, sql: str | None = None):
    """Register a query, the survey lines it covers, and its answer in SQL."""
    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(lambda spark, folder: portable(run(spark, folder)), covers, sql)
        return run

    return register


def load_all() -> dict[str, Query]:
    from queries import analysis, cleaning, experiment, modelling, profiling, reports, storage  # noqa: F401

    return REGISTRY
