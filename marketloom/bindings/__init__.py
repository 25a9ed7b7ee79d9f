"""The marketplace tables derived from a retail star schema, as SQL that Spark and DuckDB both run.

Only the derivation of inputs is shared between the two engines. What is done with the inputs is
written twice: with DataFrame operators here and as plain SQL in the reference answers.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def pick(index: str, values: Iterable[str | None]) -> str:
    """CASE that chooses one of the values by number."""
    def literal(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"

    arms = " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def padded(number: str, width: int) -> str:
    return f"LPAD(CAST({number} AS STRING), {width}, '0')"


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def base_tables(spark: SparkSession, folder: str, names: Iterable[str] = BASE_TABLES) -> dict[str, DataFrame]:
    return {t: base_table(spark, folder, t) for t in names}


def derive(spark: SparkSession, folder: str, template: str) -> DataFrame:
    """Run a derivation over the Parquet tables it names in braces."""
    used = [t for t in BASE_TABLES if "{" + t + "}" in template]
    return spark.sql(template, **base_tables(spark, folder, used))


def as_cte(template: str) -> str:
    """The same derivation over tables of those names."""
    for t in BASE_TABLES:
        template = template.replace("{" + t + "}", t)
    return template


def ctes(templates: Mapping[str, str], names: Iterable[str]) -> list[str]:
    return [f"{name} AS ({as_cte(templates[name])})" for name in names]
