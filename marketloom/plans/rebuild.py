"""The whole run: extracts to exports."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketloom.operators.quality import gate
from marketloom.plans import checks, clean_layer, mart, profile, reports, views
from marketloom.rules import DEFAULT_RULES, Rules
from marketloom.session import discard, mark, run_at_once
from marketloom.sources.exports import export_view, export_views
from marketloom.sources.extracts import load_extracts, read_extracts
from marketloom.sources.layers import Warehouse


@dataclass(frozen=True)
class Rebuilt:
    clean: dict[str, DataFrame]
    fact: DataFrame
    dim: DataFrame
    views: dict[str, DataFrame]
    checks: DataFrame


def rebuild(spark: SparkSession, raw: str | Mapping[str, DataFrame], out: str, rules: Rules = DEFAULT_RULES,
            prefix: str = "", strict: bool = True, set_aside: bool = False) -> Rebuilt:
    """Profile, clean, model, analyse, check and export.

    ``raw`` is a folder of extracts or the extracts themselves. Each layer is stored, so later
    steps read Parquet instead of repeating earlier ones, and a lost executor repeats one step at
    most. Views are stored in the mart, and what was kept on the way is deleted at the end. Exports are
    written before the gate, so a failed run can be looked into. With ``set_aside`` records of the extracts that do not
    fit their columns become the table ``unfit_records`` of the raw layer; else one of them stops the run.
    """
    before = mark()
    house = Warehouse(spark, f"{out.rstrip('/')}/warehouse", prefix)
    house.ensure_layers()
    exports = f"{out.rstrip('/')}/exports"
    if set_aside and isinstance(raw, str):
        read, unfit = load_extracts(spark, raw)
        house.write_layer(unfit, "raw", "unfit_records")
    else:
        read = read_extracts(spark, raw) if isinstance(raw, str) else raw
    stored = dict(zip(read, run_at_once(lambda item: house.write_layer(item[1], "raw", item[0]), read.items())))

    export_views(profile.build(stored, rules), exports)

    clean = clean_layer.build(stored, rules, keep=lambda name, df: house.write_layer(df, "clean", name))
    fact = house.write_layer(
        mart.fact_orders(clean["orders"], clean["order_items"], clean["returns"], clean["products"]),
        "mart", "fact_orders", partition_by=["order_month"])
    dim = house.write_layer(mart.dim_customers(clean["customers"], fact, rules), "mart", "dim_customers")

    results = house.save_views(views.build(clean, fact, dim, rules))
    checked = house.write_layer(checks.build(clean, fact, rules), "mart", "quality_checks")
    discard(spark, before)

    export_view(checked, exports, "quality_checks")
    export_views(results, exports, in_parts=views.PER_CUSTOMER)
    export_view(reports.ab_results(results["ab_test"]), exports, "ab_test_results")
    if strict:
        gate(checked)
    return Rebuilt(clean, fact, dim, results, checked)
