"""Extracts, layers, exports and the whole run."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from marketloom.bindings import messy
from marketloom.operators.quality import QualityGateError
from marketloom.plans.rebuild import rebuild
from marketloom.session import discard, durable_root, fresh_folder, mark
from marketloom.sources.exports import export_view
from marketloom.sources.extracts import RAW_COLUMNS, MissingExportError, read_export, read_raw
from marketloom.sources.layers import LayerClashError, Warehouse
from queries import load_all

HEADER = "seller_id,seller_name,seller_city,joined_date,seller_type"


def test_extract_quoting_blanks_and_line_ends(spark, tmp_path, rows):
    path = tmp_path / "sellers.csv"
    path.write_bytes((HEADER + '\r\nS1,"Ravi, Sons ""Ltd""",Lahore ,,Official Store\r\nS2,Ünal," ","",x\r\n').encode())
    assert rows(read_raw(spark, str(path), "sellers")) == [
        ("S1", 'Ravi, Sons "Ltd"', "Lahore ", None, "Official Store"), ("S2", "Ünal", " ", None, "x")]


def test_extract_with_a_broken_row_stops(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text(HEADER + "\nS1,a,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw(spark, str(path), "sellers").collect()


def test_missing_export(spark, tmp_path):
    with pytest.raises(MissingExportError, match="nothing"):
        read_export(spark, str(tmp_path), "nothing", spark.range(1).schema)


def _bytes(folder):
    parts = [p for sub in ("_header", ".") if (folder / sub).is_dir() for p in sorted((folder / sub).glob("part-*"))]
    return b"".join(p.read_bytes() for p in parts), len(parts)


@pytest.mark.parametrize("in_parts", [False, True])
def test_exports_are_byte_stable(spark, tmp_path, in_parts):
    df = spark.createDataFrame([(3, "c", True), (1, None, None), (2, " b,", False)] * 50, "a int, b string, c boolean")
    keep = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(keep, "false")  # small results then come in several parts, as large ones would
    try:
        one = export_view(df.repartition(7), str(tmp_path), "one", in_parts)
        two = export_view(df.repartition(3), str(tmp_path), "two", in_parts)
    finally:
        spark.conf.set(keep, "true")
    (first, parts), (second, _) = _bytes(tmp_path / "one"), _bytes(tmp_path / "two")
    assert first == second and (parts > 2 if in_parts else parts == 1) and one != two
    lines = first.decode().splitlines()
    assert lines[:2] == ["a,b,c", "1,,"] and len(lines) == 151
    back = read_export(spark, str(tmp_path), "one", df.selectExpr("a", "b", "cast(c as int) c").schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted([(3, "c", 1), (1, None, None), (2, " b,", 0)] * 50, key=str)


def test_durable_root_is_the_named_folder(spark):
    assert durable_root(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.fixture(scope="module")
def built(spark, sf_dir, tmp_path_factory):
    """The whole run from CSV files written from the derived extracts."""
    raw, out = (str(tmp_path_factory.mktemp(n)) for n in ("raw", "out"))
    for name, df in messy.extracts(spark, sf_dir).items():
        df.write.csv(f"{raw}/{name}.csv", header=True, escape='"',
                     ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return out, rebuild(spark, raw, out, messy.RULES, prefix="t_", strict=False)


def test_rebuild_exports_everything(built):
    out, result = built
    exported = set(os.listdir(f"{out}/exports"))
    assert set(result.views) <= exported and len(result.views) == 19
    assert {"profile_data_quality_scorecard", "profile_city_spellings", "profile_label_inventory", "quality_checks",
            "ab_test_results"} <= exported


def test_rebuild_totals(built):
    _, result = built
    head = result.views["headline_kpis"].first()
    assert head.orders == result.fact.count() > 0
    assert result.dim.agg({"orders": "sum"}).first()[0] <= head.orders
    assert result.checks.count() == 18


def test_catalog_lists_layers_in_order(spark, built):
    out, _ = built
    listed = Warehouse(spark, f"{out}/warehouse", "t_").list_objects()
    got = [(r.layer, r.object_name) for r in listed.collect()]
    assert [o for layer, o in got if layer == "raw"] == sorted(RAW_COLUMNS)
    assert [o for layer, o in got if layer == "mart"][:2] == ["dim_customers", "fact_orders"]
    assert ("mart", "v_headline_kpis") in got
    assert [layer for layer, _ in got] == sorted((layer for layer, _ in got), key=["raw", "clean", "mart"].index)


def test_failed_check_raises_after_exports(spark, sf_dir, tmp_path):
    with pytest.raises(QualityGateError):
        rebuild(spark, messy.extracts(spark, sf_dir), str(tmp_path), dataclasses.replace(messy.RULES), prefix="f_")
    assert "headline_kpis" in os.listdir(tmp_path / "exports")


def test_layer_is_replaced(spark, rows):
    house = Warehouse(spark, fresh_folder(spark, "layer"), "r_")
    house.ensure_layers()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    house.write_layer(df, "mart", "t", ["p"])
    again = house.write_layer(df.where("n = 2"), "mart", "t", ["p"])
    assert rows(again) == [(2, "b")]


def test_failed_write_leaves_the_table(spark, tmp_path, rows):
    """A write that fails halfway, a table replaced by a query over itself, and readers of the version before."""
    house = Warehouse(spark, str(tmp_path), "safe_")
    house.ensure_layers()
    first = house.write_layer(spark.range(0, 100, 1, 4), "mart", "t")
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception, match="broken"):
        house.write_layer(bad, "mart", "t")
    assert first.count() == spark.table("safe_mart.t").count() == house.read_layer("mart", "t").count() == 100
    doubled = house.write_layer(spark.table("safe_mart.t").selectExpr("id * 2 as id", "'x' as more"), "mart", "t")
    assert doubled.agg(F.sum("id")).first()[0] == spark.sql("SELECT SUM(id) FROM safe_mart.t").first()[0] == 9900
    assert first.count() == 100 and spark.table("safe_mart.t").columns == ["id", "more"]
    house.write_layer(spark.range(3), "mart", "t")
    assert len(os.listdir(tmp_path / "mart" / "t")) == 2 and spark.table("safe_mart.t").count() == 3  # one version before stays


def test_partition_values_keep_their_type(spark, tmp_path, rows):
    house = Warehouse(spark, str(tmp_path), "typed_")
    house.ensure_layers()
    df = spark.sql("SELECT * FROM VALUES (1, '007', DATE '2024-01-01'), (2, NULL, NULL), (3, '', DATE '2024-01-02') AS t(n, p, d)")
    stored = house.write_layer(df, "clean", "t", ["p", "d"])
    want = sorted(rows(df), key=str)
    assert sorted(rows(stored, "n", "p", "d"), key=str) == sorted(rows(spark.table("typed_clean.t")), key=str) == want
    assert spark.table("typed_clean.t").dtypes == df.dtypes
    assert sorted(rows(house.read_layer("clean", "t").select("n", "p", "d")), key=str) == want
    none = house.write_layer(df.limit(0), "clean", "t", ["p", "d"])
    assert none.count() == spark.table("typed_clean.t").count() == 0 and spark.table("typed_clean.t").dtypes == df.dtypes


def test_two_warehouses_keep_apart(spark, tmp_path, rows):
    one, two = (Warehouse(spark, str(tmp_path / n), f"{n}_") for n in ("one", "two"))
    for house, n in ((one, 1), (two, 2)):
        house.ensure_layers()
        house.write_layer(spark.range(n), "mart", "t")
        house.ensure_layers()
    assert [Warehouse(spark, str(tmp_path / n)).read_layer("mart", "t").count() for n in ("one", "two")] == [1, 2]
    assert [spark.table(f"{n}_mart.t").count() for n in ("one", "two")] == [1, 2]
    with pytest.raises(LayerClashError):
        Warehouse(spark, str(tmp_path / "three"), "one_").ensure_layers()
    # even without asking, a table lands below the root it was given
    Warehouse(spark, str(tmp_path / "four"), "one_").write_layer(spark.range(4), "mart", "u")
    assert Warehouse(spark, str(tmp_path / "four")).read_layer("mart", "u").count() == 4


def test_views_come_back_in_a_later_session(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), "later_")
    house.ensure_layers()
    house.save_views({"some": spark.range(3)})
    spark.catalog.dropTempView("v_some")
    other = Warehouse(spark.newSession(), str(tmp_path), "later_")
    other.load_views(["some"])
    assert other.spark.sql("SELECT SUM(id) FROM v_some").first()[0] == 3


def test_nothing_is_left_behind(spark, sf_dir, tmp_path):
    root = durable_root(spark)
    os.makedirs(root, exist_ok=True)
    before, databases = set(os.listdir(root)), len(spark.catalog.listDatabases())
    done = rebuild(spark, messy.extracts(spark, sf_dir), str(tmp_path / "out"), messy.RULES, prefix="left_", strict=False)
    assert set(os.listdir(root)) == before and len(spark.catalog.listDatabases()) == databases + 3
    assert done.views["rfm"].count() > 0  # results do not depend on what was deleted
    at = mark()
    load_all()["rfm"].run(spark, sf_dir).count()
    assert len(os.listdir(root)) > len(before)
    discard(spark, at)
    assert set(os.listdir(root)) == before
