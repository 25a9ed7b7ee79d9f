"""Sources, sinks and layers, on data derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.bindings import messy, star
from marketloom.plans import views
from marketloom.session import fresh_folder
from marketloom.sources.exports import export_view
from marketloom.sources.extracts import RAW_COLUMNS, load_raw, read_export, read_raw
from marketloom.sources.layers import Warehouse
from queries import analysis as a
from queries import query
from queries import sql as s
from queries.modelling import FACT_SELECT


def csv_extract(table):
    """An extract written as CSV text and read back; an empty field and a missing one are the same there."""
    def run(spark, folder):
        path = fresh_folder(spark, "extract")
        messy.extract(spark, folder, table).write.csv(
            path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"')
        return read_raw(spark, path, table)

    return run


for _table, _columns in RAW_COLUMNS.items():
    _source = messy.EXTRACTS[_table]
    _no_empty = ", ".join(f"NULLIF({c}, '') AS {c}" for c in _columns.split())
    query("csv_extract" if _table == "orders" else f"csv_extract_{_table}", "A1",
          s.on_raw(f"SELECT {_no_empty} FROM {_source}", _source))(csv_extract(_table))


# Names and cities as a form with several lines would hold them.
_BROKEN = """REPLACE(product_name, ' ', '\n"') || ',\n' AS product_name"""


def _written(df, mode="error", path=None):
    path = path or fresh_folder(df.sparkSession, "extract")
    df.write.mode(mode).csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"')
    return path


@query("csv_line_breaks", "A1", s.on_raw("SELECT product_id, " + _BROKEN.replace("\n", "' || CHR(10) || '") +
                                         ", list_price FROM raw_products", "raw_products"))
def _(spark, folder):
    """Values with line breaks, quotes and commas, from an extract that is read in parts."""
    products = messy.extract(spark, folder, "products")
    broken = products.withColumn("product_name", F.concat(F.replace("product_name", F.lit(" "), F.lit('\n"')), F.lit(",\n")))
    return load_raw(spark, _written(broken), "products").rows.select("product_id", "product_name", "list_price")


@query("csv_set_aside", "A1", s.on_raw("""
    SELECT 'header' AS reason, order_id || ',' || courier AS record, CAST(COUNT(*) AS BIGINT) AS n FROM raw_orders
    WHERE courier = 'PakRider' GROUP BY ALL
    UNION ALL SELECT 'fits', courier, COUNT(*) FROM raw_orders GROUP BY ALL""", "raw_orders"))
def _(spark, folder):
    """A file of another layout among the parts of an extract: its records are set aside, all others load."""
    orders = messy.extract(spark, folder, "orders")
    path = _written(orders)
    _written(orders.where("courier = 'PakRider'").select("order_id", "courier"), "append", path)
    loaded = load_raw(spark, path, "orders")
    aside = loaded.unfit.where("record <> 'order_id,courier'").groupBy("reason", "record").agg(F.count(F.lit(1)).alias("n"))
    return aside.unionByName(loaded.rows.groupBy(F.lit("fits").alias("reason"), F.col("courier").alias("record"))
                             .agg(F.count(F.lit(1)).alias("n")))


@query("stored_layer", "A3 A4", s.on_fact(FACT_SELECT))
def _(spark, folder):
    root = fresh_folder(spark, "warehouse")
    house = Warehouse(spark, root, prefix=f"w{root[-12:]}_")
    house.ensure_layers()
    fact = star.numbered_facts(spark, folder)
    return house.write_layer(fact, "mart", "fact_orders", partition_by=["order_month"]).select(*fact.columns)


@query("registered_view", "A5", s.on_fact("SELECT * FROM mix", a.MIX))
def _(spark, folder):
    Warehouse(spark, "").register_views({"payment_mix": views.payment_mix(star.facts(spark, folder))})
    return spark.sql("SELECT * FROM v_payment_mix")


@query("saved_view", "A5", s.on_fact("SELECT * FROM mix", a.MIX))
def _(spark, folder):
    """A view stored by one warehouse and loaded by another on the same root."""
    root = fresh_folder(spark, "views")
    house = Warehouse(spark, root, prefix=f"v{root[-12:]}_")
    house.ensure_layers()
    house.save_views({"payment_mix": views.payment_mix(star.facts(spark, folder))})
    return Warehouse(spark, root).load_views(["payment_mix"])["payment_mix"]


@query("exported_view", "A6 A8", s.on_fact("SELECT * FROM card", a.CARD))
def _(spark, folder):
    card = views.courier_scorecard(star.facts(spark, folder))
    exports = fresh_folder(spark, "exports")
    export_view(card, exports, "courier_scorecard")
    return read_export(spark, exports, "courier_scorecard", card.schema)
