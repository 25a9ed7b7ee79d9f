"""Text extracts and exported results."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.sources.exports import HEADER
from marketloom.sources.records import Loaded, load

# Columns of the seven extracts, all text.
RAW_COLUMNS = {
    "customers": "customer_id email signup_date city acquisition_channel device_type",
    "sellers": "seller_id seller_name seller_city joined_date seller_type",
    "products": "product_id product_name category subcategory brand seller_id list_price unit_cost",
    "orders": "order_id customer_id order_datetime shipping_city payment_method promo_code courier "
              "promised_delivery_date delivered_at order_status shipping_fee",
    "order_items": "order_item_id order_id product_id quantity unit_price discount_pct",
    "returns": "return_id order_item_id order_id return_reason return_requested_date refund_amount",
    "checkout_sessions": "session_id customer_id session_start device_type traffic_source experiment_group "
                         "session_duration_sec completed_order order_value",
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table].split()])


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A1: one extract as text; a row that does not fit the columns stops the load.

    ``path`` is a file or a folder of files, so a large extract may come in parts. Spaces around
    values are kept, since profiling counts them as spellings.
    """
    return spark.read.csv(path, schema=raw_schema(table), header=True, quote='"', escape='"', encoding="UTF-8",
                          mode="FAILFAST", enforceSchema=False)


def load_raw(spark: SparkSession, path: str, table: str, strict: bool = False) -> Loaded:
    """A1 with records rather than lines: quoted values may hold line breaks, and what does not fit is set aside.

    ``strict`` raises instead. Values are those of ``read_raw``.
    """
    return load(spark, path, raw_schema(table), strict)


def load_extracts(spark: SparkSession, folder: str, suffix: str = ".csv") -> tuple[dict[str, DataFrame], DataFrame]:
    """All extracts, and the records of all of them that do not fit: extract, file, reason, record."""
    loaded = {t: load_raw(spark, f"{folder.rstrip('/')}/{t}{suffix}", t) for t in RAW_COLUMNS}
    unfit = [found.unfit.select(F.lit(t).alias("extract"), "*") for t, found in loaded.items()]
    return {t: found.rows for t, found in loaded.items()}, reduce(DataFrame.unionByName, unfit)


def read_extracts(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, DataFrame]:
    return {t: read_raw(spark, f"{folder.rstrip('/')}/{t}{suffix}", t) for t in RAW_COLUMNS}


class MissingExportError(FileNotFoundError):
    """The asked-for result has not been exported."""


def read_export(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """An exported result, in one file or in parts, with its known types."""
    path = f"{folder.rstrip('/')}/{name}"
    try:
        spark.read.text(path)
    except AnalysisException as missing:
        raise MissingExportError(f"{name} is not in {folder}; run the rebuild first") from missing
    try:
        spark.read.text(f"{path}/{HEADER}")
        in_parts = True
    except AnalysisException:
        in_parts = False
    return spark.read.csv(path, schema=schema, header=not in_parts, escape='"', mode="FAILFAST")
