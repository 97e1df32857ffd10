"""Work-order feed: landed JSON payloads whose `DATA` is one object or a list of objects."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.operators.joins import in_use
from reportloom.sources.structure import order_texts

# Fixed values of the feed: field codes in payload order and the names they are stored under.
ORDER_FIELDS = {
    "AUFNR": "Order_Id",
    "MATNR": "Product_Code",
    "MAKTX": "Product_Name",
    "ZSPEC": "Product_Specification",
    "ZMODEL": "model",
    "DISPO": "MRP_Control",
    "GAMNG": "Product_Qty",
    "GWEMG": "In_Qty",
    "GSTRP": "Start_Date",
    "GLTRP": "End_Date",
    "FTRMI": "Approve_Date",
    "GETRI": "In_Date",
    "GASTAT": "Product_Status",
    "GWSTAT": "In_Status",
    "OVERDUE": "Overdue",
    "ZBRAND": "Business_Group",
    "AEDAT": "Sap_timestamp",
    "AUART": "Order_Type",
}


def _order_schema(fields: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">"


def _orders_schema(fields: Sequence[str]) -> str:
    return f"array<{_order_schema(fields)}>"


def feed_rows(payloads: DataFrame, data: str = "DATA", fields: Sequence[str] = tuple(ORDER_FIELDS)) -> DataFrame:
    """Rows of payload texts with their place in the payload (`__pos`); other columns are carried along.

    A payload without data, such as an error reply, is an error.
    """
    given = F.coalesce(F.col(data), F.raise_error(F.lit(f"a payload has no {data}")).cast("string"))
    parsed = F.from_json(given, _orders_schema(fields), {"mode": "FAILFAST"})
    others = [c for c in payloads.columns if c != data]
    rows = payloads.select(*others, F.posexplode(parsed).alias("__pos", "__order"))
    return rows.select(*others, "__pos", "__order.*")


def read_feed(spark: SparkSession, path: str, fields: Sequence[str] = tuple(ORDER_FIELDS)) -> DataFrame:
    """Orders of landed payload files, one JSON document each; `__arrived`, `__file` and `__pos` give the order of arrival.

    A document may be of any size: byte ranges of it are read by different tasks (`sources.structure`). An entry that is no object is an error.
    """
    rows = order_texts(spark, path)
    parsed = F.from_json("__orders", _orders_schema(fields), {"mode": "FAILFAST"})
    order = F.when(F.size(parsed) == 1, parsed[0])
    orders = rows.select("__arrived", "__file", "__pos", F.coalesce(order, F.raise_error(F.lit("an order is no object")).cast(_order_schema(fields))).alias("__order"))
    return orders.select("__arrived", "__file", "__pos", "__order.*")


def read_small_feed(spark: SparkSession, path: str, fields: Sequence[str] = tuple(ORDER_FIELDS)) -> DataFrame:
    """`read_feed` for documents that fit a task: each is one text, and nothing is shuffled or stored."""
    payloads = (
        spark.read.schema("DATA string")
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
        .select(F.col("_metadata.file_modification_time").alias("__arrived"), F.col("_metadata.file_path").alias("__file"), "DATA")
    )
    return feed_rows(payloads, fields=fields)


def limit_feed(
    rows: DataFrame,
    day: str,
    date_from: date | str,
    date_to: date | str,
    key: str = "AUFNR",
    orders: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """Rows with `day` in a closed range and, if given, with an order id from a short list or a frame."""
    out = rows.where(F.col(day).between(F.lit(date_from), F.lit(date_to)))
    if orders is None or (not isinstance(orders, DataFrame) and not orders):
        return out
    if isinstance(orders, DataFrame):
        return in_use(out, orders, key)
    return out.where(F.col(key).isin(list(orders)))
