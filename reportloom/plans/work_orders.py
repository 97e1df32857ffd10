"""Work-order load: feed rows to table columns, ids, and the latest row per order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.functions.dates import week_end, week_start, week_text
from reportloom.operators.keys import with_load_id
from reportloom.operators.project import rename_fields, sentinel_to_null
from reportloom.sinks.files import Stored, store_latest
from reportloom.sources.feed import ORDER_FIELDS, read_feed


def normalised_orders(rows: DataFrame, now: datetime) -> DataFrame:
    """Table columns of feed rows. An order without an end date has no week."""
    df = sentinel_to_null(rename_fields(rows, ORDER_FIELDS))
    end = F.to_date(F.nullif(F.col("End_Date"), F.lit("")), "yyyy-MM-dd")
    return df.withColumns(
        {
            "week_date": F.coalesce(week_text(end), F.col("End_Date")),
            "week_start": week_start(end),
            "week_end": week_end(end),
            "timestamp": F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz"),
        }
    )


def order_batch(rows: DataFrame, now: datetime, *arrival: Column | str) -> DataFrame:
    """A batch ready to store: normalised rows with ids in the order of arrival.

    Ids come first: their range partitioning reads its input twice, so it gets the bare feed rows.
    """
    batch = normalised_orders(with_load_id(rows, *(arrival or ("__arrived", "__file", "__pos")), now=now), now)
    return batch.drop(*[c for c in batch.columns if c.startswith("__")])


def load_orders(spark: SparkSession, feed_path: str, table: str, now: datetime) -> Stored:
    """Store a landed feed in the table's next snapshot; later loads of an order replace earlier ones."""
    return store_latest(spark, table, order_batch(read_feed(spark, feed_path), now), "Order_Id", "id")
