"""Daily totals kept up to date: partial sums per day, to which each batch of facts adds its own.

Sums of parts are sums of the whole, so a batch writes one small row per fact, day, group and category that it touches: a new day, or late
corrections of earlier ones (as further rows, negative ones too). Days that it does not touch are neither read nor written. The report
reads the partials of its 14 days instead of the facts. A batch has a name; sent again, it replaces its own partials. When the product
table changes, or rows have to go that nobody cancelled, a day is counted anew from its facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.functions.dates import in_last_days
from reportloom.operators.rollup import three_levels
from reportloom.plans.operations_daily import DAYS, MEASURES, daily_totals, without_left_out

KEYS = ["fact", "Date", "Business_Group", "product_categories"]
RECOUNTED = "recounted"


def add_batch(facts: Mapping[str, DataFrame], products: DataFrame, groups: Sequence[str], folder: str, batch: str) -> None:
    """Add the partial sums of new facts; `facts` is as for `trade_totals`, of any days."""
    partials = daily_totals(facts, products, groups).withColumn("batch", F.lit(batch))
    writer = partials.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("Date", "batch").parquet(folder)


def recount_day(facts: Mapping[str, DataFrame], products: DataFrame, groups: Sequence[str], folder: str, day: date) -> None:
    """Replace all partials of a day by the sums of its facts, which are all the facts of that day."""
    own = {name: df.where(F.col("Date").cast("date") == F.lit(day)) for name, df in facts.items()}
    partials = daily_totals(own, products, groups).drop("Date").withColumn("batch", F.lit(RECOUNTED))
    partials.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(f"{folder.rstrip('/')}/Date={day:%Y-%m-%d}")


def kept_totals(spark: SparkSession, folder: str, as_of: date, left_out_of_backlog: str) -> DataFrame:
    """`trade_totals` from the partials of the last days; the folders of other days are not listed for the scan."""
    partials = spark.read.option("basePath", folder).parquet(folder)
    recent = partials.where(in_last_days(F.col("Date"), as_of, DAYS))
    kinds = {f.name: f.dataType for f in partials.schema}
    daily = recent.groupBy(*KEYS).agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in MEASURES])
    return three_levels(without_left_out(daily, left_out_of_backlog), "Date", "Business_Group", "product_categories", MEASURES, within=["fact"])
