"""Shelf life of factory stock: expired lots and lots close to expiry, most urgent first."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.functions.dates import whole_days_left
from reportloom.functions.predicates import differs_or_null, lot_open
from reportloom.functions.text import expiry_style
from reportloom.operators.joins import not_in_use, snowflake
from reportloom.operators.ordering import urgency_order
from reportloom.plans.settings import WORK_CENTRES


def stock_lots(
    inventory: DataFrame,
    products: DataFrame,
    roots: DataFrame,
    centres: DataFrame,
    cells: DataFrame,
    factories: DataFrame,
    factory: str,
    work_centres: Sequence[str] = WORK_CENTRES,
    strict_status: bool = False,
) -> DataFrame:
    """Lots of one factory's work centres with the names of product, centre, cell and factory."""
    lots = inventory.where(
        differs_or_null(F.col("IsIssueToPickingList"), 1)
        & lot_open(F.col("LotStatus"), strict_status)
        & (F.col("Qty") > 0)
        & F.col("EntryDate").isNotNull()
    )
    wide = snowflake(
        lots,
        (products.select("ProductId", "ProductRootId", "ProductDescription", "ProductDescription_1", "VALIDITY", "MINVALIDITY"), "ProductId"),
        (roots.select("ProductRootId", "ProductName", F.col("WorkcenterName").alias("root_centre")), "ProductRootId"),
        (centres.select("WorkcenterId", "WorkcenterName", "WorkcenterDescription"), "WorkcenterId"),
        (cells.select("CellId", "CellName"), "CellId"),
        (factories.select("FactoryId", "FactoryName"), "FactoryId"),
    )
    return wide.where(
        F.col("MINVALIDITY").isNotNull()
        & F.col("root_centre").isNotNull()
        & F.col("WorkcenterDescription").contains(factory)
        & F.col("WorkcenterName").isin(list(work_centres))
    ).select(
        F.col("ProductName").alias("product_code"),
        F.col("ProductDescription").alias("product_name"),
        F.col("ProductDescription_1").alias("specs"),
        "WorkcenterName",
        "WorkcenterDescription",
        "CellName",
        "Qty",
        "FactoryName",
        "EntryDate",
        F.col("VALIDITY").alias("material_validity_period"),
        F.col("MINVALIDITY").alias("remaining_validity_period"),
        "LotSN",
    )


def expiring_lots(lots: DataFrame, now: datetime, parts_in_use: DataFrame | None = None) -> DataFrame:
    """Lots at or below their warning life; with `parts_in_use` only those of parts no longer used."""
    left = whole_days_left(F.col("material_validity_period"), F.col("EntryDate"), now)
    warned = lots.withColumn("days_until_expiration", left).where(
        F.col("days_until_expiration") <= F.col("remaining_validity_period")
    )
    if parts_in_use is not None:
        warned = not_in_use(warned, parts_in_use, "product_code")
    return warned.drop("remaining_validity_period").withColumns(
        {"days_style": expiry_style(F.col("days_until_expiration"))}
    )


def shelf_life_report(lots: DataFrame, now: datetime, parts_in_use: DataFrame | None = None) -> DataFrame:
    """Report rows in urgency order with `EntryDate` as text and the header values.

    Product, entry and lot spread the sort over all tasks when many lots share a remaining life.
    """
    ordered = expiring_lots(lots, now, parts_in_use).orderBy(
        *urgency_order(F.col("days_until_expiration")),
        F.col("product_code").desc_nulls_last(),
        F.col("EntryDate").desc_nulls_last(),
        F.col("LotSN").asc_nulls_last(),
    )
    return ordered.withColumns(
        {
            "EntryDate": F.date_format("EntryDate", "yyyy-MM-dd"),
            "data_time": F.lit(f"{now:%Y-%m-%d} 08:00:00"),
            "report_date": F.lit(f"{now:%Y-%m-%d}"),
        }
    )


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def bom_view(heads: DataFrame, items: DataFrame, plant: int = 1001) -> DataFrame:
    """Active heads of bills of materials and active items, without repeated rows."""
    uses = items.select(F.col("IDNRK").alias("MATNR"), F.col("parent_id").alias("PARENT_ID"), F.col("DUMPS").alias("V_STATUS"))
    active_heads = heads.where((F.col("WERKS") == plant) & _blank("LOEKZ") & (F.col("STLST") != 3))
    as_heads = active_heads.join(uses, "MATNR", "left")
    active_items = items.where((F.col("WERKS") == plant) & _blank("DUMPS"))
    as_items = active_items.select(
        "WERKS", F.col("IDNRK").alias("MATNR"), F.col("parent_id").alias("PARENT_ID"), F.col("DUMPS").alias("V_STATUS")
    ).join(heads.select("self_id", "WERKS", "MATNR", "LOEKZ", "STLST"), ["MATNR", "WERKS"], "left")
    columns = ["self_id", "WERKS", "MATNR", "PARENT_ID", "LOEKZ", "STLST", "V_STATUS"]
    both = as_heads.select(*columns).union(as_items.select(*columns)).distinct()
    return both.withColumnsRenamed({"self_id": "ID", "LOEKZ": "MARK", "STLST": "STATUS"})


def parts_in_bom(heads: DataFrame, items: DataFrame, plant: int = 1001) -> DataFrame:
    """Distinct part codes of `bom_view`. Its left joins add no code, so they are left out here."""
    active_heads = heads.where((F.col("WERKS") == plant) & _blank("LOEKZ") & (F.col("STLST") != 3)).select("MATNR")
    active_items = items.where((F.col("WERKS") == plant) & _blank("DUMPS")).select(F.col("IDNRK").alias("MATNR"))
    return active_heads.union(active_items).distinct()
