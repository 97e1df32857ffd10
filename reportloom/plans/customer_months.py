"""Customer report: this and last month's orders, shipments and visits per customer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.functions.dates import month_texts
from reportloom.functions.predicates import text_contains
from reportloom.functions.text import first_known
from reportloom.operators.joins import left_lookup_where, left_merge
from reportloom.operators.ordering import category_rank, value_spans
from reportloom.operators.reshape import explode_documents
from reportloom.operators.rollup import month_pair_orders, month_pair_sums, occurrences_where
from reportloom.plans.settings import DATE_OF_VISIT, NO_REGION, SALES_REGIONS

_ZERO_FILLED = [
    f"{month}_month_{what}" for month in ("this", "last") for what in ("order_amount", "sales_amount", "visit_nums")
]


def visit_counts(forms: DataFrame, cells: DataFrame, as_of: date, legacy: bool = False) -> DataFrame:
    """Visits per customer number in the JSON of each form, for this and last month."""
    dates = left_lookup_where(
        forms.select("form_id", "otherData"),
        cells.select("form_id", "name", F.col("value").alias("visit_date")),
        "form_id",
        F.col("name") == DATE_OF_VISIT,
    ).select("visit_date", "otherData")
    this, last = month_texts(as_of, legacy)
    hits = {
        "this_month_visit_nums": text_contains(F.col("visit_date"), this),
        "last_month_visit_nums": text_contains(F.col("visit_date"), last),
    }
    # Forms outside both months are dropped before their JSON is parsed.
    recent = dates.where(hits["this_month_visit_nums"] | hits["last_month_visit_nums"])
    customers = explode_documents(recent, "otherData", "customerNo string")
    return occurrences_where(customers, "customerNo", hits).withColumnRenamed("customerNo", "crm_code")


def customer_months(
    customers: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    forms: DataFrame,
    cells: DataFrame,
    as_of: date,
    groups: Sequence[str],
    active: str = "是",
    region_order: Sequence[str] = SALES_REGIONS,
    no_region: str = NO_REGION,
    legacy_previous_month: bool = False,
) -> DataFrame:
    """One row per active customer of the groups, with `order_rank` for the report order."""
    base = customers.where((F.col("isactive") == active) & F.col("sale_org_name").isin(list(groups))).select(
        F.col("bos_code").alias("BOS_Group_Id"),
        F.col("name").alias("Customer_Name"),
        "crm_code",
        F.col("sale_org_name").alias("Business_Group_Name"),
        F.coalesce(F.col("sale_area_name"), F.lit(no_region)).alias("Business_Region"),
    )
    ordered = month_pair_orders(
        orders, "BOS_Group_Id", "Order_Date", "Final_Order_Rebate_Amount_Cny", "Sales_Representative_Name", as_of
    )
    shipped = month_pair_sums(shipments, "BOS_Group_Id", "Stock_Out_Date", "Rebate_Sales_Amount_Cny", as_of, "sales_amount")
    # Each right side has one row per key, so nothing is multiplied.
    df = left_merge(base, ordered, "BOS_Group_Id", max_null_matches=None)
    df = left_merge(df, shipped, "BOS_Group_Id", max_null_matches=None)
    df = left_merge(df, visit_counts(forms, cells, as_of, legacy_previous_month), "crm_code", max_null_matches=None)
    return df.withColumns(
        {
            "Sales_Representative_Name": first_known(
                F.col("this_month_representative"), F.col("last_month_representative")
            ),
            "order_rank": category_rank(F.col("Business_Region"), region_order),
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in _ZERO_FILLED},
        }
    )


def report_order() -> list:
    """Region order, representative, largest amount first; the customer code settles the rest."""
    return [
        F.col("order_rank").asc_nulls_last(),
        F.col("Sales_Representative_Name").asc_nulls_last(),
        F.col("this_month_order_amount").desc_nulls_last(),
        F.col("BOS_Group_Id").asc_nulls_last(),
        F.col("crm_code").asc_nulls_last(),
    ]


def customer_report(*args, **kwargs) -> DataFrame:
    """`customer_months` in report order, one sheet per business group."""
    df = customer_months(*args, **kwargs)
    return df.orderBy("Business_Group_Name", *report_order()).drop("order_rank")


def region_spans(report: DataFrame) -> DataFrame:
    """Rows to merge per region and business group; `report` is the result of `customer_months`."""
    key = ["order_rank", "Sales_Representative_Name", "this_month_order_amount", "BOS_Group_Id", "crm_code"]
    return value_spans(report, "Business_Group_Name", "Business_Region", *report_order(), key=key)
