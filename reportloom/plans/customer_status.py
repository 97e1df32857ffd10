"""Customer status of the month: CRM customers, their amounts and visits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.functions.dates import before_day, month_texts, report_header, yesterday
from reportloom.functions.predicates import text_contains
from reportloom.operators.joins import left_lookup, left_lookup_where, left_merge
from reportloom.operators.ordering import in_category_order
from reportloom.operators.project import with_header
from reportloom.operators.rollup import occurrences_where
from reportloom.plans.settings import DATE_OF_VISIT, LARGE_REGIONS, SALES_DEPARTMENT, VISIT_FORMS

_AMOUNTS = ["last_month_order_amount", "month_order_amount", "last_month_shipping_amount", "month_shipping_amount"]
_VISITS = ["last_month_visit_nums", "this_month_visit_nums"]
SHEET = "客户状况汇总（月）"


def visit_counts(forms: DataFrame, cells: DataFrame, now: datetime, visit_forms: Sequence[str]) -> DataFrame:
    past = forms.where(F.col("form_key").isin(list(visit_forms)) & before_day(F.col("createTime"), now))
    dated = left_lookup_where(
        past.select("form_id", "crm_code"),
        cells.select("form_id", "name", F.col("value").alias("visit_date")),
        "form_id",
        F.col("name") == DATE_OF_VISIT,
    )
    this, last = month_texts(yesterday(now))
    return occurrences_where(
        dated,
        "crm_code",
        {
            "this_month_visit_nums": text_contains(F.col("visit_date"), this),
            "last_month_visit_nums": text_contains(F.col("visit_date"), last),
        },
    )


def customer_status(
    customers: DataFrame,
    states: DataFrame,
    forms: DataFrame,
    cells: DataFrame,
    now: datetime,
    department: str = SALES_DEPARTMENT,
    region_order: Sequence[str] = LARGE_REGIONS,
    visit_forms: Sequence[str] = VISIT_FORMS,
) -> DataFrame:
    """One row per customer of the department with a region, in report order and with header values."""
    base = customers.where(
        (F.col("region2") == department) & F.col("region3").isNotNull() & F.col("region4").isNotNull()
    ).select("customerName", "ownerUserName", "region3", "region4", "crm_code", "bos_code")
    df = left_lookup(base, states.select("bos_code", *_AMOUNTS), "bos_code")
    df = left_merge(df, visit_counts(forms, cells, now, visit_forms), "crm_code", max_null_matches=None)
    df = in_category_order(
        df.fillna(0, subset=_AMOUNTS + _VISITS),
        "region3",
        region_order,
        F.col("region4").asc_nulls_last(),
        F.col("ownerUserName").asc_nulls_last(),
        F.col("month_order_amount").desc_nulls_last(),
        F.col("crm_code").asc_nulls_last(),
    )
    return with_header(df, report_header(now, SHEET))
