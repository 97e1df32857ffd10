"""Customer visit reports of the month with customer amounts and comments, one sheet per form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.functions.dates import month_to_yesterday
from reportloom.functions.text import contact_lines, day_prefix, decode, display, sheet_title, without_quotes
from reportloom.operators.joins import MAX_NULL_MATCHES, left_lookup, left_merge
from reportloom.operators.project import rename_fields, underscore_names
from reportloom.operators.reshape import composite_attribute, forms_with_attributes, with_sentinel_row
from reportloom.operators.rollup import joined_text
from reportloom.plans.settings import BACK_LINK, FORM_KINDS, MEETING_AMOUNT, VISIT_FORMS, VISIT_TITLE

_AMOUNTS = ["month_order_amount", "month_shipping_amount", "year_order_amount", "year_shipping_amount"]

# Names of the pivoted fields in the report.
FIELD_NAMES = {
    "Order_Amount_Confirmed_in_the_Meeting_(CNY)": "Order_Amount_Confirmed_in_the_Meeting",
    "Customer_Contact_Info-Customer_Contact_Person": "Customer_Contact_Person",
    "Customer_Contact_Info-Business_Title": "Business_Title",
    "Customer_Contact_Info-Contact": "Contact",
    "form_key": "visit_form",
}
NO_VISITS = "无客户拜访报告"
NO_ORDERS = "暂未接单"


def customer_amounts(customers: DataFrame, states: DataFrame) -> DataFrame:
    base = customers.select(
        "crm_code",
        "contactsName",
        "contactsPost",
        without_quotes(F.col("contactsMobile")).alias("contactsMobile"),
        "email",
        "region3",
        F.col("region4").alias("area"),
        "bos_code",
    )
    return left_lookup(base, states.select("bos_code", "no_order_days", *_AMOUNTS), "bos_code")


def month_forms(forms: DataFrame, now: datetime, form_keys: Sequence[str], inclusive_day: bool = False) -> DataFrame:
    return forms.where(
        F.col("form_key").isin(list(form_keys)) & month_to_yesterday(F.col("local_time"), now, inclusive_day)
    ).select(
        F.col("targetIntro").alias("Customer_Name"),
        F.col("nickName").alias("Submitter"),
        F.col("createTime").alias("Submit_Time"),
        "local_time",
        "crm_code",
        "form_key",
        "form_id",
        "time_zone",
        F.col("email").alias("sales_email"),
    )


def with_fields(month: DataFrame, cells: DataFrame, attributes: Sequence[str] | None, ignore: Sequence[str] = ()) -> DataFrame:
    field = composite_attribute(F.col("name"), F.col("child_name"))
    wide = forms_with_attributes(month, cells, "form_id", attributes, field, ignore=ignore)
    return rename_fields(underscore_names(wide), FIELD_NAMES)


def visit_reports(
    forms: DataFrame,
    cells: DataFrame,
    comments: DataFrame,
    customers: DataFrame,
    states: DataFrame,
    attributes: Sequence[str] | None,
    now: datetime,
    comment_order: str,
    kinds: Mapping[str, str] = FORM_KINDS,
    form_keys: Sequence[str] = VISIT_FORMS,
    region: str | None = None,
    ignore: Sequence[str] = (),
    max_null_matches: int | None = MAX_NULL_MATCHES,
) -> DataFrame:
    """Visits with customer and comments; `comment_order` gives the order in which comments are joined. Without `attributes` the month's
    forms tell which fields there are.

    The month's form ids drop the cells and comments of all other months; `ignore` names form fields to leave out.
    Without any visit the result is one row that only names its sheet.
    """
    month = month_forms(forms, now, form_keys)
    ids = month.select("form_id")
    cells, comments = cells.join(ids, "form_id", "left_semi"), comments.join(ids, "form_id", "left_semi")
    df = left_merge(with_fields(month, cells, attributes, ignore), customer_amounts(customers, states), "crm_code", max_null_matches)
    df = left_lookup(df, joined_text(comments, "form_id", "remark", comment_order), "form_id")
    if region is not None:
        df = df.where(F.col("region3") == region)
    amount = FIELD_NAMES[MEETING_AMOUNT.replace(" ", "_")]
    if amount in df.columns:
        df = df.withColumn(amount, F.col(amount).cast("double"))
    df = df.fillna(0, subset=_AMOUNTS).withColumns(
        {
            "no_order_days": display(F.col("no_order_days"), NO_ORDERS),
            "visit_form": decode(F.col("visit_form"), kinds),
            "combined_contact": contact_lines(F.col("contactsMobile"), F.col("email")),
            "collected_time": F.lit(f"{now:%Y-%m-%d %H:%M:%S}"),
            "local_date": day_prefix(F.col("local_time")),
            "hyperlink": F.lit(BACK_LINK),
            "sheet_name": sheet_title(F.col("local_time"), VISIT_TITLE, F.col("form_id")),
            "Submit_Time": F.col("Submit_Time").cast("string"),
            "local_time": F.col("local_time").cast("string"),
        }
    )
    # A region without visits gives no file, the full report a sheet that says so.
    reported = df if region is not None else with_sentinel_row(df, {"sheet_name": NO_VISITS}, probe=month)
    return reported.orderBy(
        F.col("Submit_Time").desc_nulls_last(), F.col("Customer_Name").asc_nulls_last(), F.col("form_id").asc_nulls_last()
    )
