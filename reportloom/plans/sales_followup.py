"""Sales follow-up: sales users with their visits and daily reports, month to date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.functions.dates import month_to_yesterday, report_header
from reportloom.functions.text import decode, sheet_title, workbook_link
from reportloom.operators.joins import MAX_NULL_MATCHES, attribute_joins, left_merge, left_merge_large_right
from reportloom.operators.ordering import category_rank
from reportloom.operators.project import fill_all_as_text, with_header
from reportloom.plans.settings import (
    DAILY_BOOK,
    DAILY_TITLE,
    DATE_OF_REPORT,
    DATE_OF_VISIT,
    FORM_KINDS,
    LARGE_REGIONS,
    MEETING_AMOUNT,
    SALES_DEPARTMENT,
    SALES_POSTS,
    VISIT_BOOK,
    VISIT_TITLE,
)

SHEET = "销售跟进情况汇总（月）"
_HEADER = ["email", "targetIntro", "nickName", "form_key", "form_id", "createTime", "local_time", "crm_code"]


def sales_users(users: DataFrame, department: str = SALES_DEPARTMENT, posts: Sequence[str] = SALES_POSTS) -> DataFrame:
    return users.where(
        (F.col("status") == 1) & (F.col("region2") == department) & F.col("post").isin(list(posts))
    ).select("region3", "region4", "realname", F.col("systemEmail").alias("email"))


def month_forms(forms: DataFrame, now: datetime, kinds: Mapping[str, str], inclusive_day: bool = False) -> DataFrame:
    return forms.where(
        F.col("form_key").isin(list(kinds)) & month_to_yesterday(F.col("local_time"), now, inclusive_day)
    ).select(*_HEADER)


def month_visits(month: DataFrame, cells: DataFrame, kinds: Mapping[str, str] = FORM_KINDS) -> DataFrame:
    """Forms of the month with visit date, amount and a link to their sheet."""
    wide = attribute_joins(
        month, cells, "form_id", {"visit_date": DATE_OF_VISIT, "visit_amount": MEETING_AMOUNT, "report_date": DATE_OF_REPORT}
    )
    moment, form_id, kind = F.col("local_time"), F.col("form_id"), F.col("form_key")
    visit = workbook_link(VISIT_BOOK, sheet_title(moment, VISIT_TITLE, form_id))
    daily = workbook_link(DAILY_BOOK, sheet_title(moment, DAILY_TITLE, form_id))
    return (
        wide.withColumns({"form_key": decode(kind, kinds), "visit_amount": F.col("visit_amount").cast("double")})
        .withColumn("visit_report", F.when(kind.isin("Offline", "Online"), visit).when(kind == "Daily report", daily))
        .withColumn("visit_date", F.when(kind == "Daily report", F.col("report_date")).otherwise(F.col("visit_date")))
    )


def sales_followup(
    users: DataFrame,
    customers: DataFrame,
    forms: DataFrame,
    cells: DataFrame,
    now: datetime,
    department: str = SALES_DEPARTMENT,
    posts: Sequence[str] = SALES_POSTS,
    region_order: Sequence[str] = LARGE_REGIONS,
    kinds: Mapping[str, str] = FORM_KINDS,
    region: str | None = None,
    max_null_matches: int | None = MAX_NULL_MATCHES,
) -> DataFrame:
    """Every sales user with each of their forms, typed; `region` keeps one large region, `max_null_matches` bounds what missing
    e-mail addresses and customer codes may match."""
    people = sales_users(users, department, posts)
    if region is not None:
        people = people.where(F.col("region3") == region)
    month = month_forms(forms, now, kinds)
    cells = cells.join(month.select("form_id"), "form_id", "left_semi")
    df = left_merge_large_right(people, month_visits(month, cells, kinds), "email", month, max_null_matches)
    df = left_merge(df, customers.select("crm_code", "businessName"), "crm_code", max_null_matches)
    return df.withColumns(
        {"has_report": F.col("form_key").isNotNull(), "order_rank": category_rank(F.col("region3"), region_order)}
    )


def sales_report(*args, now: datetime, **kwargs) -> DataFrame:
    """`sales_followup` in report order with nulls shown as dashes and the header values."""
    df = sales_followup(*args, now=now, **kwargs).orderBy(
        F.col("order_rank").asc_nulls_last(),
        F.col("region4").asc_nulls_last(),
        F.col("has_report").desc_nulls_last(),
        F.col("realname").asc_nulls_last(),
        F.col("visit_date").desc_nulls_last(),
        F.col("form_id").asc_nulls_last(),
    )
    shown = fill_all_as_text(df.drop("order_rank"), keep=["has_report"])
    return with_header(shown, report_header(now, SHEET), prefix="header_")
