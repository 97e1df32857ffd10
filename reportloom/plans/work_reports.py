"""Daily work reports of the month, one sheet per form."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.functions.dates import month_to_yesterday
from reportloom.functions.text import day_prefix, decode, sheet_title
from reportloom.operators.joins import left_lookup
from reportloom.operators.project import underscore_names
from reportloom.operators.reshape import forms_with_attributes
from reportloom.plans.settings import BACK_LINK, DAILY_FORM, DAILY_TITLE


def work_reports(
    forms: DataFrame,
    cells: DataFrame,
    users: DataFrame,
    attributes: Sequence[str] | None,
    now: datetime,
    form_key: str = DAILY_FORM,
    region: str | None = None,
    inclusive_day: bool = False,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """`attributes` declares the form fields (None: those that the month's forms have), `ignore` those left out; they become columns
    with underscores. Latest forms first."""
    month = forms.where(
        (F.col("form_key") == form_key) & month_to_yesterday(F.col("local_time"), now, inclusive_day)
    ).select(
        "targetIntro",
        F.col("nickName").alias("Submitter"),
        F.col("createTime").alias("Submit_Time"),
        "local_time",
        "form_key",
        "form_id",
        "email",
    )
    regions = users.select(F.col("systemEmail").alias("email"), "region2", "region3", "region4")
    header = left_lookup(month, regions, "email")
    if region is not None:
        header = header.where(F.col("region3") == region)
    cells = cells.join(month.select("form_id"), "form_id", "left_semi")
    wide = underscore_names(forms_with_attributes(header, cells, "form_id", attributes, ignore=ignore))
    return wide.withColumns(
        {
            "form_key": decode(F.col("form_key"), {form_key: "Daily report"}),
            "local_date": day_prefix(F.col("local_time")),
            "collected_time": F.lit(f"{now:%Y-%m-%d %H:%M:%S}"),
            "hyperlink": F.lit(BACK_LINK),
            "sheet_name": sheet_title(F.col("local_time"), DAILY_TITLE, F.col("form_id")),
            "local_time": F.col("local_time").cast("string"),
        }
    ).orderBy(F.col("local_time").desc_nulls_last(), "form_id")
