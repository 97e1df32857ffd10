"""Build a report from warehouse tables to files: read, plan, write."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from reportloom.functions.dates import report_header
from reportloom.operators.project import with_header
from reportloom.plans.customer_months import customer_months as customer_month_rows
from reportloom.plans.customer_months import customer_report, region_spans
from reportloom.plans.customer_status import customer_status
from reportloom.plans.operations_daily import daily_series, from_backlog_table, from_order_table, from_shipment_table, header_days
from reportloom.plans.sales_followup import sales_report
from reportloom.plans.shelf_life import shelf_life_report, stock_lots
from reportloom.plans.visit_reports import visit_reports
from reportloom.plans.work_reports import work_reports
from reportloom.plans.work_orders import load_orders
from reportloom.sinks.files import Stored, write_report
from reportloom.sources.warehouse import read_table

Read = Callable[[str], DataFrame]


#: Sheet name of the two reports that come as one sheet.
SHEET = "sheet"


def operations_daily(read: Read, now: datetime, **options) -> DataFrame:
    """Options: `names`, the `DailyKpiNames` of the report."""
    series = daily_series(
        from_order_table(read("bos_so_correct")),
        from_shipment_table(read("bos_sa_correct")),
        from_backlog_table(read("bos_undelivered")),
        read("product_last"),
        read("oa_form"),
        now.date(),
        **options,
    )
    return with_header(series, report_header(now, SHEET), prefix="header_")


_CUSTOMER_TABLES = ("bos_customer_state", "bos_so_correct", "bos_sa_correct", "crm_form", "crm_form_data")


def customer_months(read: Read, now: datetime, **options) -> DataFrame:
    """Options: `groups`, the business groups that get a sheet."""
    report = customer_report(*map(read, _CUSTOMER_TABLES), now.date(), **options)
    return with_header(report, report_header(now, SHEET), prefix="header_")


def customer_month_spans(read: Read, now: datetime, **options) -> DataFrame:
    return region_spans(customer_month_rows(*map(read, _CUSTOMER_TABLES), now.date(), **options))


def operations_header_days(read: Read, now: datetime, **options) -> DataFrame:
    return header_days(read("product_last").sparkSession, now.date())


def customer_states(read: Read, now: datetime, **options) -> DataFrame:
    tables = ("crm_customer", "bos_customer_state", "crm_form", "crm_form_data")
    return customer_status(*map(read, tables), now, **options)


def sales_followup(read: Read, now: datetime, **options) -> DataFrame:
    return sales_report(*map(read, ("crm_user", "crm_customer", "crm_form", "crm_form_data")), now=now, **options)


def daily_work(read: Read, now: datetime, attributes=None, **options) -> DataFrame:
    """Options: `attributes`, the fields of the form; without them, those that the forms have."""
    return work_reports(*map(read, ("crm_form", "crm_form_data", "crm_user")), attributes=attributes, now=now, **options)


def customer_visits(read: Read, now: datetime, attributes=None, **options) -> DataFrame:
    """Options: `attributes`, the fields of the form (without them, those that the forms have), and `comment_order`, the column that orders comments."""
    tables = ("crm_form", "crm_form_data", "crm_comment", "crm_customer", "bos_customer_state")
    return visit_reports(*map(read, tables), attributes=attributes, now=now, **options)


def shelf_life(read: Read, now: datetime, **options) -> DataFrame:
    """Options: `factory`, a part of the work centre's description."""
    tables = ("WW_RMInventory", "Product", "ProductRoot", "Workcenter", "Cell", "Factory")
    return shelf_life_report(stock_lots(*map(read, tables), **options), now)


JOBS: dict[str, Callable[..., DataFrame]] = {
    "operations_daily": operations_daily,
    "customer_months": customer_months,
    "customer_status": customer_states,
    "sales_followup": sales_followup,
    "work_reports": daily_work,
    "visit_reports": customer_visits,
    "shelf_life": shelf_life,
}


#: What belongs to a report beside its rows, by name: cells to merge and labelled days.
PARTS: dict[str, dict[str, Callable[..., DataFrame]]] = {
    "operations_daily": {"header_days": operations_header_days},
    "customer_months": {"region_spans": customer_month_spans},
}


class Built(NamedTuple):
    """Folder and number of rows of a report."""

    folder: str
    rows: int


def build(
    spark: SparkSession, job: str, tables: str, out: str, now: datetime, fmt: str = "parquet", partition_by=(), region: str | None = None, **options
) -> Built:
    """Build one report from the tables under `tables`, in one folder per report, variant and day.

    The report of one region has a folder of its own beside the full one, and so has each of a report's `PARTS`.
    """
    variant = job if region is None else f"{job}/region={quote(region, safe='')}"
    if region is not None:
        options["region"] = region
    read = lambda name: read_table(spark, tables, name)
    df = JOBS[job](read, now, **options)
    folder = f"{out.rstrip('/')}/{variant}/built={now:%Y-%m-%d}"
    for part, plan in PARTS.get(job, {}).items():
        write_report(plan(read, now, **options), f"{out.rstrip('/')}/{variant}.{part}/built={now:%Y-%m-%d}", fmt, mode="overwrite")
    return Built(folder, write_report(df, folder, fmt, partition_by, mode="overwrite"))


def load_work_orders(spark: SparkSession, feed: str, table: str, now: datetime) -> Stored:
    """Store the landed feed under `feed` in the next snapshot of the table at `table`."""
    return load_orders(spark, feed, table, now)
