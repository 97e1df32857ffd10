"""Operations daily KPI report: gap-filled series of the last 14 days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportloom.functions.dates import day_label, in_last_days, in_last_days_int, in_last_days_text, int_date, text_date_to_int, weekend_style
from reportloom.functions.predicates import differs_or_null
from reportloom.operators.rollup import LEVEL_ALL, LEVEL_DAY, LEVEL_GROUP, daily_by_category, three_levels
from reportloom.operators.spine import Slice, cut_slices, date_spine, fill_missing_days, rows_and_sums
from reportloom.plans.settings import DailyKpiNames

DAYS = 14
MEASURES = ["Total_Quantity", "Total_Amount"]
KPI_TEXTS = ["L1Subject1", "L2Subject2", "L3Subject3", "D1"]
KPI_COLUMNS = ["MA0", "MA1", *KPI_TEXTS]


def _plain_facts(facts: Mapping[str, DataFrame], groups: Sequence[str], as_of: date | None) -> DataFrame:
    """The facts of the groups under each other with `Date` as a date; with `as_of` only those of the last days."""
    parts = []
    for name, df in facts.items():
        number = isinstance(df.schema["Date"].dataType, T.IntegralType)
        day = F.to_date(F.col("Date").cast("string"), "yyyyMMdd") if number else F.col("Date").cast("date")
        rows = df.where(F.col("Business_Group").isin(list(groups)))
        if as_of is not None:
            rows = rows.where((in_last_days_int if number else in_last_days)(F.col("Date"), as_of, DAYS))
        parts.append(rows.select(F.lit(name).alias("fact"), day.alias("Date"), "Business_Group", "product_code", *MEASURES))
    return reduce(DataFrame.unionByName, parts)


def daily_totals(facts: Mapping[str, DataFrame], products: DataFrame, groups: Sequence[str], as_of: date | None = None) -> DataFrame:
    """Sums per fact, day, group and category; facts have Date, Business_Group, product_code and the measures.

    `Date` is a date, a timestamp or an integer `yyyyMMdd`.
    """
    keys = ["fact", "Date", "Business_Group"]
    return daily_by_category(_plain_facts(facts, groups, as_of), products, keys, "product_code", "product_categories", MEASURES)


def without_left_out(daily: DataFrame, left_out_of_backlog: str) -> DataFrame:
    return daily.where((F.col("fact") != "backlog") | differs_or_null(F.col("product_categories"), left_out_of_backlog))


def trade_totals(
    facts: Mapping[str, DataFrame], products: DataFrame, groups: Sequence[str], as_of: date, left_out_of_backlog: str
) -> DataFrame:
    """Three levels of daily totals per fact for the last days."""
    daily = without_left_out(daily_totals(facts, products, groups, as_of), left_out_of_backlog)
    return three_levels(daily, "Date", "Business_Group", "product_categories", MEASURES, within=["fact"])


def trade_slices(names: DailyKpiNames) -> list[Slice]:
    """Amount by group and in total, quantity by group and category and in total, for each of the three facts."""
    out = []
    for fact, amount, quantity in (("orders", "oa", "oq"), ("deliveries", "sa", "sq"), ("backlog", "un", "un")):
        for short, group in names.groups.items():
            where = {"fact": fact, "level": LEVEL_GROUP, "Business_Group": group}
            out.append(Slice(f"{amount}_{short}", ["Business_Group", "Total_Amount"], where))
        amount_sum, quantity_sum = ("ua_sum", "uq_sum") if fact == "backlog" else (f"{amount}_sum", f"{quantity}_sum")
        out.append(Slice(amount_sum, ["Total_Amount"], {"fact": fact, "level": LEVEL_DAY}))
        for short, group in names.groups.items():
            for label, category in names.categories.items():
                where = {"fact": fact, "level": LEVEL_ALL, "Business_Group": group, "product_categories": category}
                columns = ["Business_Group", "Total_Quantity", "Total_Amount", "product_categories"]
                out.append(Slice(f"{quantity}_{label}_{short}", columns, where))
        out.append(Slice(quantity_sum, ["Total_Quantity"], {"fact": fact, "level": LEVEL_DAY}))
    return out


def kpi_row_slices(names: DailyKpiNames) -> list[Slice]:
    """Series that show KPI rows as they are."""
    out = []
    lines = {"L2Subject2": names.daily_output, "L3Subject3": names.by_product_line}
    for short, line in names.product_lines.items():
        out.append(Slice(f"cpx_{short}", KPI_COLUMNS, {**lines, "D1": line}))
    for short, factory in names.factories.items():
        out.append(Slice(f"gc_{short}", KPI_COLUMNS, {"L3Subject3": names.by_factory, "D1": factory}))
    for series, subject in names.plant_subjects.items():
        for short in names.plants:
            where = {"L2Subject2": subject, "D1": names.factories[short]}
            out.append(Slice(f"{series}_{short}", KPI_COLUMNS, where))
    return out


def kpi_sum_slices(names: DailyKpiNames) -> list[Slice]:
    """Series that sum KPI rows by day. Factory output is not limited to the daily-output subject."""
    lines = {"L2Subject2": names.daily_output, "L3Subject3": names.by_product_line}
    out = [Slice("cpx_sum", ["MA0"], lines), Slice("gc_sum", ["MA0"], {"L3Subject3": names.by_factory})]
    if "rjcz" in names.plant_subjects:
        heads = {"L2Subject2": names.plant_subjects["rjcz"]}
        out += [Slice("rjcz_sum0", ["MA0"], heads), Slice("rjcz_sum1", ["MA1"], heads)]
    if "gcrs" in names.plant_subjects:
        out.append(Slice("gcrs_sum", ["MA0", "MA1"], {"L2Subject2": names.plant_subjects["gcrs"]}))
    return out


def daily_slices(names: DailyKpiNames) -> list[Slice]:
    return trade_slices(names) + kpi_row_slices(names) + kpi_sum_slices(names)


def trade_series(
    orders: DataFrame, deliveries: DataFrame, backlog: DataFrame, products: DataFrame, as_of: date, names: DailyKpiNames
) -> DataFrame:
    facts = {"orders": orders, "deliveries": deliveries, "backlog": backlog}
    totals = trade_totals(facts, products, list(names.groups.values()), as_of, names.left_out_of_backlog)
    slices = trade_slices(names)
    return fill_missing_days(cut_slices(totals, slices, "Date"), slices, as_of, "Date", DAYS)


def kpi_rows(kpis: DataFrame, as_of: date, names: DailyKpiNames) -> DataFrame:
    """Recent KPI rows with `Date` as a date and both measures as numbers."""
    recent = kpis.where((F.col("form_type") == names.form_type) & in_last_days_text(F.col("ReportDate"), as_of, DAYS))
    return recent.select(
        F.to_date("ReportDate").alias("Date"),
        F.col("MA0").cast("double").alias("MA0"),
        F.col("MA1").cast("double").alias("MA1"),
        *KPI_TEXTS,
    )


def kpi_series(kpis: DataFrame, as_of: date, names: DailyKpiNames) -> DataFrame:
    """Rows as they are and daily sums; the KPI table is read once for the rows and once for sums and missing days."""
    return rows_and_sums(kpi_rows(kpis, as_of, names), kpi_row_slices(names), kpi_sum_slices(names), ["MA0", "MA1"], as_of, "Date", DAYS)


def daily_series(
    orders: DataFrame,
    deliveries: DataFrame,
    backlog: DataFrame,
    products: DataFrame,
    kpis: DataFrame,
    as_of: date,
    names: DailyKpiNames,
) -> DataFrame:
    """All series as (slice_id, Date as yyyyMMdd, columns of the slice), ordered by slice and day."""
    trade = trade_series(orders, deliveries, backlog, products, as_of, names)
    series = trade.unionByName(kpi_series(kpis, as_of, names), allowMissingColumns=True)
    # The other columns make equal rows only tie with copies of themselves, so a full day can be spread in the sort.
    rest = [c for c in series.columns if c not in ("slice_id", "Date")]
    return series.withColumn("Date", int_date(F.col("Date"))).orderBy("slice_id", "Date", *rest)


def header_days(spark, as_of: date) -> DataFrame:
    """The 14 header days with label and weekend style."""
    spine = date_spine(spark, as_of, DAYS)
    return spine.select("Date", day_label(F.col("Date")).alias("label"), weekend_style(F.col("Date")).alias("style"))


def from_order_table(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("Order_Date").alias("Date"),
        F.col("Business_Group_Name").alias("Business_Group"),
        F.col("Product_Code").alias("product_code"),
        F.col("Confimred_Order_Quantity").alias("Total_Quantity"),
        F.col("Final_Order_Rebate_Amount_Cny").alias("Total_Amount"),
    )


def from_shipment_table(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("Stock_Out_Date").alias("Date"),
        "Business_Group",
        F.col("Product_Code").alias("product_code"),
        F.col("Stock_Out_Quantity").alias("Total_Quantity"),
        F.col("Rebate_Sales_Amount_Cny").alias("Total_Amount"),
    )


def from_backlog_table(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("undelivered_date").alias("Date"),
        F.col("Business_Group_Name").alias("Business_Group"),
        F.col("Product_Code").alias("product_code"),
        F.col("Undelivered_Quantity").alias("Total_Quantity"),
        F.col("Undelivered_Order_Rebate_Amount_Cny").alias("Total_Amount"),
    )
