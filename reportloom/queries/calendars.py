"""Date spine, gap filling, calendar columns."""

from datetime import date, datetime

from pyspark.sql import functions as F

from reportloom.functions.dates import (
    day_label,
    in_last_days,
    int_date,
    month_texts,
    week_end,
    week_start,
    week_text,
    weekend_style,
    whole_days_left,
)
from reportloom.operators.spine import Slice, cut_slices, date_spine, fill_missing_days
from reportloom.plans.operations_daily import trade_series
from reportloom.queries import standins as S
from reportloom.queries.registry import query
from reportloom.plans import operations_daily as daily


@query(
    "spine_with_orders_c1_c4",
    """WITH spine AS (SELECT CAST(DATE '2001-07-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(14) t(i))
       SELECT d AS "Date", month(d) || '月' || day(d) || '号' AS label,
              CASE isodow(d) WHEN 6 THEN 'BG:G' WHEN 7 THEN 'BG:E' END AS style, COUNT(o_orderkey) AS orders
       FROM spine LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d""",
)
def spine_with_orders(spark, base):
    recent = S.table(spark, base, "orders").where(in_last_days(F.col("o_orderdate"), S.AS_OF))
    counts = recent.groupBy(F.col("o_orderdate").cast("date").alias("Date")).agg(F.count(F.lit(1)).alias("orders"))
    spine = date_spine(spark, S.AS_OF).join(counts, "Date", "left")
    return spine.select(
        "Date", day_label(F.col("Date")).alias("label"), weekend_style(F.col("Date")).alias("style"), F.coalesce("orders", F.lit(0)).alias("orders")
    )


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "filled_days_c2_u2",
    """WITH f AS (SELECT o_orderpriority AS slice_id, CAST(o_orderdate AS DATE) AS d, MAX(NULLIF(o_orderstatus, 'O')) AS status, COUNT(*) AS n
                  FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-07-15' GROUP BY 1, 2),
            spine AS (SELECT p AS slice_id, CAST(DATE '2001-07-01' + CAST(i AS INTEGER) AS DATE) AS d
                      FROM range(14) t(i), (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']) AS p))
       SELECT slice_id, d AS "Date", status, n FROM f
       UNION ALL SELECT slice_id, d, '0', 0 FROM spine s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.slice_id = s.slice_id AND f.d = s.d)""",
)
def filled_days(spark, base):
    recent = S.table(spark, base, "orders").where(in_last_days(F.col("o_orderdate"), S.AS_OF))
    frame = recent.groupBy(F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").cast("date").alias("Date")).agg(
        F.max(F.nullif(F.col("o_orderstatus"), F.lit("O"))).alias("status"), F.count(F.lit(1)).alias("n")
    )
    slices = [Slice(p, ["status", "n"], {"priority": p}) for p in _PRIORITIES]
    return fill_missing_days(cut_slices(frame, slices, "Date"), slices, S.AS_OF, "Date")


def trade_sql() -> str:
    """Every trade series written out on its own: the series, then its missing days."""
    spine = """spine AS (SELECT CAST(DATE '2001-07-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(14) t(i))"""
    parts = []

    def add(slice_id, body, empty):
        columns = 'd AS "Date", g AS "Business_Group", c AS product_categories, q AS "Total_Quantity", CAST(a AS DOUBLE) AS "Total_Amount"'
        parts.append(f"SELECT '{slice_id}' AS slice_id, {columns} FROM ({body})")
        parts.append(f"SELECT '{slice_id}', d, {empty} FROM spine WHERE d NOT IN (SELECT d FROM ({body}))")

    for source, amount, quantity in (("so", "oa", "oq"), ("sa", "sa", "sq"), ("un", "un", "un")):
        for short, group in S.GROUPS.items():
            add(f"{amount}_{short}", f"SELECT d, g, NULL AS c, NULL AS q, SUM(a) AS a FROM {source} WHERE g = '{group}' GROUP BY d, g", "'0', NULL, NULL, 0")
            for label, category in (("host", "ECONOMY"), ("part", "PROMO")):
                add(f"{quantity}_{label}_{short}", f"SELECT * FROM {source} WHERE g = '{group}' AND c = '{category}'", "'0', '0', 0, 0")
        sums = ("ua_sum", "uq_sum") if source == "un" else (f"{amount}_sum", f"{quantity}_sum")
        add(sums[0], f"SELECT d, NULL AS g, NULL AS c, NULL AS q, SUM(a) AS a FROM {source} GROUP BY d", "NULL, NULL, NULL, 0")
        add(sums[1], f"SELECT d, NULL AS g, NULL AS c, SUM(q) AS q, NULL AS a FROM {source} GROUP BY d", "NULL, NULL, 0, NULL")
    return S.with_tables("so", "sa", "un") + ",\n" + spine + "\n" + "\nUNION ALL ".join(parts)


@query("trade_slices_c3", trade_sql())
def trade_slices(spark, base):
    shipments = S.shipment_lines(spark, base)
    series = trade_series(
        daily.from_order_table(S.order_lines(spark, base)),
        daily.from_shipment_table(shipments),
        daily.from_backlog_table(S.backlog_lines(shipments)),
        S.products(spark, base),
        S.AS_OF,
        S.KPI_NAMES,
    )
    return S.as_double(series, "Total_Amount")


@query(
    "business_week_c5",
    """SELECT o_orderkey, CAST(d - CAST((isodow(d) + 1) % 7 AS INTEGER) AS DATE) AS week_start,
              CAST(d - CAST((isodow(d) + 1) % 7 AS INTEGER) + 6 AS DATE) AS week_end,
              strftime(d - CAST((isodow(d) + 1) % 7 AS INTEGER), '%Y%m%d') || strftime(d - CAST((isodow(d) + 1) % 7 AS INTEGER) + 6, '%Y%m%d') AS week_date
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def business_week(spark, base):
    d = F.col("o_orderdate").cast("date")
    return S.table(spark, base, "orders").select(
        "o_orderkey", week_start(d).alias("week_start"), week_end(d).alias("week_end"), week_text(d).alias("week_date")
    )


@query(
    "month_texts_c6_c7",
    """SELECT strftime(ts, '%Y-%m') = '2024-01' AS in_this, strftime(ts, '%Y-%m') = '2023-12' AS in_last,
              strftime(ts, '%Y-%m') = strftime(DATE '2024-01-31' - 30, '%Y-%m') AS in_legacy_last, COUNT(*) AS n FROM events GROUP BY ALL""",
)
def month_text_counts(spark, base):
    this, last = month_texts(S.NOW)
    _, legacy = month_texts(S.NOW, legacy=True)
    month = F.date_format("ts", "yyyy-MM")
    keys = [(month == this).alias("in_this"), (month == last).alias("in_last"), (month == legacy).alias("in_legacy_last")]
    return S.table(spark, base, "events").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query(
    "whole_days_left_c8",
    """SELECT event_id, CAST(30 - floor((epoch_us(TIMESTAMP '2024-01-16 10:30:00') - epoch_us(ts)) / 86400000000.0) AS INTEGER) AS days_left FROM events""",
)
def days_left(spark, base):
    left = whole_days_left(F.lit(30), F.col("ts"), datetime(2024, 1, 16, 10, 30))
    return S.table(spark, base, "events").select("event_id", left.alias("days_left"))


@query(
    "date_arithmetic_x24",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 14 AS DATE) AS two_weeks_before, strftime(o_orderdate, '%Y-%m') AS month,
              CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before,
              CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_number FROM orders""",
)
def date_arithmetic(spark, base):
    d = F.col("o_orderdate").cast("date")
    return S.table(spark, base, "orders").select(
        "o_orderkey",
        F.date_sub(d, 14).alias("two_weeks_before"),
        F.date_format(d, "yyyy-MM").alias("month"),
        F.add_months(d, -1).alias("month_before"),
        int_date(d).alias("day_number"),
    )


@query(
    "first_day_of_history_f1",
    """SELECT o_orderpriority, COUNT(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1""",
)
def long_range(spark, base):
    days = (date(2001, 1, 1) - date(1995, 1, 1)).days
    kept = S.table(spark, base, "orders").where(in_last_days(F.col("o_orderdate"), date(2001, 1, 1), days))
    return kept.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
