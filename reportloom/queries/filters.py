"""Filters and predicates."""

from datetime import date

from pyspark.sql import functions as F

from reportloom.functions.dates import before_day, in_last_days, in_last_days_text, in_month, month_to_yesterday
from reportloom.functions.predicates import all_equal, differs_or_null, lot_open, text_contains
from reportloom.queries import standins as S
from reportloom.queries.registry import query


@query(
    "rolling_range_f1",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
       WHERE o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-07-15'""",
)
def rolling_range(spark, base):
    df = S.table(spark, base, "orders").where(in_last_days(F.col("o_orderdate"), S.AS_OF))
    return df.select("o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "rolling_range_text_f1",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events
       WHERE ts >= TIMESTAMP '2024-01-17' AND ts < TIMESTAMP '2024-01-31'""",
)
def rolling_range_text(spark, base):
    df = S.table(spark, base, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return df.where(in_last_days_text(F.col("day"), S.NOW))


@query(
    "member_and_equal_f2_f3",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus = 'O'""",
)
def member_and_equal(spark, base):
    df = S.table(spark, base, "orders")
    kept = df.where(F.col("o_orderpriority").isin(list(S.GROUPS.values())) & (F.col("o_orderstatus") == "O"))
    return kept.select("o_orderkey", "o_orderpriority")


@query(
    "calendar_month_f4",
    """SELECT o_orderkey, CASE WHEN strftime(o_orderdate, '%Y-%m') = '2001-07' THEN 'this' ELSE 'last' END AS month
       FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('2001-07', '2001-06')""",
)
def calendar_month(spark, base):
    day = F.col("o_orderdate")
    this, last = in_month(day, S.AS_OF), in_month(day, S.AS_OF, 1)
    df = S.table(spark, base, "orders").where(this | last)
    return df.select("o_orderkey", F.when(this, "this").otherwise("last").alias("month"))


@query(
    "month_to_yesterday_f5",
    """SELECT event_id, ts FROM events
       WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-30 23:59:59'""",
)
def month_to_date(spark, base):
    return S.table(spark, base, "events").where(month_to_yesterday(F.col("ts"), S.NOW)).select("event_id", "ts")


@query("before_today_f6", "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-16'")
def before_today(spark, base):
    return S.table(spark, base, "events").where(before_day(F.col("ts"), date(2024, 1, 16))).select("event_id", "ts")


@query(
    "null_tests_f7",
    """SELECT doc_id, quality IS NULL AS unlabelled FROM documents LEFT JOIN labels USING (doc_id)
       WHERE quality IS NULL OR toxic IS NOT NULL""",
)
def null_tests(spark, base):
    docs = S.table(spark, base, "documents").select("doc_id")
    df = docs.join(S.table(spark, base, "labels"), "doc_id", "left")
    kept = df.where(F.col("quality").isNull() | F.col("toxic").isNotNull())
    return kept.select("doc_id", F.col("quality").isNull().alias("unlabelled"))


@query(
    "null_tolerant_inequality_f8_f9",
    """SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
       WHERE (quality <> 1 OR quality IS NULL) AND ((toxic != 0 OR toxic != 2) OR toxic IS NULL)""",
)
def null_tolerant_inequality(spark, base):
    docs = S.table(spark, base, "documents").select("doc_id")
    df = docs.join(S.table(spark, base, "labels"), "doc_id", "left")
    return df.where(differs_or_null(F.col("quality"), 1) & lot_open(F.col("toxic"))).select("doc_id", "quality", "toxic")


@query(
    "strict_status_f9",
    """SELECT doc_id, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic NOT IN (0, 2) OR toxic IS NULL""",
)
def strict_status(spark, base):
    docs = S.table(spark, base, "documents").select("doc_id")
    df = docs.join(S.table(spark, base, "labels"), "doc_id", "left")
    return df.where(lot_open(F.col("toxic"), strict_status=True)).select("doc_id", "toxic")


@query(
    "range_and_substring_f10_f11",
    "SELECT p_partkey, p_name FROM part WHERE p_size > 25 AND p_name LIKE '%widget%'",
)
def range_and_substring(spark, base):
    df = S.table(spark, base, "part").where((F.col("p_size") > 25) & F.col("p_name").contains("widget"))
    return df.select("p_partkey", "p_name")


@query(
    "exclude_category_keep_nulls_f12",
    """SELECT p_partkey, NULLIF(p_type, 'LARGE') AS category FROM part WHERE NULLIF(p_type, 'LARGE') IS DISTINCT FROM 'SMALL'""",
)
def exclude_category(spark, base):
    df = S.products(spark, base).where(differs_or_null(F.col("product_categories"), "SMALL"))
    return df.select(F.col("product_code").alias("p_partkey"), F.col("product_categories").alias("category"))


@query(
    "mask_conjunction_f13_f14",
    "SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'",
)
def mask_conjunction(spark, base):
    kept = S.table(spark, base, "orders").where(all_equal({"o_orderpriority": "2-HIGH", "o_orderstatus": "F"}))
    return kept.select("o_orderkey")


@query(
    "text_month_membership_f15",
    """SELECT event_id, COALESCE(contains(CASE WHEN event_type <> 'signup' THEN strftime(ts, '%Y-%m-%d') END, '2024-01-1'), FALSE) AS hit
       FROM events""",
)
def text_month_membership(spark, base):
    day = F.when(F.col("event_type") != "signup", F.date_format("ts", "yyyy-MM-dd"))
    return S.table(spark, base, "events").select("event_id", text_contains(day, "2024-01-1").alias("hit"))


@query("column_against_column_f16", "SELECT event_id, user_id, value FROM events WHERE value <= user_id")
def column_against_column(spark, base):
    df = S.table(spark, base, "events").where(F.col("value") <= F.col("user_id"))
    return df.select("event_id", "user_id", "value")


@query(
    "region_selection_f17",
    """SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'""",
)
def region_selection(spark, base):
    return S.customer_places(spark, base).where(F.col("r_name") == "EUROPE").select("c_custkey", "n_name")
