"""Aggregations and set operations."""

from datetime import timedelta

from pyspark.sql import functions as F

from reportloom.functions.dates import in_last_days
from reportloom.operators.rollup import (
    counted,
    daily_by_category,
    joined_text,
    latest_known,
    month_pair_orders,
    month_pair_sums,
    occurrences,
    report_sums,
    three_levels,
)
from reportloom.plans.daily_partials import add_batch, kept_totals, recount_day
from reportloom.plans.operations_daily import DAYS, MEASURES, from_order_table, kpi_rows
from reportloom.queries import standins as S
from reportloom.queries.registry import query
from reportloom.session import new_folder


def _all_days(spark, base):
    fact = from_order_table(S.order_lines(spark, base)).withColumn("Date", F.col("Date").cast("date"))
    return daily_by_category(
        fact, S.products(spark, base), ["Date", "Business_Group"], "product_code", "product_categories", MEASURES
    )


_DAILY = """SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS g, NULLIF(p_type, 'LARGE') AS c, SUM(l_quantity) AS q,
               SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS a
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL"""


@query(
    "daily_sums_a1",
    f"""SELECT d AS "Date", g AS "Business_Group", c AS product_categories, q AS "Total_Quantity", CAST(a AS DOUBLE) AS "Total_Amount" FROM ({_DAILY})""",
)
def daily_sums(spark, base):
    return S.as_double(_all_days(spark, base), "Total_Amount")


@query(
    "three_level_totals_a1_a2_a3",
    f"""WITH daily AS ({_DAILY})
        SELECT d AS "Date", g AS "Business_Group", c AS product_categories, CAST(1 AS INTEGER) AS level, q AS "Total_Quantity",
               CAST(a AS DOUBLE) AS "Total_Amount" FROM daily
        UNION ALL SELECT d, g, NULL, 2, SUM(q), CAST(SUM(a) AS DOUBLE) FROM daily GROUP BY d, g
        UNION ALL SELECT d, NULL, NULL, 3, SUM(q), CAST(SUM(a) AS DOUBLE) FROM daily GROUP BY d""",
)
def three_level_totals(spark, base):
    levels = three_levels(_all_days(spark, base), "Date", "Business_Group", "product_categories", MEASURES)
    return S.as_double(levels, "Total_Amount")


@query(
    "kpi_day_sums_a4",
    S.with_tables("kpi")
    + """ SELECT d AS "Date", ROUND(COALESCE(SUM(m0), 0), 4) AS "MA0", COALESCE(SUM(m1), 0) AS "MA1" FROM kpi GROUP BY d""",
)
def kpi_day_sums(spark, base):
    rows = kpi_rows(S.kpi_forms(spark, base), S.NOW.date(), S.KPI_NAMES)
    return report_sums(rows, "Date", ["MA0", "MA1"]).withColumn("MA0", F.round("MA0", 4))


@query(
    "customer_representative_sums_a5",
    """SELECT CAST(NULLIF(o_custkey, 5) AS VARCHAR) AS "BOS_Group_Id", NULLIF(o_orderpriority, '5-LOW') AS "Sales_Representative_Name",
              CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS amount, MAX(o_orderdate) AS "Order_Date" FROM orders GROUP BY 1, 2""",
)
def customer_representative_sums(spark, base):
    out = S.customer_orders(spark, base).groupBy("BOS_Group_Id", "Sales_Representative_Name").agg(
        F.sum("Final_Order_Rebate_Amount_Cny").alias("amount"), F.max("Order_Date").alias("Order_Date")
    )
    return S.as_double(out, "amount")


@query(
    "total_and_last_representative_a6",
    """WITH per_rep AS (
         SELECT NULLIF(o_custkey, 5) AS k, NULLIF(o_orderpriority, '5-LOW') AS rep, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS amount,
                MAX(o_orderdate) AS last_day FROM orders GROUP BY 1, 2),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rep IS NULL, last_day DESC, rep DESC) AS rn FROM per_rep)
       SELECT CAST(k AS VARCHAR) AS "BOS_Group_Id", CAST(SUM(amount) AS DOUBLE) AS amount, MAX(rep) FILTER (WHERE rn = 1) AS representative
       FROM ranked WHERE k IS NOT NULL GROUP BY k""",
)
def total_and_last_representative(spark, base):
    out = S.customer_orders(spark, base).where(F.col("BOS_Group_Id").isNotNull()).groupBy("BOS_Group_Id").agg(
        F.coalesce(F.sum("Final_Order_Rebate_Amount_Cny"), F.lit(0)).alias("amount"),
        latest_known(F.col("Sales_Representative_Name"), F.col("Order_Date")).alias("representative"),
    )
    return S.as_double(out, "amount")


@query(
    "month_pair_orders_a5_a6",
    """WITH o AS (SELECT CAST(NULLIF(o_custkey, 5) AS VARCHAR) AS k, NULLIF(o_orderpriority, '5-LOW') AS rep,
                         CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderdate AS d, strftime(o_orderdate, '%Y-%m') AS m FROM orders)
       SELECT k AS "BOS_Group_Id", CAST(SUM(amount) FILTER (WHERE m = '2001-07') AS DOUBLE) AS this_month_order_amount,
              CAST(SUM(amount) FILTER (WHERE m = '2001-06') AS DOUBLE) AS last_month_order_amount,
              max_by(rep, ROW(d, rep)) FILTER (WHERE m = '2001-07' AND rep IS NOT NULL) AS this_month_representative,
              max_by(rep, ROW(d, rep)) FILTER (WHERE m = '2001-06' AND rep IS NOT NULL) AS last_month_representative
       FROM o WHERE k IS NOT NULL AND m IN ('2001-06', '2001-07') GROUP BY k""",
)
def month_pair(spark, base):
    out = month_pair_orders(
        S.customer_orders(spark, base), "BOS_Group_Id", "Order_Date", "Final_Order_Rebate_Amount_Cny", "Sales_Representative_Name", S.AS_OF
    )
    return S.as_double(out, "this_month_order_amount", "last_month_order_amount")


@query(
    "month_pair_shipments_a7",
    """WITH s AS (SELECT CAST(NULLIF(o_custkey, 5) AS VARCHAR) AS k, strftime(l_shipdate, '%Y-%m') AS m,
                  CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS a
                  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
       SELECT k AS "BOS_Group_Id", CAST(SUM(a) FILTER (WHERE m = '2001-06') AS DOUBLE) AS last_month_sales_amount,
              CAST(SUM(a) FILTER (WHERE m = '2001-07') AS DOUBLE) AS this_month_sales_amount
       FROM s WHERE m IN ('2001-06', '2001-07') GROUP BY k""",
)
def month_pair_shipments(spark, base):
    out = month_pair_sums(
        S.shipment_lines(spark, base), "BOS_Group_Id", "Stock_Out_Date", "Rebate_Sales_Amount_Cny", S.AS_OF, "sales_amount"
    )
    return S.as_double(out, "last_month_sales_amount", "this_month_sales_amount")


#: Days after which a line of small quantity arrives.
LATE_DAYS = 2


def landed_lines(spark, base, first, last):
    """Order lines that arrive from `first` to `last`, stored by that day (`arrived`); only the orders of these days are joined."""
    folder = new_folder(spark, "landed-lines")
    lines = from_order_table(S.order_lines(spark, base)).withColumn("Date", F.col("Date").cast("date"))
    arrived = F.when(F.col("Total_Quantity") < 8, F.date_add("Date", LATE_DAYS)).otherwise(F.col("Date"))
    ordered = lines.where(F.col("Date").between(F.lit(first - timedelta(days=LATE_DAYS)), F.lit(last)))
    landed = ordered.withColumn("arrived", arrived).where(F.col("arrived").between(F.lit(first), F.lit(last)))
    landed.hint("rebalance", "arrived").write.partitionBy("arrived").parquet(folder)
    return spark.read.schema(landed.schema).parquet(folder)


@query(
    "incremental_days_a1_a3",
    f"""WITH daily AS (SELECT * FROM ({_DAILY}) WHERE d >= DATE '2001-07-01' AND d < DATE '2001-07-15' AND g IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))
        SELECT 'orders' AS fact, d AS "Date", g AS "Business_Group", c AS product_categories, CAST(1 AS INTEGER) AS level, q AS "Total_Quantity",
               CAST(a AS DOUBLE) AS "Total_Amount" FROM daily
        UNION ALL SELECT 'orders', d, g, NULL, 2, SUM(q), CAST(SUM(a) AS DOUBLE) FROM daily GROUP BY d, g
        UNION ALL SELECT 'orders', d, NULL, NULL, 3, SUM(q), CAST(SUM(a) AS DOUBLE) FROM daily GROUP BY d""",
)
def incremental_days(spark, base):
    """14 days, a batch each; lines of small quantity come two days late, those of the last days in a batch of their own.

    The lines of these days are joined once and land in a folder for each day on which they arrive, as batches do."""
    folder, groups = new_folder(spark, "partials"), list(S.GROUPS.values())
    lines = landed_lines(spark, base, S.AS_OF - timedelta(days=DAYS), S.AS_OF + timedelta(days=1))
    for back in range(DAYS, -2, -1):
        today = S.AS_OF - timedelta(days=back)
        add_batch({"orders": lines.where(F.col("arrived") == F.lit(today)).drop("arrived")}, S.products(spark, base), groups, folder, f"{today:%Y%m%d}")
    recount_day({"orders": lines.drop("arrived")}, S.products(spark, base), groups, folder, S.AS_OF - timedelta(days=5))
    return S.as_double(kept_totals(spark, folder, S.AS_OF, S.KPI_NAMES.left_out_of_backlog), "Total_Amount")


@query(
    "occurrences_a8",
    """SELECT 'C' || user_id AS crm_code, COUNT(*) AS visit_nums FROM events WHERE value >= 1 GROUP BY user_id""",
)
def occurrence_counts(spark, base):
    return occurrences(S.crm_forms(spark, base), "crm_code", "visit_nums")


@query(
    "joined_comments_a9",
    """SELECT CAST(conv_id AS VARCHAR) AS form_id, string_agg(text, chr(13) || chr(10) ORDER BY turn) AS remark
       FROM conversations GROUP BY conv_id""",
)
def joined_comments(spark, base):
    return joined_text(S.comments(spark, base), "form_id", "remark", "turn")


@query("latest_id_a10", "SELECT user_id, MAX(event_id) AS max_id FROM events GROUP BY user_id")
def latest_id(spark, base):
    return S.table(spark, base, "events").groupBy("user_id").agg(F.max("event_id").alias("max_id"))


@query("distinct_parts_a11", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_parts(spark, base):
    return S.table(spark, base, "part").select("p_brand", "p_type").distinct()


@query("observed_rows_a12", "SELECT o_orderpriority, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS rows_read FROM orders GROUP BY o_orderpriority")
def observed_rows(spark, base):
    """The number of rows read is known once they have been read: here with the first of two uses."""
    watched, seen = counted(S.table(spark, base, "orders").select("o_orderpriority"), "orders_read")
    watched.write.format("noop").mode("overwrite").save()
    return watched.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).withColumn("rows_read", F.lit(seen.get["rows"]).cast("long"))


@query(
    "split_and_rejoined_u1",
    """SELECT event_id, CASE WHEN event_type = 'signup' THEN CAST(user_id AS VARCHAR) ELSE event_type END AS shown, ts FROM events""",
)
def split_and_rejoined(spark, base):
    events = S.table(spark, base, "events")
    reports = events.where("event_type = 'signup'").select("event_id", F.col("user_id").cast("string").alias("shown"), "ts")
    visits = events.where("event_type <> 'signup'").select("event_id", F.col("event_type").alias("shown"), "ts")
    return reports.unionByName(visits, allowMissingColumns=True)


@query(
    "distinct_union_u4",
    """SELECT l_partkey AS part, l_returnflag AS mark FROM lineitem WHERE l_linestatus = 'O'
       UNION SELECT p_partkey, NULL FROM part WHERE p_size > 10""",
)
def distinct_union(spark, base):
    lines = S.table(spark, base, "lineitem").where("l_linestatus = 'O'")
    heads = lines.select(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("mark"))
    items = S.table(spark, base, "part").where("p_size > 10").select(F.col("p_partkey").alias("part"), F.lit(None).cast("string").alias("mark"))
    return heads.union(items).distinct()


@query(
    "difference_u5",
    """SELECT c_custkey AS k FROM customer EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'""",
)
def difference(spark, base):
    customers = S.table(spark, base, "customer").select(F.col("c_custkey").alias("k"))
    recent = S.table(spark, base, "orders").where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return customers.join(recent.select(F.col("o_custkey").alias("k")), "k", "left_anti")


@query(
    "recent_orders_by_group_f1_a1",
    """SELECT o_orderpriority, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS amount FROM orders
       WHERE o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-07-15' GROUP BY 1""",
)
def recent_orders_by_group(spark, base):
    recent = S.table(spark, base, "orders").where(in_last_days(F.col("o_orderdate"), S.AS_OF))
    out = recent.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum(S.money("o_totalprice")).alias("amount"))
    return S.as_double(out, "amount")
