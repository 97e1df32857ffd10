"""The report tables, derived from the generated tables; `SQL` holds the same derivations as CTEs."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from reportloom.plans.settings import PLANT_SUBJECTS, DailyKpiNames
from reportloom.sources.warehouse import read_table

AS_OF = date(2001, 7, 15)  # trade tables
NOW = datetime(2024, 1, 31, 10, 30, 0)  # event and form tables
VISIT_SHIFT = (date(2024, 1, 1) - date(2001, 6, 20)).days  # brings event days next to the trade days

GROUPS = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM"}
FORM_LABELS = {"click": "Offline", "view": "Online", "signup": "Daily report"}

KPI_NAMES = DailyKpiNames(
    groups=GROUPS,
    product_lines={"a": "alpha", "b": "beta", "c": "gamma"},
    categories={"host": "ECONOMY", "part": "PROMO"},
    left_out_of_backlog="SMALL",
    daily_output="purchase",
    plant_subjects=dict(zip(PLANT_SUBJECTS, (f"{kind}-{i}" for kind in ("view", "click", "error", "signup") for i in range(3)), strict=True)),
)


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return read_table(spark, base, name)


def money(c: str) -> Column:
    return F.col(c).cast("decimal(12,2)")


def net_amount() -> Column:
    return money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def order_lines(spark: SparkSession, base: str) -> DataFrame:
    orders = table(spark, base, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    lines = table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", net_amount().alias("amount"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderdate").alias("Order_Date"),
        F.col("o_orderpriority").alias("Business_Group_Name"),
        F.col("l_partkey").alias("Product_Code"),
        F.col("l_quantity").alias("Confimred_Order_Quantity"),
        F.col("amount").alias("Final_Order_Rebate_Amount_Cny"),
    )


def shipment_lines(spark: SparkSession, base: str) -> DataFrame:
    orders = table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = table(spark, base, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_linestatus", "l_shipdate", net_amount().alias("amount")
    )
    return lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("l_shipdate").alias("Stock_Out_Date"),
        F.col("o_orderpriority").alias("Business_Group"),
        F.col("l_partkey").alias("Product_Code"),
        F.col("l_quantity").alias("Stock_Out_Quantity"),
        F.col("amount").alias("Rebate_Sales_Amount_Cny"),
        F.nullif(F.col("o_custkey"), F.lit(5)).cast("string").alias("BOS_Group_Id"),
        "l_linestatus",
    )


def backlog_lines(shipments: DataFrame) -> DataFrame:
    return (
        shipments.where(F.col("l_linestatus") == "O")
        .select(
            F.col("Stock_Out_Date").alias("undelivered_date"),
            F.col("Business_Group").alias("Business_Group_Name"),
            "Product_Code",
            F.col("Stock_Out_Quantity").alias("Undelivered_Quantity"),
            F.col("Rebate_Sales_Amount_Cny").alias("Undelivered_Order_Rebate_Amount_Cny"),
        )
    )


def products(spark: SparkSession, base: str) -> DataFrame:
    """Products with a category; `LARGE` stands for an unknown one."""
    return table(spark, base, "part").select(
        F.col("p_partkey").alias("product_code"), F.nullif(F.col("p_type"), F.lit("LARGE")).alias("product_categories")
    )


def customer_orders(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "orders").select(
        F.nullif(F.col("o_custkey"), F.lit(5)).cast("string").alias("BOS_Group_Id"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("Sales_Representative_Name"),
        money("o_totalprice").alias("Final_Order_Rebate_Amount_Cny"),
        F.col("o_orderdate").alias("Order_Date"),
    )


def customer_places(spark: SparkSession, base: str) -> DataFrame:
    nation = table(spark, base, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_regionkey").alias("r_regionkey"))
    return table(spark, base, "customer").join(nation, "c_nationkey").join(table(spark, base, "region"), "r_regionkey")


def customer_states(spark: SparkSession, base: str) -> DataFrame:
    key = F.col("c_custkey")
    return customer_places(spark, base).select(
        F.nullif(key, F.lit(3)).cast("string").alias("bos_code"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("C"), key.cast("string")).alias("crm_code"),
        F.col("c_mktsegment").alias("sale_org_name"),
        F.nullif(F.col("n_name"), F.lit("NATION_4")).alias("sale_area_name"),
        F.when(F.col("c_acctbal") > 0, "是").otherwise("否").alias("isactive"),
        F.when(F.col("c_acctbal") > 4000, F.floor(F.col("c_acctbal") / 100).cast("int")).alias("no_order_days"),
        F.when(F.col("c_acctbal") > 0, money("c_acctbal")).alias("month_order_amount"),
        F.when(F.col("c_acctbal") > 1000, money("c_acctbal")).alias("last_month_order_amount"),
        F.when(F.col("c_acctbal") > 2000, money("c_acctbal")).alias("month_shipping_amount"),
        F.when(F.col("c_acctbal") > 3000, money("c_acctbal")).alias("last_month_shipping_amount"),
        F.when(F.col("c_acctbal") > 5000, money("c_acctbal")).alias("year_order_amount"),
        F.when(F.col("c_acctbal") > 6000, money("c_acctbal")).alias("year_shipping_amount"),
    )


def crm_customers(spark: SparkSession, base: str) -> DataFrame:
    """One customer has no code on either side, some lack a phone or a mail address."""
    key = F.col("c_custkey")
    text = key.cast("string")
    return customer_places(spark, base).select(
        F.concat(F.lit("C"), F.nullif(key, F.lit(7)).cast("string")).alias("crm_code"),
        F.nullif(key, F.lit(9)).cast("string").alias("bos_code"),
        F.col("c_name").alias("customerName"),
        F.concat(F.lit("B"), text).alias("businessName"),
        F.concat(F.lit("O"), (key % 7).cast("string")).alias("ownerUserName"),
        F.concat(F.lit("P"), text).alias("contactsName"),
        F.col("c_mktsegment").alias("contactsPost"),
        F.when(F.col("c_acctbal") > 1000, F.concat(F.lit("'+1-"), text, F.lit("'"))).alias("contactsMobile"),
        F.when(F.col("c_acctbal") < 6000, F.concat(text, F.lit("@mail"))).alias("email"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "HOME").otherwise("ABROAD").alias("region2"),
        F.nullif(F.col("r_name"), F.lit("ASIA")).alias("region3"),
        F.col("n_name").alias("region4"),
    )


def crm_users(spark: SparkSession, base: str) -> DataFrame:
    nation = table(spark, base, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", F.col("n_regionkey").alias("r_regionkey"))
    joined = table(spark, base, "supplier").join(nation, "s_nationkey").join(table(spark, base, "region"), "r_regionkey")
    key = F.col("s_suppkey")
    return joined.select(
        F.col("s_name").alias("realname"),
        F.concat(F.lit("u"), F.nullif(key, F.lit(4)).cast("string")).alias("systemEmail"),
        F.lit("ABROAD").alias("region2"),
        F.col("r_name").alias("region3"),
        F.col("n_name").alias("region4"),
        F.when(F.col("s_acctbal") > 2000, "Sales").otherwise("Finance").alias("post"),
        F.when(F.col("s_acctbal") > 0, 1).otherwise(0).alias("status"),
    )


def crm_forms(spark: SparkSession, base: str) -> DataFrame:
    """Events as forms; few have no customer. The JSON is an object, a list of two, an empty list or null."""
    user = F.col("user_id").cast("string")
    doc = F.concat(F.lit('{"customerNo": "C'), user, F.lit('"}'))
    return table(spark, base, "events").select(
        F.col("event_id").cast("string").alias("form_id"),
        F.col("event_type").alias("form_key"),
        F.concat(F.lit("T"), user).alias("targetIntro"),
        F.concat(F.lit("N"), user).alias("nickName"),
        F.concat(F.lit("u"), user).alias("email"),
        F.when(F.col("value") >= 1, F.concat(F.lit("C"), user)).alias("crm_code"),
        F.lit("+08:00").alias("time_zone"),
        F.col("ts").alias("createTime"),
        F.col("ts").alias("local_time"),
        F.when(F.col("event_type") == "click", doc)
        .when(F.col("event_type") == "view", F.concat(F.lit("["), doc, F.lit(","), doc, F.lit("]")))
        .when(F.col("event_type") == "error", "[]")
        .alias("otherData"),
    )


def crm_form_cells(spark: SparkSession, base: str, shift_days: int = 0) -> DataFrame:
    """Cells of the event forms: visit date, report date and confirmed amount where they apply."""
    day = F.date_sub(F.col("ts").cast("date"), shift_days).cast("string")
    kind = F.col("event_type")
    cells = F.array(
        F.when(kind != "signup", _cell("Date of Visit", day)),
        F.when(kind == "signup", _cell("Date of Report", day)),
        F.when(kind.isin("click", "view") & (F.col("value") >= 5), _cell("Order Amount Confirmed in the Meeting (CNY)", F.col("value").cast("string"))),
    )
    rows = table(spark, base, "events").select(F.col("event_id").cast("string").alias("form_id"), F.explode(cells).alias("cell"))
    return rows.where(F.col("cell").isNotNull()).select("form_id", "cell.*")


def _cell(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit("").alias("child_name"), value.alias("value"))


def talk_cells(spark: SparkSession, base: str) -> DataFrame:
    """Conversation turns as form cells: the role is the attribute, the turn its child, turn 0 has no child."""
    return table(spark, base, "conversations").select(
        F.col("conv_id").cast("string").alias("form_id"),
        F.col("role").alias("name"),
        F.when(F.col("turn") > 0, F.col("turn").cast("string")).otherwise("").alias("child_name"),
        F.col("text").alias("value"),
        "turn",
    )


TALK_ATTRIBUTES = ["system", "user", *(f"{role}-{turn}" for role in ("user", "assistant") for turn in range(1, 8))]


def comments(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "conversations").select(
        F.col("conv_id").cast("string").alias("form_id"), F.col("text").alias("remark"), "turn"
    )


def kpi_forms(spark: SparkSession, base: str, shift_days: int = 0) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    dimensions = F.array(*[F.lit(v) for v in ("alpha", "beta", "gamma", "alpha", "松岗", "寮步", "大岭山", "外协")])
    return table(spark, base, "events").select(
        F.date_sub(F.col("ts").cast("date"), shift_days).cast("string").alias("ReportDate"),
        F.lit("日报").alias("form_type"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("MA0"),
        F.nullif(k, F.lit(13)).cast("string").alias("MA1"),
        F.lit("KPI").alias("L1Subject1"),
        F.when(F.col("event_type") == "purchase", "purchase").otherwise(F.concat_ws("-", "event_type", (k % 3).cast("string"))).alias("L2Subject2"),
        F.when(k < 50, "by产品线").otherwise("by工厂").alias("L3Subject3"),
        F.element_at(dimensions, F.floor(k / 50).cast("int") * 4 + k % 4 + 1).alias("D1"),
    )


SQL = {
    "so": """so AS (
        SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS g, NULLIF(p_type, 'LARGE') AS c, SUM(l_quantity) AS q,
               SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS a
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
        WHERE o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-07-15'
          AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
        GROUP BY ALL)""",
    "sa": """sa AS (
        SELECT CAST(l_shipdate AS DATE) AS d, o_orderpriority AS g, NULLIF(p_type, 'LARGE') AS c, SUM(l_quantity) AS q,
               SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS a
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
        WHERE l_shipdate >= TIMESTAMP '2001-07-01' AND l_shipdate < TIMESTAMP '2001-07-15'
          AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
        GROUP BY ALL)""",
    "un": """un AS (
        SELECT CAST(l_shipdate AS DATE) AS d, o_orderpriority AS g, NULLIF(p_type, 'LARGE') AS c, SUM(l_quantity) AS q,
               SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS a
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
        WHERE l_shipdate >= TIMESTAMP '2001-07-01' AND l_shipdate < TIMESTAMP '2001-07-15'
          AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
          AND l_linestatus = 'O' AND p_type <> 'SMALL'
        GROUP BY ALL)""",
    "kpi": """kpi AS (
        SELECT CAST(ts AS DATE) AS d, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS m0, CAST(NULLIF(k, 13) AS DOUBLE) AS m1,
               'KPI' AS l1, CASE WHEN event_type = 'purchase' THEN 'purchase' ELSE event_type || '-' || (k % 3) END AS l2, CASE WHEN k < 50 THEN 'by产品线' ELSE 'by工厂' END AS l3,
               CASE WHEN k < 50 THEN CASE k % 4 WHEN 1 THEN 'beta' WHEN 2 THEN 'gamma' ELSE 'alpha' END
                    ELSE CASE k % 4 WHEN 1 THEN '寮步' WHEN 2 THEN '大岭山' WHEN 3 THEN '外协' ELSE '松岗' END END AS d1
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
        WHERE ts >= TIMESTAMP '2024-01-17' AND ts < TIMESTAMP '2024-01-31')""",
    "shifted_kpi": f"""shifted_kpi AS (
        SELECT CAST(CAST(ts AS DATE) - {VISIT_SHIFT} AS DATE) AS d, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS m0,
               CAST(NULLIF(k, 13) AS DOUBLE) AS m1, 'KPI' AS l1, CASE WHEN event_type = 'purchase' THEN 'purchase' ELSE event_type || '-' || (k % 3) END AS l2,
               CASE WHEN k < 50 THEN 'by产品线' ELSE 'by工厂' END AS l3,
               CASE WHEN k < 50 THEN CASE k % 4 WHEN 1 THEN 'beta' WHEN 2 THEN 'gamma' ELSE 'alpha' END
                    ELSE CASE k % 4 WHEN 1 THEN '寮步' WHEN 2 THEN '大岭山' WHEN 3 THEN '外协' ELSE '松岗' END END AS d1
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
        WHERE CAST(ts AS DATE) - {VISIT_SHIFT} BETWEEN DATE '2001-07-01' AND DATE '2001-07-14')""",
    "states": """states AS (
        SELECT CAST(NULLIF(c_custkey, 3) AS VARCHAR) AS bos_code, c_name AS name, 'C' || c_custkey AS crm_code,
               c_mktsegment AS sale_org_name, NULLIF(n_name, 'NATION_4') AS sale_area_name, c_acctbal > 0 AS active,
               CASE WHEN c_acctbal > 4000 THEN CAST(floor(c_acctbal / 100) AS INTEGER) END AS no_order_days,
               CASE WHEN c_acctbal > 0 THEN c_acctbal END AS month_order_amount,
               CASE WHEN c_acctbal > 1000 THEN c_acctbal END AS last_month_order_amount,
               CASE WHEN c_acctbal > 2000 THEN c_acctbal END AS month_shipping_amount,
               CASE WHEN c_acctbal > 3000 THEN c_acctbal END AS last_month_shipping_amount,
               CASE WHEN c_acctbal > 5000 THEN c_acctbal END AS year_order_amount,
               CASE WHEN c_acctbal > 6000 THEN c_acctbal END AS year_shipping_amount
        FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "crm": """crm AS (
        SELECT 'C' || NULLIF(c_custkey, 7) AS crm_code, CAST(NULLIF(c_custkey, 9) AS VARCHAR) AS bos_code,
               c_name AS customerName, 'B' || c_custkey AS businessName, 'O' || (c_custkey % 7) AS ownerUserName,
               'P' || c_custkey AS contactsName, c_mktsegment AS contactsPost,
               CASE WHEN c_acctbal > 1000 THEN '+1-' || c_custkey END AS phone,
               CASE WHEN c_acctbal < 6000 THEN c_custkey || '@mail' END AS email,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'HOME' ELSE 'ABROAD' END AS region2,
               NULLIF(r_name, 'ASIA') AS region3, n_name AS region4
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "users": """users AS (
        SELECT s_name AS realname, 'u' || NULLIF(s_suppkey, 4) AS email, r_name AS region3, n_name AS region4,
               CASE WHEN s_acctbal > 2000 THEN 'Sales' ELSE 'Finance' END AS post, s_acctbal > 0 AS working
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "forms": """forms AS (
        SELECT CAST(event_id AS VARCHAR) AS form_id, event_type AS form_key, 'T' || user_id AS targetIntro,
               'N' || user_id AS nickName, 'u' || user_id AS email, CASE WHEN value >= 1 THEN 'C' || user_id END AS crm_code,
               '+08:00' AS time_zone, ts, value FROM events)""",
    "month_forms": """month_forms AS (
        SELECT * FROM forms WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-30 23:59:59')""",
}


def with_tables(*names: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names)
