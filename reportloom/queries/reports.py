"""The whole reports on the stand-in tables."""

from datetime import datetime

from pyspark.sql import functions as F

from reportloom.operators.joins import not_in_use
from reportloom.plans import operations_daily as daily
from reportloom.plans.customer_months import customer_months, customer_report, region_spans
from reportloom.plans.customer_status import customer_status
from reportloom.plans.jobs import load_work_orders
from reportloom.plans.sales_followup import sales_report
from reportloom.plans.settings import BACK_LINK, DAILY_BOOK, VISIT_BOOK
from reportloom.plans.shelf_life import bom_view, parts_in_bom, shelf_life_report, stock_lots
from reportloom.plans.visit_reports import visit_reports
from reportloom.plans.work_reports import work_reports
from reportloom.queries import standins as S
from reportloom.queries.calendars import trade_sql
from reportloom.queries.registry import query
from reportloom.queries.reshaping import _PIVOT, _TALK
from reportloom.queries.tables_in_out import dated_payloads, land_feed, new_folder
from reportloom.sinks.files import read_snapshot

_LINK = BACK_LINK.replace("'", "''")


def _kpi_sql() -> str:
    spine = "(SELECT CAST(DATE '2001-07-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(14) t(i))"
    parts = []

    def add(slice_id, body, empty):
        parts.append(f"SELECT '{slice_id}' AS slice_id, d, m0, m1, l1, l2, l3, d1 FROM ({body})")
        parts.append(f"SELECT '{slice_id}', d, {empty} FROM {spine} WHERE d NOT IN (SELECT d FROM ({body}))")

    everything = "0, 0, '0', '0', '0', '0'"
    lines = "l2 = 'purchase' AND l3 = 'by产品线'"
    for short, line in (("a", "alpha"), ("b", "beta"), ("c", "gamma")):
        add(f"cpx_{short}", f"SELECT * FROM shifted_kpi WHERE {lines} AND d1 = '{line}'", everything)
    plants = {"sg": "松岗", "lb": "寮步", "dls": "大岭山"}
    for short, place in {**plants, "wx": "外协"}.items():
        add(f"gc_{short}", f"SELECT * FROM shifted_kpi WHERE l3 = 'by工厂' AND d1 = '{place}'", everything)
    for series, subject in S.KPI_NAMES.plant_subjects.items():
        for short, place in plants.items():
            add(f"{series}_{short}", f"SELECT * FROM shifted_kpi WHERE l2 = '{subject}' AND d1 = '{place}'", everything)
    nothing = "NULL AS l1, NULL AS l2, NULL AS l3, NULL AS d1"
    first = "SELECT d, COALESCE(SUM(m0), 0) AS m0, NULL AS m1, {n} FROM shifted_kpi WHERE {w} GROUP BY d"
    second = "SELECT d, NULL AS m0, COALESCE(SUM(m1), 0) AS m1, {n} FROM shifted_kpi WHERE {w} GROUP BY d"
    both = "SELECT d, COALESCE(SUM(m0), 0) AS m0, COALESCE(SUM(m1), 0) AS m1, {n} FROM shifted_kpi WHERE {w} GROUP BY d"
    for slice_id, body, where, empty in (
        ("cpx_sum", first, lines, "0, NULL"),
        ("gc_sum", first, "l3 = 'by工厂'", "0, NULL"),
        ("rjcz_sum0", first, "l2 = 'view-0'", "0, NULL"),
        ("rjcz_sum1", second, "l2 = 'view-0'", "NULL, 0"),
        ("gcrs_sum", both, "l2 = 'view-1'", "0, 0"),
    ):
        add(slice_id, body.format(n=nothing, w=where), f"{empty}, NULL, NULL, NULL, NULL")
    return "\nUNION ALL ".join(parts)


@query(
    "operations_daily_report",
    f"""WITH trade AS ({trade_sql()}), {S.SQL["shifted_kpi"]}, kpis AS ({_kpi_sql()})
        SELECT slice_id, CAST(strftime("Date", '%Y%m%d') AS INTEGER) AS "Date", "Business_Group", product_categories, "Total_Quantity", "Total_Amount",
               CAST(NULL AS DOUBLE) AS "MA0", CAST(NULL AS DOUBLE) AS "MA1", NULL AS "L1Subject1", NULL AS "L2Subject2", NULL AS "L3Subject3", NULL AS "D1" FROM trade
        UNION ALL SELECT slice_id, CAST(strftime(d, '%Y%m%d') AS INTEGER), NULL, NULL, NULL, NULL, ROUND(m0, 4), m1, l1, l2, l3, d1 FROM kpis""",
)
def operations_daily_report(spark, base):
    shipments = S.shipment_lines(spark, base)
    series = daily.daily_series(
        daily.from_order_table(S.order_lines(spark, base)),
        daily.from_shipment_table(shipments),
        daily.from_backlog_table(S.backlog_lines(shipments)),
        S.products(spark, base),
        S.kpi_forms(spark, base, S.VISIT_SHIFT),
        S.AS_OF,
        S.KPI_NAMES,
    )
    return S.as_double(series, "Total_Amount").withColumn("MA0", F.round("MA0", 4))


SHEETS = ["BUILDING", "MACHINERY"]
PLACES = ["NATION_12", "NATION_3", "NATION_20", "NATION_9", "none"]
_PLACE_RANK = "CASE \"Business_Region\" " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PLACES)) + " END"

_CUSTOMER_MONTHS = (
    S.with_tables("states")
    + f""", o AS (SELECT CAST(NULLIF(o_custkey, 5) AS VARCHAR) AS k, NULLIF(o_orderpriority, '5-LOW') AS rep,
                   CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderdate AS d, strftime(o_orderdate, '%Y-%m') AS m FROM orders),
      so AS (SELECT k, SUM(amount) FILTER (WHERE m = '2001-07') AS this_a, SUM(amount) FILTER (WHERE m = '2001-06') AS last_a,
                    max_by(rep, ROW(d, rep)) FILTER (WHERE m = '2001-07' AND rep IS NOT NULL) AS this_r,
                    max_by(rep, ROW(d, rep)) FILTER (WHERE m = '2001-06' AND rep IS NOT NULL) AS last_r
             FROM o WHERE k IS NOT NULL GROUP BY k),
      s AS (SELECT CAST(NULLIF(o_custkey, 5) AS VARCHAR) AS k, strftime(l_shipdate, '%Y-%m') AS m,
                   CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS a FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
      sa AS (SELECT k, SUM(a) FILTER (WHERE m = '2001-07') AS this_a, SUM(a) FILTER (WHERE m = '2001-06') AS last_a FROM s GROUP BY k),
      v AS (SELECT 'C' || user_id AS code, strftime(CAST(ts AS DATE) - {S.VISIT_SHIFT}, '%Y-%m') AS m, CASE event_type WHEN 'view' THEN 2 ELSE 1 END AS n
            FROM events WHERE event_type IN ('click', 'view')),
      visits AS (SELECT code, SUM(n) FILTER (WHERE m = '2001-07') AS this_n, SUM(n) FILTER (WHERE m = '2001-06') AS last_n FROM v GROUP BY code),
      months AS (SELECT bos_code AS "BOS_Group_Id", name AS "Customer_Name", crm_code, sale_org_name AS "Business_Group_Name",
              COALESCE(sale_area_name, 'none') AS "Business_Region",
              CAST(COALESCE(so.this_a, 0) AS DOUBLE) AS this_month_order_amount, CAST(COALESCE(so.last_a, 0) AS DOUBLE) AS last_month_order_amount,
              so.this_r AS this_month_representative, so.last_r AS last_month_representative,
              CAST(COALESCE(sa.last_a, 0) AS DOUBLE) AS last_month_sales_amount, CAST(COALESCE(sa.this_a, 0) AS DOUBLE) AS this_month_sales_amount,
              CAST(COALESCE(this_n, 0) AS BIGINT) AS this_month_visit_nums, CAST(COALESCE(last_n, 0) AS BIGINT) AS last_month_visit_nums,
              COALESCE(so.this_r, so.last_r) AS "Sales_Representative_Name"
       FROM states LEFT JOIN so ON so.k = bos_code LEFT JOIN sa ON sa.k IS NOT DISTINCT FROM bos_code LEFT JOIN visits ON visits.code = crm_code
       WHERE active AND sale_org_name IN ('BUILDING', 'MACHINERY'))"""
)


def _customer_inputs(spark, base):
    return (
        S.customer_states(spark, base),
        S.customer_orders(spark, base),
        S.shipment_lines(spark, base),
        S.crm_forms(spark, base),
        S.crm_form_cells(spark, base, S.VISIT_SHIFT),
        S.AS_OF,
        SHEETS,
    )


_MONEY = ["this_month_order_amount", "last_month_order_amount", "this_month_sales_amount", "last_month_sales_amount"]


@query("customer_month_report", _CUSTOMER_MONTHS + " SELECT * FROM months")
def customer_month_report(spark, base):
    df = customer_report(*_customer_inputs(spark, base), region_order=PLACES, no_region="none")
    return S.as_double(df, *_MONEY)


@query(
    "customer_month_region_spans",
    _CUSTOMER_MONTHS
    + f""", rows AS (SELECT "Business_Group_Name", "Business_Region", row_number() OVER w + 2 AS pos, lag("Business_Region") OVER w AS before FROM months
            WINDOW w AS (PARTITION BY "Business_Group_Name" ORDER BY {_PLACE_RANK} ASC NULLS LAST, "Sales_Representative_Name" ASC NULLS LAST,
                         this_month_order_amount DESC NULLS LAST, "BOS_Group_Id" ASC NULLS LAST, crm_code)),
       runs AS (SELECT *, SUM(CASE WHEN before IS DISTINCT FROM "Business_Region" THEN 1 ELSE 0 END) OVER (PARTITION BY "Business_Group_Name" ORDER BY pos) AS run FROM rows)
       SELECT "Business_Group_Name", "Business_Region", MIN(pos) AS first_row, MAX(pos) AS last_row FROM runs GROUP BY "Business_Group_Name", run, "Business_Region" """,
)
def customer_month_region_spans(spark, base):
    return region_spans(customer_months(*_customer_inputs(spark, base), region_order=PLACES, no_region="none"))


@query(
    "customer_status_report",
    S.with_tables("states", "crm", "forms")
    + """, visits AS (SELECT crm_code, COUNT(*) AS n FROM forms WHERE form_key IN ('click', 'view') AND crm_code IS NOT NULL AND ts < TIMESTAMP '2024-01-31' GROUP BY crm_code)
       SELECT "customerName", "ownerUserName", region3, region4, crm.crm_code, crm.bos_code,
              COALESCE(last_month_order_amount, 0) AS last_month_order_amount, COALESCE(month_order_amount, 0) AS month_order_amount,
              COALESCE(last_month_shipping_amount, 0) AS last_month_shipping_amount, COALESCE(month_shipping_amount, 0) AS month_shipping_amount,
              COALESCE(n, 0) AS this_month_visit_nums, CAST(0 AS BIGINT) AS last_month_visit_nums,
              '2024-01-31 10:30:00' AS data_time, '2024-01-30' AS report_date, CAST(2024 AS INTEGER) AS report_year, CAST(1 AS INTEGER) AS report_month,
              '客户状况汇总（月）' AS sheet_name
       FROM crm LEFT JOIN states ON crm.bos_code = states.bos_code LEFT JOIN visits ON visits.crm_code = crm.crm_code
       WHERE region2 = 'ABROAD' AND region3 IS NOT NULL AND region4 IS NOT NULL""",
)
def customer_status_report(spark, base):
    df = customer_status(
        S.crm_customers(spark, base),
        S.customer_states(spark, base),
        S.crm_forms(spark, base),
        S.crm_form_cells(spark, base),
        S.NOW,
        department="ABROAD",
        region_order=["EUROPE", "AMERICA"],
        visit_forms=["click", "view"],
    )
    return S.as_double(df, "last_month_order_amount", "month_order_amount", "last_month_shipping_amount", "month_shipping_amount")


def _shown(expression: str) -> str:
    return f"COALESCE(CAST({expression} AS VARCHAR), '--')"


@query(
    "sales_followup_report",
    S.with_tables("users", "crm", "forms", "month_forms")
    + f""", v AS (SELECT email, targetIntro, nickName, form_key, form_id, crm_code, ts,
                CASE form_key WHEN 'click' THEN 'Offline' WHEN 'view' THEN 'Online' ELSE 'Daily report' END AS kind,
                CASE WHEN form_key = 'signup' THEN strftime(ts, '%Y-%m-%d') END AS report_date, strftime(ts, '%Y-%m-%d') AS visit_date,
                CASE WHEN form_key <> 'signup' AND value >= 5 THEN value END AS visit_amount,
                CASE WHEN form_key = 'signup' THEN '=HYPERLINK("[{DAILY_BOOK}]''' || strftime(ts, '%Y-%m-%d') || '工作日报 ' || form_id || '''!A1","查看报告")'
                     ELSE '=HYPERLINK("[{VISIT_BOOK}]''' || strftime(ts, '%Y-%m-%d') || '拜访 ' || form_id || '''!A1","查看报告")' END AS visit_report
              FROM month_forms WHERE form_key IN ('click', 'view', 'signup')),
        p AS (SELECT * FROM users WHERE working AND post IN ('Sales', 'Manager'))
       SELECT {_shown('p.region3')} AS region3, {_shown('p.region4')} AS region4, {_shown('realname')} AS realname, {_shown('p.email')} AS email,
              {_shown('targetIntro')} AS "targetIntro", {_shown('nickName')} AS "nickName", {_shown('kind')} AS form_key, {_shown('form_id')} AS form_id,
              {_shown('ts')} AS "createTime", {_shown('ts')} AS local_time, {_shown('v.crm_code')} AS crm_code, {_shown('visit_date')} AS visit_date,
              {_shown('visit_amount')} AS visit_amount, {_shown('report_date')} AS report_date, {_shown('visit_report')} AS visit_report,
              {_shown('"businessName"')} AS "businessName", kind IS NOT NULL AS has_report,
              '2024-01-31 10:30:00' AS header_data_time, '2024-01-30' AS header_report_date, CAST(2024 AS INTEGER) AS header_report_year,
              CAST(1 AS INTEGER) AS header_report_month, '销售跟进情况汇总（月）' AS header_sheet_name
       FROM p LEFT JOIN v ON p.email IS NOT DISTINCT FROM v.email LEFT JOIN crm ON v.crm_code IS NOT DISTINCT FROM crm.crm_code""",
)
def sales_followup_report(spark, base):
    return sales_report(
        S.crm_users(spark, base),
        S.crm_customers(spark, base),
        S.crm_forms(spark, base),
        S.crm_form_cells(spark, base),
        now=S.NOW,
        department="ABROAD",
        posts=["Sales", "Manager"],
        region_order=["EUROPE", "AMERICA"],
        kinds=S.FORM_LABELS,
    )


@query(
    "work_report_sheets",
    S.with_tables("users", "forms", "month_forms")
    + f""" SELECT "targetIntro", "nickName" AS "Submitter", ts AS "Submit_Time", CAST(ts AS VARCHAR) AS local_time, 'Daily report' AS form_key, f.form_id, f.email,
              CASE WHEN users.email IS NOT NULL THEN 'ABROAD' END AS region2, region3, region4, strftime(ts, '%Y-%m-%d') AS "Date_of_Report",
              strftime(ts, '%Y-%m-%d') AS local_date, '2024-01-31 10:30:00' AS collected_time, '{_LINK}' AS hyperlink,
              strftime(ts, '%Y-%m-%d') || '工作日报 ' || f.form_id AS sheet_name
       FROM month_forms f LEFT JOIN users ON users.email = f.email WHERE form_key = 'signup'""",
)
def work_report_sheets(spark, base):
    return work_reports(
        S.crm_forms(spark, base), S.crm_form_cells(spark, base), S.crm_users(spark, base), ["Date of Report"], S.NOW, form_key="signup"
    )


_TALK_COLUMNS = ", ".join(f'w."{a}" AS "{a}"' for a in S.TALK_ATTRIBUTES)


@query(
    "visit_report_sheets",
    S.with_tables("states", "crm", "forms", "month_forms")
    + f""", w AS (SELECT form_id, {_PIVOT} FROM ({_TALK}) GROUP BY form_id),
        c AS (SELECT CAST(conv_id AS VARCHAR) AS form_id, string_agg(text, chr(13) || chr(10) ORDER BY turn) AS remark FROM conversations GROUP BY conv_id)
       SELECT f."targetIntro" AS "Customer_Name", f."nickName" AS "Submitter", CAST(ts AS VARCHAR) AS "Submit_Time", CAST(ts AS VARCHAR) AS local_time, f.crm_code,
              CASE form_key WHEN 'click' THEN 'Offline' ELSE 'Online' END AS visit_form, f.form_id, f.time_zone, f.email AS sales_email, {_TALK_COLUMNS},
              "contactsName", "contactsPost", phone AS "contactsMobile", crm.email AS email, region3, region4 AS area, crm.bos_code,
              {_shown('no_order_days').replace("'--'", "'暂未接单'")} AS no_order_days,
              COALESCE(month_order_amount, 0) AS month_order_amount, COALESCE(month_shipping_amount, 0) AS month_shipping_amount,
              COALESCE(year_order_amount, 0) AS year_order_amount, COALESCE(year_shipping_amount, 0) AS year_shipping_amount,
              CASE WHEN phone IS NOT NULL AND crm.email IS NOT NULL THEN phone || chr(13) || chr(10) || crm.email ELSE COALESCE(phone, crm.email) END AS combined_contact,
              remark, '2024-01-31 10:30:00' AS collected_time, strftime(ts, '%Y-%m-%d') AS local_date, '{_LINK}' AS hyperlink,
              strftime(ts, '%Y-%m-%d') || '拜访 ' || f.form_id AS sheet_name
       FROM month_forms f LEFT JOIN w ON w.form_id = f.form_id LEFT JOIN crm ON crm.crm_code IS NOT DISTINCT FROM f.crm_code
       LEFT JOIN states ON states.bos_code = crm.bos_code LEFT JOIN c ON c.form_id = f.form_id
       WHERE form_key IN ('click', 'view')""",
)
def visit_report_sheets(spark, base):
    df = visit_reports(
        S.crm_forms(spark, base),
        S.talk_cells(spark, base),
        S.comments(spark, base),
        S.crm_customers(spark, base),
        S.customer_states(spark, base),
        S.TALK_ATTRIBUTES,
        S.NOW,
        comment_order="turn",
        kinds=S.FORM_LABELS,
        form_keys=["click", "view"],
    )
    return S.as_double(df, "month_order_amount", "month_shipping_amount", "year_order_amount", "year_shipping_amount")


STOCK_NOW = datetime(1999, 7, 15, 12, 0)


def _stock(spark, base):
    """Order lines as lots: product with its root, supplier as work centre, nation as cell, region as factory."""
    get = lambda name: S.table(spark, base, name)
    places = get("supplier").join(get("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    inventory = (
        get("lineitem")
        .join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_partkey").alias("ProductId"),
            F.col("l_suppkey").alias("WorkcenterId"),
            F.col("n_nationkey").alias("CellId"),
            F.col("n_regionkey").alias("FactoryId"),
            F.col("l_orderkey").alias("LotSN"),
            F.col("l_quantity").alias("Qty"),
            F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("EntryDate"),
            F.when(F.col("l_linestatus") == "O", 1).when(F.col("l_tax") > 0.04, 0).alias("IsIssueToPickingList"),
            F.when(F.col("l_discount") > 0.05, 2).alias("LotStatus"),
        )
    )
    part = get("part")
    products = part.select(
        F.col("p_partkey").alias("ProductId"),
        F.col("p_brand").alias("ProductRootId"),
        F.col("p_name").alias("ProductDescription"),
        F.col("p_type").alias("ProductDescription_1"),
        (F.col("p_size") * 20).alias("VALIDITY"),
        F.when(F.col("p_type") != "LARGE", F.col("p_size") * 2).alias("MINVALIDITY"),
    )
    roots = part.select(F.col("p_brand").alias("ProductRootId")).distinct().select(
        "ProductRootId",
        F.concat(F.lit("root "), F.col("ProductRootId")).alias("ProductName"),
        F.nullif(F.col("ProductRootId"), F.lit("Brand#7")).alias("WorkcenterName"),
    )
    centres = get("supplier").select(
        F.col("s_suppkey").alias("WorkcenterId"),
        F.when(F.col("s_acctbal") > 3000, "1102").otherwise("9999").alias("WorkcenterName"),
        F.col("s_name").alias("WorkcenterDescription"),
    )
    cells = get("nation").select(F.col("n_nationkey").alias("CellId"), F.col("n_name").alias("CellName"))
    factories = get("region").select(F.col("r_regionkey").alias("FactoryId"), F.col("r_name").alias("FactoryName"))
    return inventory, products, roots, centres, cells, factories


@query(
    "shelf_life_report",
    """WITH lots AS (
         SELECT 'root ' || p_brand AS product_code, p_name AS product_name, p_type AS specs, '1102' AS "WorkcenterName", s_name AS "WorkcenterDescription",
                n_name AS "CellName", l_quantity AS "Qty", r_name AS "FactoryName", l_shipdate, p_size * 20 AS validity, p_size * 2 AS warning, l_orderkey AS "LotSN",
                CAST(p_size * 20 - floor((epoch_us(TIMESTAMP '1999-07-15 12:00:00') - epoch_us(l_shipdate)) / 86400000000.0) AS INTEGER) AS days
         FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
         JOIN region ON r_regionkey = n_regionkey
         WHERE l_returnflag <> 'R' AND l_linestatus <> 'O' AND l_quantity > 0 AND p_type <> 'LARGE' AND p_brand <> 'Brand#7' AND s_acctbal > 3000
           AND s_name LIKE '%Supplier%')
       SELECT product_code, product_name, specs, "WorkcenterName", "WorkcenterDescription", "CellName", "Qty", "FactoryName",
              strftime(l_shipdate, '%Y-%m-%d') AS "EntryDate", CAST(validity AS INTEGER) AS material_validity_period, "LotSN", days AS days_until_expiration,
              CASE WHEN days < 0 THEN 'BG:H' ELSE 'BG:I' END AS days_style, '1999-07-15 08:00:00' AS data_time, '1999-07-15' AS report_date
       FROM lots WHERE days <= warning""",
)
def shelf_life(spark, base):
    lots = stock_lots(*_stock(spark, base), factory="Supplier")
    return shelf_life_report(lots, STOCK_NOW)


def _bom(spark, base):
    """Parts as heads of bills of materials and suppliers as their items."""
    heads = S.table(spark, base, "part").select(
        F.col("p_partkey").alias("self_id"),
        F.lit(1001).alias("WERKS"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("MATNR"),
        F.when(F.col("p_type") == "PROMO", "X").when(F.col("p_type") == "SMALL", "").alias("LOEKZ"),
        F.when(F.col("p_size") > 30, 3).otherwise(1).alias("STLST"),
    )
    items = S.table(spark, base, "supplier").select(
        F.col("s_suppkey").alias("parent_id"),
        F.when(F.col("s_acctbal") > 0, 1001).otherwise(1002).alias("WERKS"),
        F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("IDNRK"),
        F.when(F.col("s_acctbal") > 8000, "X").alias("DUMPS"),
    )
    return heads, items


_BOM = """WITH heads AS (SELECT p_partkey AS self_id, 1001 AS werks, 'P' || p_partkey AS matnr, CASE p_type WHEN 'PROMO' THEN 'X' WHEN 'SMALL' THEN '' END AS loekz,
                      CASE WHEN p_size > 30 THEN 3 ELSE 1 END AS stlst FROM part),
        items AS (SELECT s_suppkey AS parent_id, CASE WHEN s_acctbal > 0 THEN 1001 ELSE 1002 END AS werks, 'P' || s_suppkey AS idnrk,
                         CASE WHEN s_acctbal > 8000 THEN 'X' END AS dumps FROM supplier),
        bom AS (SELECT self_id, h.werks, matnr, parent_id, loekz, stlst, dumps FROM heads h LEFT JOIN items i ON i.idnrk = h.matnr
                WHERE h.werks = 1001 AND (loekz IS NULL OR loekz = '') AND stlst <> 3
                UNION SELECT self_id, i.werks, idnrk, parent_id, loekz, stlst, dumps FROM items i LEFT JOIN heads h ON i.idnrk = h.matnr AND i.werks = h.werks
                WHERE i.werks = 1001 AND (dumps IS NULL OR dumps = ''))"""


@query(
    "bom_union_u4_a11",
    _BOM
    + """ SELECT self_id AS "ID", CAST(werks AS INTEGER) AS "WERKS", matnr AS "MATNR", parent_id AS "PARENT_ID", loekz AS "MARK",
          CAST(stlst AS INTEGER) AS "STATUS", dumps AS "V_STATUS" FROM bom""",
)
def bom_union(spark, base):
    return bom_view(*_bom(spark, base))


@query(
    "scrap_candidates_j9",
    _BOM
    + """ SELECT l_orderkey AS "LotSN", l_quantity AS "Qty", 'P' || l_partkey AS product_code FROM lineitem
          WHERE 'P' || l_partkey NOT IN (SELECT matnr FROM bom)""",
)
def scrap_candidates(spark, base):
    code = F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_code")
    lots = S.table(spark, base, "lineitem").select(F.col("l_orderkey").alias("LotSN"), F.col("l_quantity").alias("Qty"), code)
    used = parts_in_bom(*_bom(spark, base)).withColumnRenamed("MATNR", "product_code")
    return not_in_use(lots, used, "product_code")


_LOADS = (("2024-01-15", "<", datetime(2024, 1, 30, 10, 30)), ("2024-01-10", ">=", S.NOW))  # the second one repeats five days


@query(
    "work_order_load",
    """WITH feed AS (
         SELECT event_id, 0 AS pos, event_id || CASE WHEN event_type = 'view' THEN 'a' ELSE '' END AS code, user_id, event_type, CAST(ts AS DATE) AS d FROM events
         UNION ALL SELECT event_id, 1, event_id || 'b', user_id, event_type, CAST(ts AS DATE) FROM events WHERE event_type = 'view'),
       loads AS (SELECT *, TIMESTAMP '2024-01-30 10:30:00' AS t FROM feed WHERE d < DATE '2024-01-15'
                 UNION ALL SELECT *, TIMESTAMP '2024-01-31 10:30:00' FROM feed WHERE d >= DATE '2024-01-10'),
       rows AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY d, event_id, pos) - 1 AS g, CASE WHEN event_type <> 'error' THEN d END AS e FROM loads)
       SELECT CAST(user_id AS VARCHAR) AS "Product_Code", code AS "Order_Id", strftime(e, '%Y-%m-%d') AS "End_Date", event_type AS "Order_Type",
              strftime(e - CAST((isodow(e) + 1) % 7 AS INTEGER), '%Y%m%d') || strftime(e - CAST((isodow(e) + 1) % 7 AS INTEGER) + 6, '%Y%m%d') AS week_date,
              CAST(e - CAST((isodow(e) + 1) % 7 AS INTEGER) AS DATE) AS week_start, CAST(e - CAST((isodow(e) + 1) % 7 AS INTEGER) + 6 AS DATE) AS week_end,
              t AS "timestamp", strftime(t, '%Y%m%d%H%M%S') || lpad(CAST(g AS VARCHAR), 12, '0') AS id
       FROM rows QUALIFY t = max(t) OVER (PARTITION BY code)""",
)
def work_order_load(spark, base):
    """Payload files of one day each, landed twice and loaded into a table of snapshots; later loads of an order win."""
    folder = new_folder(spark, "orders")
    payloads = dated_payloads(spark, base)
    for i, (day, side, now) in enumerate(_LOADS):
        landed = f"{folder}/feed-{i}"
        land_feed(payloads.where(f"day {side} DATE '{day}'"), landed)
        load_work_orders(spark, f"{landed}/*/*", f"{folder}/table", now)
    return read_snapshot(spark, f"{folder}/table").select(
        "Product_Code", "Order_Id", "End_Date", "Order_Type", "week_date", "week_start", "week_end", "timestamp", "id"
    )
