"""Scalar expressions."""

from pyspark.sql import functions as F

from reportloom.functions.dates import int_date, text_date_to_int
from reportloom.functions.text import (
    contact_lines,
    day_prefix,
    decode,
    expiry_style,
    first_known,
    none_to_dashes,
    row_height,
    sheet_title,
    style_code,
    week_digits,
    with_style,
    without_quotes,
    without_style,
    workbook_link,
)
from reportloom.operators.project import fill_all_as_text, sentinel_to_null
from reportloom.plans.settings import VISIT_BOOK, VISIT_TITLE
from reportloom.queries import standins as S
from reportloom.queries.registry import query


def _labelled(spark, base):
    docs = S.table(spark, base, "documents").select("doc_id", "lang")
    return docs.join(S.table(spark, base, "labels"), "doc_id", "left")


@query(
    "constant_fill_x1",
    """SELECT doc_id, COALESCE(quality, 0) AS quality, COALESCE(CAST(toxic AS VARCHAR), 'unknown') AS toxic
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def constant_fill(spark, base):
    df = _labelled(spark, base).select("doc_id", "quality", F.col("toxic").cast("string").alias("toxic"))
    return df.fillna({"quality": 0, "toxic": "unknown"})


@query(
    "dashes_for_nulls_x2",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, COALESCE(CAST(quality AS VARCHAR), '--') AS quality, COALESCE(CAST(toxic AS VARCHAR), '--') AS toxic
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def dashes_for_nulls(spark, base):
    return fill_all_as_text(_labelled(spark, base))


@query("first_known_x3", "SELECT doc_id, COALESCE(quality, CAST(n_chars AS INTEGER)) AS known FROM documents LEFT JOIN labels USING (doc_id)")
def two_sources(spark, base):
    df = S.table(spark, base, "documents").join(S.table(spark, base, "labels"), "doc_id", "left")
    return df.select("doc_id", first_known(F.col("quality"), F.col("n_chars").cast("int")).alias("known"))


@query(
    "decoded_values_x4",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'Offline' WHEN 'view' THEN 'Online' WHEN 'signup' THEN 'Daily report' ELSE event_type END AS kind FROM events""",
)
def decoded_values(spark, base):
    return S.table(spark, base, "events").select("event_id", decode(F.col("event_type"), S.FORM_LABELS).alias("kind"))


@query(
    "sentinel_to_null_x5",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day, o_orderpriority FROM orders""",
)
def sentinel_dates(spark, base):
    day = F.when(F.col("o_orderstatus") == "P", "0000-00-00").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return sentinel_to_null(S.table(spark, base, "orders").select("o_orderkey", day.alias("day"), "o_orderpriority"))


@query(
    "casts_x6_x7_x8_x9",
    """SELECT event_id, CAST(CAST(value AS VARCHAR) AS DOUBLE) AS number, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day_number,
              CAST(event_id AS VARCHAR) AS id_text, CAST(user_id AS INTEGER) AS user_number FROM events""",
)
def casts(spark, base):
    return S.table(spark, base, "events").select(
        "event_id",
        F.col("value").cast("string").cast("double").alias("number"),
        text_date_to_int(F.date_format("ts", "yyyy-MM-dd")).alias("day_number"),
        F.col("event_id").cast("string").alias("id_text"),
        F.col("user_id").cast("int").alias("user_number"),
    )


@query(
    "text_parts_x10_x13",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS local_date, strftime(ts, '%Y-%m-%d') || '拜访 ' || event_id AS sheet_name FROM events""",
)
def text_parts(spark, base):
    return S.table(spark, base, "events").select(
        "event_id", day_prefix(F.col("ts")).alias("local_date"), sheet_title(F.col("ts"), VISIT_TITLE, F.col("event_id")).alias("sheet_name")
    )


@query(
    "contacts_x11_x14",
    S.with_tables("crm")
    + """ SELECT customerName AS "customerName", phone AS "contactsMobile", CASE WHEN phone IS NOT NULL AND email IS NOT NULL
          THEN phone || chr(13) || chr(10) || email WHEN phone IS NOT NULL THEN phone ELSE email END AS combined_contact FROM crm""",
)
def contacts(spark, base):
    df = S.crm_customers(spark, base).withColumn("contactsMobile", without_quotes(F.col("contactsMobile")))
    return df.select("customerName", "contactsMobile", contact_lines(F.col("contactsMobile"), F.col("email")).alias("combined_contact"))


@query(
    "bracket_removal_x12",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || strftime(o_orderdate + INTERVAL 6 DAY, '%Y%m%d') AS week_digits FROM orders""",
)
def bracket_removal(spark, base):
    d = F.col("o_orderdate").cast("date")
    text = F.concat(F.lit("('"), F.date_format(d, "yyyyMMdd"), F.lit("'-'"), F.date_format(F.date_add(d, 6), "yyyyMMdd"), F.lit("')"))
    return S.table(spark, base, "orders").select("o_orderkey", week_digits(text).alias("week_digits"))


@query(
    "conditional_links_x15_x16",
    f"""SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN '=HYPERLINK("[{VISIT_BOOK}]''' || strftime(ts, '%Y-%m-%d') || '拜访 ' || event_id
               || '''!A1","查看报告")' END AS visit_report FROM events""",
)
def conditional_links(spark, base):
    link = workbook_link(VISIT_BOOK, sheet_title(F.col("ts"), VISIT_TITLE, F.col("event_id")))
    return S.table(spark, base, "events").select("event_id", F.when(F.col("event_type").isin("click", "view"), link).alias("visit_report"))


@query(
    "report_date_override_x17_x18",
    """SELECT event_id, CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) ELSE DATE '2024-02-01' END AS visit_date, value >= 1 AS has_report FROM events""",
)
def report_date_override(spark, base):
    day = F.when(F.col("event_type") == "signup", F.col("ts").cast("date")).otherwise(F.lit("2024-02-01").cast("date"))
    code = F.when(F.col("value") >= 1, F.col("user_id"))
    return S.table(spark, base, "events").select("event_id", day.alias("visit_date"), code.isNotNull().alias("has_report"))


@query(
    "formatted_dates_x19",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS entry_date, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_number FROM orders",
)
def formatted_dates(spark, base):
    return S.table(spark, base, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("entry_date"), int_date(F.col("o_orderdate")).alias("day_number")
    )


@query(
    "style_marks_x20_x21",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'BG:H' ELSE 'BG:I' END AS style,
              CASE WHEN c_acctbal < 0 THEN '[[BG:H]]' ELSE '[[BG:I]]' END AS code, CAST(CAST(floor(c_acctbal) AS INTEGER) AS VARCHAR) AS text FROM customer""",
)
def style_marks(spark, base):
    days = F.floor("c_acctbal").cast("int")
    df = S.table(spark, base, "customer").select("c_custkey", expiry_style(days).alias("style"), with_style(expiry_style(days), days).alias("marked"))
    return df.select("c_custkey", "style", style_code(F.col("marked")).alias("code"), without_style(F.col("marked")).alias("text"))


@query(
    "bracketed_texts_x21",
    r"""SELECT page_id, NULLIF(regexp_extract(marked, '\[\[[^\n]*\]\]'), '') AS code,
               CASE WHEN regexp_extract(marked, '\[\[[^\n]*\]\]') = '' THEN marked ELSE replace(marked, regexp_extract(marked, '\[\[[^\n]*\]\]'), '') END AS text
        FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE '[[FT:A]]' || url || ']]' || chr(10) || 'x]]' END AS marked FROM pages)""",
)
def bracketed_texts(spark, base):
    marked = F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.concat(F.lit("[[FT:A]]"), F.col("url"), F.lit("]]\nx]]")))
    df = S.table(spark, base, "pages").select("page_id", marked.alias("marked"))
    return df.select("page_id", style_code(F.col("marked")).alias("code"), without_style(F.col("marked")).alias("text"))


@query(
    "none_texts_and_heights_x22_x23",
    """SELECT conv_id, turn, CASE WHEN role = 'system' THEN '--' ELSE role END AS shown,
              CAST(20 * (1 + length(text) - length(replace(text, chr(10), ''))) AS INTEGER) AS height FROM conversations""",
)
def none_texts_and_heights(spark, base):
    role = F.when(F.col("role") == "system", "None").otherwise(F.col("role"))
    return S.table(spark, base, "conversations").select("conv_id", "turn", none_to_dashes(role).alias("shown"), row_height(F.col("text")).alias("height"))
