"""Projection, renaming and constant columns."""

from pyspark.sql import functions as F

from reportloom.functions.dates import report_header
from reportloom.operators.project import rename_fields, underscore_names, with_header
from reportloom.operators.ordering import in_category_order
from reportloom.operators.reshape import composite_attribute, pivot_attributes
from reportloom.operators.rollup import occurrences
from reportloom.plans.settings import BACK_LINK
from reportloom.queries import standins as S
from reportloom.queries.registry import query


@query("projection_alias_p1", "SELECT o_orderdate AS order_date, o_orderpriority AS business_group, o_totalprice AS amount FROM orders")
def projection_alias(spark, base):
    return S.table(spark, base, "orders").select(
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("business_group"),
        F.col("o_totalprice").alias("amount"),
    )


@query(
    "field_code_mapping_p2",
    'SELECT event_id AS "Order_Id", user_id AS "Product_Code", event_type AS "Order_Type", value, ts FROM events',
)
def field_code_mapping(spark, base):
    coded = S.table(spark, base, "events").select(
        F.col("event_id").alias("AUFNR"), F.col("user_id").alias("MATNR"), F.col("event_type").alias("AUART"), "value", "ts"
    )
    return rename_fields(coded, {"AUFNR": "Order_Id", "MATNR": "Product_Code", "AUART": "Order_Type", "ZBRAND": "Business_Group"})


_RENAMED = {"system": "opening", "user-2": "user_2_asked"}


@query(
    "renamed_pivot_columns_p3_p4",
    "SELECT CAST(conv_id AS VARCHAR) AS form_id, "
    + ", ".join(
        f"""MAX(text) FILTER (WHERE CASE WHEN turn > 0 THEN role || '-' || turn ELSE role END = '{a}') AS "{_RENAMED.get(a, a)}\""""
        for a in S.TALK_ATTRIBUTES
    )
    + " FROM conversations GROUP BY conv_id",
)
def renamed_pivot_columns(spark, base):
    name = composite_attribute(F.col("name"), F.col("child_name"))
    name = F.when(name == "user-2", "user 2 asked").otherwise(name)
    attributes = ["user 2 asked" if a == "user-2" else a for a in S.TALK_ATTRIBUTES]
    wide = pivot_attributes(S.talk_cells(spark, base), "form_id", attributes, name)
    return rename_fields(underscore_names(wide), {"system": "opening"})


@query("counted_and_named_p5_p6", "SELECT user_id AS crm_code, COUNT(*) AS visit_nums FROM events GROUP BY user_id")
def counted_and_named(spark, base):
    """Counts named where they are made, in an order whose rank column is dropped again, as the status report does it."""
    visits = S.table(spark, base, "events").select(F.col("user_id").alias("crm_code"))
    return in_category_order(occurrences(visits, "crm_code", "visit_nums"), "crm_code", [7, 3, 11], F.col("visit_nums").desc(), "crm_code")


@query(
    "constant_columns_p7",
    f"SELECT event_id, '2024-01-31 10:30:00' AS collected_time, '{BACK_LINK.replace(chr(39), chr(39) * 2)}' AS hyperlink FROM events",
)
def constant_columns(spark, base):
    return S.table(spark, base, "events").select("event_id").withColumns(
        {"collected_time": F.lit(f"{S.NOW:%Y-%m-%d %H:%M:%S}"), "hyperlink": F.lit(BACK_LINK)}
    )


@query(
    "report_header_p8",
    """SELECT c_custkey, '2024-01-31 08:00:00' AS data_time, '2024-01-30' AS report_date, CAST(2024 AS INTEGER) AS report_year,
              CAST(1 AS INTEGER) AS report_month, 'customers' AS sheet_name FROM customer""",
)
def header_values(spark, base):
    df = S.table(spark, base, "customer").select("c_custkey")
    return with_header(df, report_header(S.NOW, "customers", fixed_time="08:00:00"))
