"""Joins under both null rules."""

from pyspark.sql import functions as F

from reportloom.operators.joins import (
    attribute_joins,
    in_use,
    left_lookup,
    left_lookup_where,
    left_merge,
    left_merge_large_right,
    merged_rows,
    not_in_use,
    snowflake,
)
from reportloom.queries import standins as S
from reportloom.queries.registry import query


@query(
    "inner_product_join_j1",
    """SELECT l_orderkey, l_partkey, l_quantity, p_type FROM lineitem
       JOIN (SELECT * FROM part WHERE p_size <= 40) ON p_partkey = l_partkey""",
)
def inner_product_join(spark, base):
    known = S.table(spark, base, "part").where(F.col("p_size") <= 40).select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = S.table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(known, "l_partkey")


@query(
    "left_lookup_j2",
    """SELECT d.k, doc_id, quality FROM (SELECT doc_id, NULLIF(doc_id, 3) AS k FROM documents) d
       LEFT JOIN (SELECT NULLIF(doc_id, 4) AS k, quality FROM labels) l ON d.k = l.k""",
)
def sql_left_lookup(spark, base):
    docs = S.table(spark, base, "documents").select("doc_id", F.nullif(F.col("doc_id"), F.lit(3)).alias("k"))
    labels = S.table(spark, base, "labels").select(F.nullif(F.col("doc_id"), F.lit(4)).alias("k"), "quality")
    return left_lookup(docs, labels, "k")


@query(
    "left_lookup_condition_j3",
    """SELECT e.form_id, v.value AS visit_date FROM (SELECT CAST(event_id AS VARCHAR) AS form_id FROM events) e
       LEFT JOIN (SELECT CAST(event_id AS VARCHAR) AS form_id, strftime(ts, '%Y-%m-%d') AS value FROM events WHERE event_type <> 'signup') v
         ON e.form_id = v.form_id""",
)
def left_lookup_condition(spark, base):
    forms = S.crm_forms(spark, base).select("form_id")
    cells = S.crm_form_cells(spark, base)
    df = left_lookup_where(forms, cells, "form_id", F.col("name") == "Date of Visit")
    return df.select("form_id", F.col("value").alias("visit_date"))


@query(
    "three_attribute_joins_j4",
    """SELECT CAST(event_id AS VARCHAR) AS form_id, CASE WHEN event_type <> 'signup' THEN strftime(ts, '%Y-%m-%d') END AS visit_date,
              CASE WHEN event_type IN ('click', 'view') AND value >= 5 THEN CAST(value AS VARCHAR) END AS visit_amount,
              CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d') END AS report_date FROM events""",
)
def three_attribute_joins(spark, base):
    wanted = {
        "visit_date": "Date of Visit",
        "visit_amount": "Order Amount Confirmed in the Meeting (CNY)",
        "report_date": "Date of Report",
    }
    return attribute_joins(S.crm_forms(spark, base).select("form_id"), S.crm_form_cells(spark, base), "form_id", wanted)


@query(
    "snowflake_chain_j5",
    """SELECT l_orderkey, l_partkey, l_suppkey, p_brand, s_name, n_name, r_name FROM lineitem
       LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
       LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
       WHERE p_brand IS NOT NULL AND r_name IN ('ASIA', 'EUROPE')""",
)
def snowflake_chain(spark, base):
    get = lambda name: S.table(spark, base, name)
    wide = snowflake(
        get("lineitem").select("l_orderkey", "l_partkey", "l_suppkey"),
        (get("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"),
        (get("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey")), "l_suppkey"),
        (get("nation").withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey"),
        (get("region"), "r_regionkey"),
    )
    kept = wide.where(F.col("p_brand").isNotNull() & F.col("r_name").isin("ASIA", "EUROPE"))
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "p_brand", "s_name", "n_name", "r_name")


_NULL_SAFE = """SELECT d.k, doc_id, quality FROM (SELECT doc_id, CASE WHEN lang = 'de' THEN NULL ELSE doc_id END AS k FROM documents) d
       LEFT JOIN (SELECT NULLIF(doc_id, (SELECT MIN(doc_id) FROM labels)) AS k, quality FROM labels) l ON d.k IS NOT DISTINCT FROM l.k"""


def _null_safe_sides(spark, base):
    docs = S.table(spark, base, "documents").select("doc_id", F.when(F.col("lang") != "de", F.col("doc_id")).alias("k"))
    labels = S.table(spark, base, "labels")
    first = labels.agg(F.min("doc_id").alias("first"))
    keyed = labels.join(F.broadcast(first), F.col("doc_id") == F.col("first"), "left")
    return docs, keyed.select(F.when(F.col("first").isNull(), F.col("doc_id")).alias("k"), "quality")


@query("null_safe_merge_j6", _NULL_SAFE)
def null_safe_merge(spark, base):
    return left_merge(*_null_safe_sides(spark, base), "k")


@query("null_safe_merge_large_right_j6", _NULL_SAFE)
def null_safe_merge_large_right(spark, base):
    return left_merge_large_right(*_null_safe_sides(spark, base), "k")


@query(
    "merged_rows_j6",
    """SELECT 'documents' AS merge, CAST(count(*) AS BIGINT) AS matches FROM (SELECT CASE WHEN lang = 'de' THEN NULL ELSE doc_id END AS k FROM documents) d
         JOIN (SELECT NULLIF(doc_id, (SELECT MIN(doc_id) FROM labels)) AS k FROM labels) l ON d.k IS NOT DISTINCT FROM l.k
       UNION ALL SELECT 'lines', CAST(sum(n * n) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, NULLIF(l_returnflag, 'R'))""",
)
def merge_sizes(spark, base):
    """Sizes of two merges; the second one, of all lines with all lines of their supplier and flag, is never formed."""
    lines = S.table(spark, base, "lineitem").select("l_suppkey", F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"))
    sizes = {"documents": merged_rows(*_null_safe_sides(spark, base), "k"), "lines": merged_rows(lines, lines, ["l_suppkey", "flag"])}
    parts = [df.select(F.lit(name).alias("merge"), F.col("matches").cast("bigint").alias("matches")) for name, df in sizes.items()]
    return parts[0].unionByName(parts[1])


@query("parts_in_use_j8", "SELECT p_partkey, p_name FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)")
def parts_in_use(spark, base):
    used = S.table(spark, base, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return in_use(S.table(spark, base, "part").select("p_partkey", "p_name"), used, "p_partkey")


@query("parts_not_in_use_j9", "SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)")
def parts_not_in_use(spark, base):
    used = S.table(spark, base, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return not_in_use(S.table(spark, base, "part").select("p_partkey", "p_name"), used, "p_partkey")
