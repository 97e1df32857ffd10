"""Report order, positions, runs, ids."""

from datetime import datetime

from pyspark.sql import functions as F

from reportloom.operators.keys import latest_per_key, snowflake_parts, with_load_id, with_snowflake_id
from reportloom.operators.ordering import category_rank, urgency_order, value_spans, with_dense_index, with_position
from reportloom.queries import standins as S
from reportloom.queries.registry import query

_ORDER = ["EUROPE", "ASIA", "AMERICA"]
_RANK = "CASE r_name WHEN 'EUROPE' THEN 0 WHEN 'ASIA' THEN 1 WHEN 'AMERICA' THEN 2 END"
_CUSTOMERS = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(
    "descending_order_o1",
    """SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders ORDER BY o_orderdate DESC, o_orderpriority DESC, o_orderkey DESC""",
)
def descending_order(spark, base):
    df = S.table(spark, base, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return df.orderBy(F.col("o_orderdate").desc(), F.col("o_orderpriority").desc(), F.col("o_orderkey").desc())


def _ranked_customers(spark, base):
    df = S.customer_places(spark, base).select("c_custkey", "r_name", "n_name", "c_acctbal", "c_mktsegment")
    return df.withColumn("rank", category_rank(F.col("r_name"), _ORDER).cast("int"))


@query(
    "custom_category_order_o2_o3",
    f"""SELECT c_custkey, r_name, n_name, c_acctbal, CAST({_RANK} AS INTEGER) AS rank FROM {_CUSTOMERS}
        ORDER BY rank ASC NULLS LAST, n_name ASC NULLS LAST, c_acctbal DESC NULLS LAST, c_custkey""",
)
def custom_category_order(spark, base):
    df = _ranked_customers(spark, base).drop("c_mktsegment")
    return df.orderBy(
        F.col("rank").asc_nulls_last(), F.col("n_name").asc_nulls_last(), F.col("c_acctbal").desc_nulls_last(), "c_custkey"
    )


@query("latest_first_o4", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id")
def latest_first(spark, base):
    return S.table(spark, base, "events").select("event_id", "ts").orderBy(F.col("ts").desc(), "event_id")


@query(
    "urgency_order_o5",
    """SELECT c_custkey, CAST(floor(c_acctbal / 100) AS INTEGER) AS days,
              row_number() OVER (ORDER BY floor(c_acctbal / 100) >= 0, abs(floor(c_acctbal / 100)), c_custkey) - 1 AS place FROM customer""",
)
def urgency(spark, base):
    days = F.floor(F.col("c_acctbal") / 100).cast("int")
    df = S.table(spark, base, "customer").select("c_custkey", days.alias("days"))
    return with_dense_index(df, *urgency_order(F.col("days")), "c_custkey", name="place")


@query(
    "load_ids_w1",
    """SELECT event_id, '20240131103000' || lpad(CAST(row_number() OVER (ORDER BY event_id) - 1 AS VARCHAR), 12, '0') AS id FROM events""",
)
def load_ids(spark, base):
    return with_load_id(S.table(spark, base, "events").select("event_id"), "event_id", now=S.NOW)


@query(
    "latest_per_key_w2_j7",
    """WITH e AS (SELECT event_id, NULLIF(user_id, 7) AS k, event_type, value, date_trunc('hour', ts) AS h FROM events)
       SELECT * FROM e WHERE EXISTS (SELECT 1 FROM (SELECT k, MAX(h) AS m FROM e GROUP BY k) t WHERE t.k = e.k AND t.m = e.h)""",
)
def latest_rows(spark, base):
    df = S.table(spark, base, "events").select(
        "event_id", F.nullif(F.col("user_id"), F.lit(7)).alias("k"), "event_type", "value", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("h")
    )
    return latest_per_key(df, "k", "h")


@query(
    "value_spans_w3",
    f"""WITH rows AS (SELECT c_mktsegment AS sheet, n_name, row_number() OVER w + 2 AS pos, lag(n_name) OVER w AS before
                      FROM (SELECT *, {_RANK} AS rank FROM {_CUSTOMERS})
                      WINDOW w AS (PARTITION BY c_mktsegment ORDER BY rank ASC NULLS LAST, floor(c_acctbal / 1000), c_custkey)),
             runs AS (SELECT *, SUM(CASE WHEN before IS DISTINCT FROM n_name THEN 1 ELSE 0 END) OVER (PARTITION BY sheet ORDER BY pos) AS run FROM rows)
        SELECT sheet AS c_mktsegment, n_name, MIN(pos) AS first_row, MAX(pos) AS last_row FROM runs GROUP BY sheet, run, n_name""",
)
def spans(spark, base):
    df = _ranked_customers(spark, base).withColumn("band", F.floor(F.col("c_acctbal") / 1000))
    return value_spans(df, "c_mktsegment", "n_name", F.col("rank").asc_nulls_last(), "band", "c_custkey")


@query(
    "row_positions_w4",
    f"""SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_RANK} ASC NULLS LAST, c_custkey) + 2 AS position
        FROM {_CUSTOMERS}""",
)
def positions(spark, base):
    df = with_position(_ranked_customers(spark, base), "c_mktsegment", F.col("rank").asc_nulls_last(), "c_custkey")
    return df.select("c_custkey", "c_mktsegment", "position")


START_MS = 1706697000000


@query(
    "snowflake_ids_i1",
    f"""WITH e AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS g FROM events)
        SELECT event_id, (({START_MS} - 1288834974657 + g // 58) << 12) | (23 << 6) | (6 + g % 58) AS id,
               {START_MS} + g // 58 AS time_ms, CAST(23 AS BIGINT) AS worker, 6 + g % 58 AS sequence FROM e""",
)
def snowflake_ids(spark, base):
    df = with_snowflake_id(S.table(spark, base, "events").select("event_id"), "event_id", start_ms=START_MS, worker=23)
    return df.withColumns(snowflake_parts(F.col("id")))
