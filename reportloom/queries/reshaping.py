"""Pivot of form cells, JSON documents, records, sheets."""

from pyspark.sql import functions as F

from reportloom.operators.reshape import (
    composite_attribute,
    explode_documents,
    forms_with_attributes,
    normalised_documents,
    pivot_attributes,
    pivot_found_attributes,
    stack_sheets,
    to_records,
    with_sentinel_row,
)
from reportloom.queries import standins as S
from reportloom.queries.registry import query

_PIVOT = ", ".join(
    f"""MAX(text) FILTER (WHERE name = '{a}') AS "{a}\"""" for a in S.TALK_ATTRIBUTES
)
_TALK = "SELECT CAST(conv_id AS VARCHAR) AS form_id, text, CASE WHEN turn > 0 THEN role || '-' || turn ELSE role END AS name FROM conversations"
_LISTED = ", ".join(f"'{a}'" for a in S.TALK_ATTRIBUTES)


@query("pivoted_cells_r1_r2", f"SELECT form_id, {_PIVOT} FROM ({_TALK}) WHERE name IN ({_LISTED}) GROUP BY form_id")
def pivoted_cells(spark, base):
    name = composite_attribute(F.col("name"), F.col("child_name"))
    return pivot_attributes(S.talk_cells(spark, base), "form_id", S.TALK_ATTRIBUTES, name)


@query(
    "forms_with_cells_r1",
    f"""SELECT f.form_id, p.* EXCLUDE (form_id) FROM (SELECT CAST(event_id AS VARCHAR) AS form_id FROM events) f
        LEFT JOIN (SELECT form_id, {_PIVOT} FROM ({_TALK}) GROUP BY form_id) p ON p.form_id = f.form_id""",
)
def forms_with_cells(spark, base):
    name = composite_attribute(F.col("name"), F.col("child_name"))
    forms = S.crm_forms(spark, base).select("form_id")
    return forms_with_attributes(forms, S.talk_cells(spark, base), "form_id", S.TALK_ATTRIBUTES, name)


@query(
    "composite_attribute_r2",
    """SELECT conv_id, turn, CASE WHEN turn > 0 THEN role || '-' || turn ELSE role END AS attribute FROM conversations""",
)
def composite_attributes(spark, base):
    cells = S.talk_cells(spark, base)
    return cells.select(F.col("form_id").cast("bigint").alias("conv_id"), "turn", composite_attribute(F.col("name"), F.col("child_name")).alias("attribute"))


@query(
    "json_documents_r3",
    """SELECT CAST(event_id AS VARCHAR) AS form_id, 'C' || user_id AS "customerNo" FROM events WHERE event_type IN ('click', 'view')
       UNION ALL SELECT CAST(event_id AS VARCHAR), 'C' || user_id FROM events WHERE event_type = 'view'""",
)
def json_documents(spark, base):
    return explode_documents(S.crm_forms(spark, base).select("form_id", "otherData"), "otherData", "customerNo string")


@query(
    "nested_json_documents_r3",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS "props.k", event_type AS kind FROM events""",
)
def nested_json_documents(spark, base):
    events = S.table(spark, base, "events")
    doc = F.concat(F.lit('{"kind": "'), F.col("event_type"), F.lit('", "props": '), F.col("props"), F.lit("}"))
    return explode_documents(events.select("event_id", doc.alias("doc")), "doc", "kind string, props struct<k: bigint>")


@query(
    "found_cells_r1",
    """SELECT l_orderkey, """
    + ", ".join(f"""MAX(value) FILTER (WHERE name = '{c}') AS "{c}\"""" for c in ("A-F", "A-O", "N-F", "N-O", "R-F", "R-O", "linenumber"))
    + """ FROM (SELECT l_orderkey, l_returnflag || '-' || l_linestatus AS name, CAST(COUNT(*) AS VARCHAR) AS value FROM lineitem GROUP BY ALL
          UNION ALL SELECT l_orderkey, 'linenumber', CAST(MAX(l_linenumber) AS VARCHAR) FROM lineitem GROUP BY l_orderkey) GROUP BY l_orderkey""",
)
def found_cells(spark, base):
    """Cells of orders whose attributes are not declared: one per line flag and status, and one without a child name."""
    lines = S.table(spark, base, "lineitem")
    flags = lines.groupBy("l_orderkey", F.col("l_returnflag").alias("name"), F.col("l_linestatus").alias("child")).agg(F.count(F.lit(1)).cast("string").alias("value"))
    numbers = lines.groupBy("l_orderkey").agg(F.lit("linenumber").alias("name"), F.lit("").alias("child"), F.max("l_linenumber").cast("string").alias("value"))
    return pivot_found_attributes(flags.unionByName(numbers), "l_orderkey", composite_attribute(F.col("name"), F.col("child")))


@query(
    "found_documents_r3",
    """WITH e AS (SELECT event_id, event_type, user_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
       SELECT event_id, event_type AS kind, CASE WHEN event_type = 'click' THEN k END AS "props.k", CASE WHEN event_type = 'click' THEN 'u' || user_id END AS "props.user.name",
              CASE WHEN event_type <> 'click' THEN user_id END AS "user", CASE WHEN event_type NOT IN ('click', 'view') THEN CASE WHEN user_id % 2 = 0 THEN CAST(k AS DOUBLE) ELSE k + 0.5 END END AS amount,
              CASE WHEN event_type NOT IN ('click', 'view') THEN k || ',' || (k + 1) END AS ks FROM e
       UNION ALL SELECT event_id, 'view', NULL, NULL, -user_id, NULL, NULL FROM e WHERE event_type = 'view'""",
)
def found_documents(spark, base):
    """Documents with differing keys, no schema given: clicks are nested, views are lists of two, others have a fraction now and then."""
    k, user = F.get_json_object("props", "$.k"), F.col("user_id").cast("string")
    kind = F.concat(F.lit('{"kind":"'), "event_type", F.lit('"'))
    clicks = F.concat(kind, F.lit(',"props":{"k":'), k, F.lit(',"user":{"name":"u'), user, F.lit('"}}}'))
    views = F.concat(F.lit("["), kind, F.lit(',"user":'), user, F.lit("},"), kind, F.lit(',"user":-'), user, F.lit("}]"))
    amount = F.concat(k, F.when(F.col("user_id") % 2 == 0, F.lit("")).otherwise(F.lit(".5")))
    following = (k.cast("bigint") + 1).cast("string")
    rest = F.concat(kind, F.lit(',"user":'), user, F.lit(',"amount":'), amount, F.lit(',"ks":['), k, F.lit(","), following, F.lit("]}"))
    doc = F.when(F.col("event_type") == "click", clicks).when(F.col("event_type") == "view", views).otherwise(rest)
    found = normalised_documents(S.table(spark, base, "events").select("event_id", doc.alias("doc")), "doc")
    return found.withColumn("ks", F.array_join(F.col("ks").cast("array<string>"), ","))


@query(
    "records_r4",
    """SELECT event_id, '{"event_type":"' || event_type || '","user_id":' ||
              CASE WHEN user_id = 7 THEN 'null' ELSE CAST(user_id AS VARCHAR) END || ',"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}' AS record FROM events""",
)
def records(spark, base):
    df = S.table(spark, base, "events").select("event_id", "event_type", F.nullif(F.col("user_id"), F.lit(7)).alias("user_id"), "ts")
    return to_records(df, ["event_id"])


@query(
    "sheets_by_region_r5_k4",
    """SELECT c_custkey, CAST(NULL AS BIGINT) AS s_suppkey, n_name, 'customers' AS sheet_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       UNION ALL SELECT NULL, s_suppkey, n_name, 'suppliers' FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def sheets_by_region(spark, base):
    nation = S.table(spark, base, "nation").select("n_nationkey", "n_name")
    customers = S.table(spark, base, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    suppliers = S.table(spark, base, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return stack_sheets({"customers": customers, "suppliers": suppliers})


@query(
    "sentinel_row_u3",
    """WITH late AS (SELECT event_id, event_type AS sheet_name FROM events WHERE ts >= TIMESTAMP '2030-01-01')
       SELECT * FROM late UNION ALL SELECT NULL, 'no visits' WHERE NOT EXISTS (SELECT 1 FROM late)""",
)
def sentinel_row(spark, base):
    late = S.table(spark, base, "events").where(F.col("ts") >= F.lit("2030-01-01").cast("timestamp_ntz"))
    return with_sentinel_row(late.select("event_id", F.col("event_type").alias("sheet_name")), {"sheet_name": "no visits"})
