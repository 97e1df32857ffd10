"""Sources and sinks: feeds, file choice, appended and replaced tables, written reports."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

from reportloom.functions.dates import in_month
from reportloom.operators.keys import upsert_latest
from reportloom.operators.ordering import with_dense_index, with_position
from reportloom.queries import standins as S
from reportloom.queries.registry import query
from reportloom.session import new_folder
from reportloom.sinks.files import append_rows, facts_of_days, read_snapshot, store_latest, write_by_month, write_report
from reportloom.sources.feed import feed_rows, limit_feed, read_feed
from reportloom.sources.files import last_file, newest_file
from reportloom.sources.ranges import equal_depth_predicates, union_of


@query("warehouse_read_s1", "SELECT p_partkey, p_name, p_retailprice FROM part")
def warehouse_read(spark, base):
    return S.table(spark, base, "part").select("p_partkey", "p_name", "p_retailprice")


@query(
    "equal_depth_read_s1",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type IN ('view', 'click') THEN 7 ELSE user_id END AS k FROM events",
)
def equal_depth_read(spark, base):
    """Events read in parts by a key that is often 7 and often null; both are cut further by the event's id."""
    kind, user = F.col("event_type"), F.col("user_id")
    k = F.when(kind.isin("view", "click"), F.lit(7).cast("bigint")).when(kind != "error", user).alias("k")
    events = S.table(spark, base, "events").select("event_id", k)
    return union_of(events, equal_depth_predicates(events, "k", 16, "event_id"))


@query(
    "facts_of_days_j1_f4",
    """SELECT l_orderkey, l_linenumber, l_quantity, p_type FROM lineitem JOIN part ON p_partkey = l_partkey
       WHERE CAST(l_shipdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate >= DATE '2001-07-01' AND o_orderdate < DATE '2001-08-01' AND o_orderpriority = '1-URGENT')""",
)
def facts_of_chosen_days(spark, base):
    """Shipments stored by month, of the days in July on which urgent orders came, with their products."""
    folder = new_folder(spark, "shipments")
    lines = S.table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    write_by_month(lines, folder, "l_shipdate")
    july = S.table(spark, base, "orders").where(in_month(F.col("o_orderdate"), S.AS_OF) & (F.col("o_orderpriority") == "1-URGENT"))
    days = july.select(F.col("o_orderdate").alias("l_shipdate"))
    kept = facts_of_days(spark.read.parquet(folder), days, "l_shipdate")
    parts = S.table(spark, base, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return kept.join(parts, "l_partkey").select("l_orderkey", "l_linenumber", "l_quantity", "p_type")


def feed_payloads(spark, base, *more):
    """One payload per event: a single order object, or for views a list of two orders; `more` are further columns."""
    end = F.when(F.col("event_type") == "error", "0000-00-00").otherwise(F.date_format("ts", "yyyy-MM-dd"))

    def order(suffix):
        return F.to_json(
            F.struct(
                F.concat(F.col("event_id").cast("string"), F.lit(suffix)).alias("AUFNR"),
                F.col("user_id").cast("string").alias("MATNR"),
                end.alias("GLTRP"),
                F.col("event_type").alias("AUART"),
            )
        )

    data = F.when(F.col("event_type") == "view", F.concat(F.lit("["), order("a"), F.lit(","), order("b"), F.lit("]"))).otherwise(order(""))
    return S.table(spark, base, "events").select("event_id", data.alias("DATA"), *more)


def dated_payloads(spark, base):
    """Payloads of events that have an id, with their day."""
    return feed_payloads(spark, base, F.col("ts").cast("date").alias("day")).where(F.col("event_id").isNotNull())


#: Payloads in a landed file.
PAYLOADS_PER_FILE = 20_000


def land_feed(payloads, folder):
    """JSON files of a day and at most `PAYLOADS_PER_FILE` payloads each; the files' times follow the days, and within a day their
    folders' numbers follow the event ids."""
    lists = F.when(F.startswith("DATA", F.lit("[")), F.expr("substring(DATA, 2, length(DATA) - 2)")).otherwise(F.col("DATA"))
    placed = with_dense_index(payloads, "day", "event_id", name="place", key=["event_id"])
    block = F.lpad(F.floor(F.col("place") / PAYLOADS_PER_FILE).cast("string"), 9, "0").alias("block")
    ordered = F.array_sort(F.collect_list(F.struct("event_id", lists.alias("orders"))))
    joined = F.array_join(F.transform(ordered, lambda x: x["orders"]), ",")
    files = placed.groupBy("day", block).agg(F.concat(F.lit('{"DATA": ['), joined, F.lit("]}")).alias("value"))
    spark = payloads.sparkSession
    files.repartition("day", "block").write.partitionBy("day", "block").text(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(path(f"{folder}/day=*/block=*/part-*")):
        day = datetime.strptime(status.getPath().getParent().getParent().getName(), "day=%Y-%m-%d")
        fs.setTimes(status.getPath(), int(day.replace(tzinfo=UTC).timestamp() * 1000), -1)


_FEED = """WITH feed AS (
     SELECT event_id, 0 AS pos, event_id || CASE WHEN event_type = 'view' THEN 'a' ELSE '' END AS code, user_id, event_type, ts FROM events
     UNION ALL SELECT event_id, 1, event_id || 'b', user_id, event_type, ts FROM events WHERE event_type = 'view')"""


@query(
    "order_feed_s2",
    _FEED + """ SELECT event_id, CAST(pos AS INTEGER) AS pos, code AS "AUFNR", CAST(user_id AS VARCHAR) AS "MATNR",
       CASE WHEN event_type = 'error' THEN '0000-00-00' ELSE strftime(ts, '%Y-%m-%d') END AS "GLTRP", event_type AS "AUART" FROM feed""",
)
def order_feed(spark, base):
    rows = feed_rows(feed_payloads(spark, base), fields=["AUFNR", "MATNR", "GLTRP", "AUART"])
    return rows.withColumnRenamed("__pos", "pos")


@query(
    "order_documents_s2",
    _FEED + """ SELECT CAST(ts AS DATE) AS day, code AS "AUFNR", CAST(user_id AS VARCHAR) AS "MATNR",
       CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id, pos) - 1 AS BIGINT) AS place, event_type AS "AUART" FROM feed""",
)
def order_documents(spark, base):
    """The feed landed as one document per day and block, and read back in byte ranges; `place` counts through the day's documents."""
    folder = new_folder(spark, "documents")
    land_feed(dated_payloads(spark, base), folder)
    rows = read_feed(spark, f"{folder}/*/*", ["AUFNR", "MATNR", "AUART"])
    day = F.to_date(F.regexp_extract("__file", r"day=([0-9-]+)", 1))
    placed = with_position(rows.withColumn("day", day), "day", "__file", "__pos", first_row=0, name="place")
    return placed.select("day", "AUFNR", "MATNR", "place", "AUART")


@query(
    "feed_range_s3",
    _FEED + """ SELECT event_id, code AS "AUFNR", strftime(ts, '%Y-%m-%d') AS "GLTRP" FROM feed
       WHERE event_type <> 'error' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND event_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def feed_range(spark, base):
    rows = feed_rows(feed_payloads(spark, base), fields=["AUFNR", "GLTRP"])
    wanted = S.table(spark, base, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("event_id"))
    return limit_feed(rows, "GLTRP", "2024-01-05", "2024-01-20", "event_id", wanted).select("event_id", "AUFNR", "GLTRP")


@query(
    "newest_file_s4",
    """SELECT url AS path FROM pages WHERE url NOT LIKE '%/fr/%' ORDER BY page_id DESC LIMIT 1""",
)
def newest(spark, base):
    """Pages as a file listing; French pages stand for the `~` names that are skipped."""
    french = F.col("url").contains("/fr/")
    name = F.element_at(F.split("url", "/"), -1)
    listing = S.table(spark, base, "pages").select(
        F.col("url").alias("path"), F.when(french, F.concat(F.lit("~"), name)).otherwise(name).alias("file_name"), F.col("page_id").alias("modificationTime")
    )
    return newest_file(listing)


#: Events in a file of the folder that is searched for its newest one.
EVENTS_PER_FILE = 400


@query(
    "last_file_s4",
    f"""SELECT event_id, event_type, user_id FROM events
        WHERE event_id // {EVENTS_PER_FILE} = (SELECT max(event_id // {EVENTS_PER_FILE}) FROM events WHERE event_id // {EVENTS_PER_FILE} < (SELECT max(event_id // {EVENTS_PER_FILE}) FROM events))""",
)
def newest_real_file(spark, base):
    """Files of some events each, with times that follow their ids; the name of the newest begins with `~`. The folder is listed, and
    the newest other file is read."""
    folder = new_folder(spark, "files")
    events = S.table(spark, base, "events").select("event_id", "event_type", "user_id")
    events.withColumn("block", F.floor(F.col("event_id") / EVENTS_PER_FILE)).repartition("block").write.partitionBy("block").parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    blocks = {int(s.getPath().getParent().getName().removeprefix("block=")): s.getPath() for s in fs.globStatus(path(f"{folder}/block=*/part-*"))}
    fs.mkdirs(path(f"{folder}/files"))
    for block, found in blocks.items():
        place = path(f"{folder}/files/{'~' if block == max(blocks) else ''}events-{block}.parquet")
        fs.rename(found, place)
        fs.setTimes(place, (1_700_000_000 + block) * 1000, -1)
    return spark.read.parquet(last_file(spark, f"{folder}/files/*"))


@query(
    "appended_batches_k1",
    "SELECT event_id, user_id FROM events WHERE event_type <> 'view' UNION ALL SELECT event_id, user_id FROM events WHERE event_type <> 'click'",
)
def appended_batches(spark, base):
    folder = new_folder(spark, "appended")
    events = S.table(spark, base, "events")
    append_rows(events.where("event_type <> 'view'").select("event_id", "user_id"), folder)
    append_rows(events.where("event_type <> 'click'").select("event_id", "user_id"), folder)
    return spark.read.parquet(folder)


_LATEST = """WITH e AS (SELECT user_id, event_id, event_type, value FROM events)
    SELECT e.* FROM e JOIN (SELECT user_id, MAX(event_id) AS m FROM e GROUP BY user_id) t ON e.user_id = t.user_id AND e.event_id = t.m"""


def _batches(spark, base):
    events = S.table(spark, base, "events").select("user_id", "event_id", "event_type", "value")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    days = S.table(spark, base, "events").select("event_id", "ts")
    early = events.join(days.where(F.col("ts") < cut).select("event_id"), "event_id", "left_semi")
    late = events.join(days.where(F.col("ts") >= cut).select("event_id"), "event_id", "left_semi")
    return early, late


@query("upserted_rows_k2", _LATEST)
def upserted_rows(spark, base):
    early, late = _batches(spark, base)
    return upsert_latest(early, late, "user_id", "event_id")


@query("versioned_table_k2", _LATEST)
def versioned_table(spark, base):
    """Three loads, each a new snapshot; the last one repeats a batch."""
    early, late = _batches(spark, base)
    folder = new_folder(spark, "snapshots")
    for batch in (early, late, late):
        store_latest(spark, folder, batch, "user_id", "event_id")
    return read_snapshot(spark, folder).select("user_id", "event_id", "event_type", "value")


@query(
    "partitioned_report_k3_r5",
    """SELECT c_custkey, n_name, r_name, row_number() OVER (ORDER BY c_custkey) - 1 AS position
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def partitioned_report(spark, base):
    folder = new_folder(spark, "report")
    report = S.customer_places(spark, base).select("c_custkey", "n_name", "r_name").orderBy("c_custkey")
    write_report(report, folder, partition_by=["r_name"])
    return with_dense_index(spark.read.parquet(folder), "report_position", name="position").select("c_custkey", "n_name", "r_name", "position")
