"""Distributed positions and runs against brute force, and the plans that large tables depend on."""

import os
import random
from contextlib import contextmanager
from datetime import date, datetime
from itertools import groupby
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from reportloom.functions import dates
from reportloom.operators import joins, keys, ordering, reshape, rollup, spine
from reportloom.queries import QUERIES
from reportloom.session import shared_dir
from reportloom.sinks.files import write_report
from reportloom.sources.files import last_file

BASE = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan_of(df)


def sheet_rows(seed, empties):
    rng = random.Random(seed)
    values = ["a", "a", "b", "c"] + ([None, ""] if empties else [])
    weights = [8, 8, 6, 2] + ([0.05, 0.05] if empties else [])
    sheets = ["s1"] * 6 + ["s2", "s3", None]
    return [(i, rng.choice(sheets), rng.choices(values, weights)[0]) for i in rng.sample(range(5000), 1500)]


def in_report_order(data):
    ordered = sorted(data, key=lambda r: (r[1] is not None, r[1] or "", r[0]))
    return {sheet: list(part) for sheet, part in groupby(ordered, key=lambda r: r[1])}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("empties", [False, True])
def test_spans_against_loop(spark, seed, empties):
    data = sheet_rows(seed, empties)
    df = spark.createDataFrame(data, "i int, sheet string, v string").repartition(5)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = {tuple(r) for r in ordering.value_spans(df, "sheet", "v", "i").collect()}
    want = set()
    for sheet, part in in_report_order(data).items():
        start, current = 3, None
        read = []
        for _, _, v in part:
            if not v:
                break
            read.append(v)
        for n, v in enumerate(read):
            if n == 0 or v != current:
                start, current = n + 3, v
            if n + 1 == len(read) or read[n + 1] != v:
                want.add((sheet, v, start, n + 3))
    assert got == want


def test_positions_against_loop(spark):
    data = sheet_rows(4, True)
    df = spark.createDataFrame(data, "i int, sheet string, v string").repartition(5)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = {(r.i, r.position) for r in ordering.with_position(df, "sheet", "i").collect()}
    assert got == {(i, n + 3) for part in in_report_order(data).values() for n, (i, _, _) in enumerate(part)}


def test_dense_index_is_dense(spark):
    df = spark.range(3000).withColumn("k", F.hash("id")).repartition(7)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        out = ordering.with_dense_index(df, F.col("k").desc(), "id")
        rows = sorted(out.collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in rows] == list(range(3000))
    assert [r.k for r in rows] == sorted((r.k for r in rows), reverse=True)
    assert out.columns == ["id", "k", "row_index"]


def test_empty_frames(spark):
    df = spark.createDataFrame([], "i int, sheet string, v string")
    assert ordering.value_spans(df, "sheet", "v", "i").count() == 0
    assert ordering.with_dense_index(df, "i").count() == 0
    assert keys.latest_per_key(df, "sheet", "i").count() == 0


def test_repeated_keys_are_an_error(spark):
    """Inside a range and wherever ranges meet: equal keys always lie in one range."""
    for twice in (0, 7, 1499, 2999):
        df = spark.range(3000).union(spark.range(twice, twice + 1)).withColumn("sheet", F.lit("s")).repartition(6)
        for use in (
            lambda df: ordering.with_dense_index(df, "id"),
            lambda df: ordering.with_position(df, "sheet", "id"),
            lambda df: keys.with_load_id(df, "id", now=datetime(2024, 1, 1), name="t"),
            lambda df: keys.with_snowflake_id(df, "id", start_ms=1_700_000_000_000, name="t"),
        ):
            with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
                with pytest.raises(Exception, match="several rows have one key"):
                    use(df).collect()
    with pytest.raises(ValueError, match="name the key"):
        ordering.with_dense_index(spark.range(3), F.col("id").desc())


def test_index_takes_null_keys_and_carries_keys_only(spark):
    df = spark.range(500).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    out = ordering.with_dense_index(df, F.col("k").asc_nulls_last(), key=["k"])
    assert {r.k: r.row_index for r in out.collect()} == {**{i: i - 1 for i in range(1, 500)}, None: 499}
    stored = out._jdf.queryExecution().optimizedPlan().toString()
    kept = [line for line in stored.splitlines() if "LogicalRDD" in line]
    assert kept and all("wide" not in line for line in kept)


def test_spans_of_ambiguous_rows_are_an_error(spark):
    rows = [(i, "s", "a") for i in range(50)] + [(50, "s", "x"), (50, "s", "x")]
    df = spark.createDataFrame(rows, "i int, sheet string, v string")
    assert [tuple(r) for r in ordering.value_spans(df, "sheet", "v", "i").orderBy("first_row").collect()] == [("s", "a", 3, 52), ("s", "x", 53, 54)]
    with pytest.raises(Exception, match="rows of one key have different values"):
        ordering.value_spans(df.union(spark.createDataFrame([(50, "s", "y")], df.schema)), "sheet", "v", "i").collect()


def test_spans_read_their_input_twice_at_most(spark):
    """Once to sample the ranges, once to write them; two windows over the rows, the others over one row per range."""
    df = spark.range(2000).select(F.col("id").alias("i"), F.lit("s").alias("sheet"), (F.col("id") / 7).cast("int").cast("string").alias("v"))
    plan = ordering.value_spans(df, "sheet", "v", "i")._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in plan  # the lazy part starts from what was stored
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert sum("partitionBy" in line or "__local" in line for line in windows) <= 4  # segments are made for the rows and for the summary


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([("k", i, i % 3) for i in range(90)] + [(None, 5, 0)], "k string, i int, o int")
    out = keys.latest_per_key(df, "k", "o")
    assert sorted(r.i for r in out.collect()) == list(range(2, 90, 3))
    plan = plan_of(out)
    partial = plan.index("WindowGroupLimit", plan.index("WindowGroupLimit") + 1)
    assert "Exchange" in plan[:partial]


def test_upserts_agree(spark):
    rng = random.Random(5)
    table = [(f"k{rng.randrange(40)}", i, "old") for i in range(200)]
    batch = [(f"k{rng.randrange(60)}", 150 + i, "new") for i in range(80)] + [(None, 999, "null")]
    schema = "k string, id int, v string"
    clean = keys.latest_per_key(spark.createDataFrame(table, schema), "k", "id")
    new = spark.createDataFrame(batch, schema)
    want = sorted(map(tuple, keys.upsert_latest(clean, new, "k", "id").collect()))
    brute = {}
    for k, i, v in sorted(table + batch[:-1], key=lambda r: r[1]):
        brute.setdefault(k, {}).setdefault(i, set()).add(v)
    assert want == sorted((k, max(ids), v) for k, ids in brute.items() for v in ids[max(ids)])
    assert sorted(map(tuple, keys.upsert_into_clean(clean, new, "k", "id").collect())) == want


SKEW = dict(
    spark__sql__autoBroadcastJoinThreshold=-1,
    spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
    spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    spark__sql__adaptive__coalescePartitions__enabled="false",
)


def hot(spark, n=40000):
    """A third of the rows share one key."""
    k = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 500).cast("string"))
    return spark.range(0, n, 1, 8).select("id", k.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_hot_null_key_on_the_left_is_split(spark):
    right = spark.range(500).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    with settings(spark, **SKEW):
        out = joins.left_merge(hot(spark), right, "k")
        assert "skew=true" in final_plan(out)
    assert out.count() == 40000 and out.where("k IS NULL AND v = 0").count() == hot(spark).where("k IS NULL").count()


def test_hot_key_on_the_right_is_split(spark):
    left = spark.range(700).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("u"))
    with settings(spark, **SKEW):
        out = joins.left_merge_large_right(left, hot(spark), "k", max_null_matches=10**9)
        assert "skew=true" in final_plan(out)
    matched = hot(spark).where("k IS NULL OR k <> '0'").count()
    assert out.where("id IS NOT NULL").count() == matched
    assert out.where("id IS NULL").count() == 700 - hot(spark).where("k IS NULL OR k <> '0'").select("k").distinct().count()


def test_form_with_a_third_of_the_cells_is_split(spark):
    header = spark.range(600).select(F.col("id").cast("string").alias("form_id"))
    cells = hot(spark).select(F.coalesce("k", F.lit("7")).alias("form_id"), F.lit("a").alias("name"), F.col("pad").alias("value"))
    cells = cells.union(header.where("form_id = '7'").select("form_id", F.lit("b"), F.lit("only")))
    with settings(spark, **SKEW):
        out = joins.attribute_joins(header, cells, "form_id", {"x": "a", "y": "b"})
        assert "skew=true" in final_plan(out)
    plain = header.join(cells.where("name = 'a'").select("form_id", F.col("value").alias("x")), "form_id", "left").join(
        cells.where("name = 'b'").select("form_id", F.col("value").alias("y")), "form_id", "left"
    )
    assert out.count() == plain.count() and out.exceptAll(plain).count() == 0


def test_null_keys_match_up_to_a_limit(spark):
    left = spark.createDataFrame([(None, 1), (None, 3), ("a", 2)], "k string, l int")
    right = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("a", 5)], "k string, r int")
    for merge in (joins.left_merge, joins.left_merge_large_right):
        assert merge(left, right, "k", max_null_matches=4).count() == 7
        assert merge(left, right, "k", max_null_matches=None).count() == 7
        with pytest.raises(Exception, match="null keys match in 4 pairs of rows, more than 3"):
            merge(left, right, "k", max_null_matches=3).collect()
        assert merge(left, right, "k", max_matches=7).count() == 7
        with pytest.raises(Exception, match="keys match in 7 pairs of rows, more than 6"):
            merge(left, right, "k", max_matches=6).collect()


def test_null_keys_on_one_side_match_nothing(spark):
    nulls = lambda n: spark.range(n).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("v"))
    keyed = spark.createDataFrame([("a", 1), ("b", 2)], "k string, l int")
    for merge in (joins.left_merge, joins.left_merge_large_right):
        assert merge(keyed, nulls(10_001), "k").where("v IS NULL").count() == 2
        assert merge(nulls(10_001).withColumnRenamed("v", "l"), keyed.withColumnRenamed("l", "v"), "k").count() == 10_001
        with pytest.raises(Exception, match="null keys match in 120000 pairs"):
            merge(nulls(300).withColumnRenamed("v", "l"), nulls(400), "k").collect()


def test_size_of_a_merge_against_the_merge(spark):
    rng = random.Random(9)
    rows = lambda n: [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]), i) for i in range(n)]
    left = spark.createDataFrame(rows(60), "k string, j int, l int")
    right = spark.createDataFrame(rows(50), "k string, j int, r int")
    matched = joins.left_merge(left, right, ["k", "j"], max_null_matches=None).where("r IS NOT NULL").count()
    assert joins.merged_rows(left, right, ["k", "j"]).first().matches == matched
    hot = spark.range(100_000).select(F.lit(None).cast("string").alias("k"), F.col("id"))
    assert joins.merged_rows(hot, hot, "k").first().matches == 10**10
    assert joins.merged_rows(left.limit(0), right, "k").first().matches == 0


def test_too_long_indexes_are_an_error(spark):
    df = spark.range(12)
    assert keys.with_load_id(df, "id", now=datetime(2024, 1, 1), digits=2, name="t").count() == 12
    with pytest.raises(Exception, match="more than 1 digits"):
        keys.with_load_id(df, "id", now=datetime(2024, 1, 1), digits=1, name="t").collect()


def test_undeclared_attributes_are_an_error(spark):
    cells = spark.createDataFrame([("f", "a", "1"), ("g", "b", "2"), ("g", None, "3")], "form_id string, name string, value string")
    assert reshape.pivot_attributes(cells, "form_id", ["a"], ignore=["b"]).collect() == [("f", "1")]
    for use in (lambda df: df.collect(), lambda df: df.select("form_id").collect()):
        with pytest.raises(Exception, match="undeclared attribute: b"):
            use(reshape.pivot_attributes(cells, "form_id", ["a"]))


def test_slice_filters_take_plain_values_only(spark):
    df = spark.createDataFrame([(1, None, True), (2, "x", False)], "d int, k string, f boolean")
    cut = spine.cut_slices(df, [spine.Slice("none", ["k"], {"k": None}), spine.Slice("yes", ["k"], {"f": True})], "d")
    assert sorted(r.slice_id for r in cut.collect()) == ["none", "yes"]
    with pytest.raises(TypeError):
        spine.cut_slices(df, [spine.Slice("s", ["k"], {"d": date(2024, 1, 1)})], "d")


def test_sums_have_one_type_and_hot_products_are_summed_first(spark):
    p = F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(0).alias("p")
    fact = spark.range(9000).select(F.lit(1).alias("d"), F.lit("g").alias("g"), p, F.lit(1).cast("decimal(12,2)").alias("v"))
    products = spark.range(9000).select(F.col("id").alias("p"), (F.col("id") % 2).cast("string").alias("c"))
    out = rollup.daily_by_category(fact, products, ["d", "g"], "p", "c", ["v"])
    assert sorted(map(tuple, out.collect())) == [(1, "g", "0", 6000), (1, "g", "1", 3000)]
    assert dict(out.dtypes)["v"] == dict(fact.groupBy("d").agg(F.sum("v").alias("v")).dtypes)["v"] == "decimal(22,2)"
    assert plan_of(out).rindex("partial_sum") > plan_of(out).index("Join")  # a hot product is summed before its join


@pytest.mark.parametrize(
    "condition, bounds",
    [
        (lambda c: dates.in_last_days(c, date(2001, 7, 15)), ("2001-07-01", "2001-07-15")),
        (lambda c: dates.in_month(c, date(2001, 7, 15), 1, months=2), ("2001-06-01", "2001-08-01")),
        (lambda c: dates.month_to_yesterday(c, datetime(2001, 7, 15, 9)), ("2001-07-01", "2001-07-14T23:59:59")),
        (lambda c: dates.before_day(c, date(2001, 7, 15)), ("2001-07-15",)),
    ],
)
def test_date_ranges_reach_the_scan(spark, condition, bounds):
    with settings(spark, spark__sql__maxMetadataStringLength=2000):
        df = spark.read.parquet(f"{BASE}/orders.parquet").where(condition(F.col("o_orderdate"))).select("o_orderkey")
        plan = plan_of(df)
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert all(b in pushed for b in bounds)
    assert "o_totalprice" not in plan


# These write tables when they are built, step by step, and are built once only.
STEPWISE = {"work_order_load", "order_documents_s2", "incremental_days_a1_a3", "versioned_table_k2"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):  # as for tables too large to broadcast
        plan = plan_of(contract.queries()[name](spark, BASE))
    if name not in STEPWISE:
        plan += plan_of(contract.queries()[name](spark, BASE))
    for word in ("Python", "Pandas", "CartesianProduct", "ScalaUDF"):
        assert word not in plan
    if name not in ("sentinel_row_u3", "visit_report_sheets"):  # the sentinel row meets at most one row
        assert "BroadcastNestedLoopJoin" not in plan


def test_sinks_and_file_choice(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "i int, region3 string")
    write_report(df, str(tmp_path / "report"), "json", ["region3"])
    assert sorted(p.name for p in (tmp_path / "report").iterdir() if p.is_dir()) == ["region3=x", "region3=y"]
    assert spark.read.json(str(tmp_path / "report")).count() == 3
    for name, age in (("old.csv", 300), ("new.csv", 100), ("~new.csv", 1)):
        (tmp_path / name).write_text("a")
        stamp = 1_700_000_000 - age
        os.utime(tmp_path / name, (stamp, stamp))
    assert last_file(spark, str(tmp_path / "*.csv")).endswith("/new.csv")
    with pytest.raises(Exception):
        last_file(spark, str(tmp_path / "*.none"))


def test_attributes_take_two_scans_where_none_is_repeated(spark, tmp_path):
    rows = [(f, n, f"{f}{n}") for f in "pqr" for n in "ab" if (f, n) != ("r", "b")]
    spark.createDataFrame(rows, "form_id string, name string, value string").write.parquet(str(tmp_path / "cells"))
    header = spark.createDataFrame([(f,) for f in "pqrs"], "form_id string")
    out = joins.attribute_joins(header, spark.read.parquet(str(tmp_path / "cells")), "form_id", {"x": "a", "y": "b"})
    assert sorted(map(tuple, out.collect()), key=str) == [("p", "pa", "pb"), ("q", "qa", "qb"), ("r", "ra", None), ("s", None, None)]
    assert "partial_max" in plan_of(out)


def test_report_order_and_positions_survive_folders(spark, tmp_path):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("i"), F.concat(F.lit("r"), (F.col("id") % 3).cast("string")).alias("region"))
    assert write_report(df.orderBy("i"), str(tmp_path / "r"), partition_by=["region"]) == 500
    back = spark.read.parquet(str(tmp_path / "r"))
    assert [r.i for r in back.orderBy("report_position").collect()] == list(range(500))
    for folder in (tmp_path / "r").glob("region=*"):
        for file in folder.glob("*.parquet"):
            own = [r.i for r in spark.read.parquet(str(file)).collect()]
            assert own == sorted(own)


def test_shared_folder_follows_the_cluster(spark):
    def session(master, **conf):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda k, default: conf.get(k.split(".")[-1], default)),
            sparkContext=SimpleNamespace(master=master, applicationId="app"),
        )

    assert shared_dir(spark) == shared_dir(spark)
    assert shared_dir(session("yarn", dir="hdfs://somewhere/shared/")) == "hdfs://somewhere/shared"
    with pytest.raises(RuntimeError):
        shared_dir(session("yarn"))


def test_records_and_partitions_keep_rows(spark):
    df = spark.range(10).withColumn("s", F.lit(None).cast("string"))
    assert reshape.to_records(df).count() == 10
