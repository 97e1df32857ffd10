"""Day partials against the full build, equal-depth ranges, run-time filters, and joined texts of hot keys."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from reportloom.operators.rollup import joined_text
from reportloom.plans import daily_partials, operations_daily
from reportloom.queries import rollups
from reportloom.sinks.files import facts_of_days, write_by_month
from reportloom.sources.ranges import depths, equal_depth_predicates, hot_values, range_predicates, union_of
from reportloom.sources.warehouse import read_database
from test_order_and_scale import BASE, SKEW, final_plan, plan_of, settings

AS_OF = date(2023, 7, 5)
FACT = "Date date, Business_Group string, product_code string, Total_Quantity double, Total_Amount decimal(12,2)"


def facts(spark, seed, n=400):
    from decimal import Decimal as D

    rng = random.Random(seed)
    row = lambda: (
        AS_OF - timedelta(days=rng.randrange(-1, 18)), rng.choice(["N", "S", "other"]), rng.choice(["p1", "p2", "p3", "p9", None]),
        rng.choice([1.0, 2.5, None]), rng.choice([D("1.25"), D("-3.00"), None]),
    )
    return {name: spark.createDataFrame([row() for _ in range(n)], FACT) for name in ("orders", "deliveries", "backlog")}


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def folders(path):
    return {f.relative_to(path): sorted(x.name for x in f.glob("*.parquet")) for f in path.glob("Date=*/batch=*")}


def test_day_by_day_equals_the_full_build(spark, tmp_path):
    products = spark.createDataFrame([("p1", "a"), ("p2", None), ("p3", "CBD")], "product_code string, product_categories string")
    every = facts(spark, 1)
    full = operations_daily.trade_totals(every, products, ["N", "S"], AS_OF, "CBD")
    path, groups = tmp_path / "partials", ["N", "S"]
    late = F.pmod(F.hash("product_code", "Total_Quantity"), F.lit(3)) == 0
    add = lambda part, name: daily_partials.add_batch(part, products, groups, str(path), name)
    for back in range(18, -2, -1):
        day = AS_OF - timedelta(days=back)
        add({n: df.where((F.col("Date") == F.lit(day)) & ~late) for n, df in every.items()}, f"{day}")
    corrections = {n: df.where(late) for n, df in every.items()}
    add(corrections, "late")
    got = daily_partials.kept_totals(spark, str(path), AS_OF, "CBD")
    assert rows(got) == rows(full) and dict(got.dtypes) == dict(full.dtypes)
    add(corrections, "late")  # the same batch again changes nothing
    assert rows(daily_partials.kept_totals(spark, str(path), AS_OF, "CBD")) == rows(full)
    before = folders(path)
    daily_partials.recount_day(every, products, groups, str(path), AS_OF - timedelta(days=3))
    after = folders(path)
    changed = {f.parts[0] for f in before.keys() ^ after.keys()} | {f.parts[0] for f in before.keys() & after.keys() if before[f] != after[f]}
    assert changed == {f"Date={AS_OF - timedelta(days=3)}"}  # no other day was written
    assert rows(daily_partials.kept_totals(spark, str(path), AS_OF, "CBD")) == rows(full)
    plan = plan_of(daily_partials.kept_totals(spark, str(path), AS_OF, "CBD"))
    assert "PartitionFilters: [isnotnull(Date" in plan


def test_rows_and_sums_read_the_frame_twice(spark, tmp_path):
    kpis = spark.createDataFrame([("2023-07-04", "f", "1", "2", "a", "b", "c", "d")], "ReportDate string, form_type string, MA0 string, MA1 string, L1Subject1 string, L2Subject2 string, L3Subject3 string, D1 string")
    kpis.write.parquet(str(tmp_path / "kpis"))
    from reportloom.plans.settings import DailyKpiNames

    names = DailyKpiNames(groups={"n": "N"}, product_lines={"n": "N"})
    plan = plan_of(operations_daily.kpi_series(spark.read.parquet(str(tmp_path / "kpis")), AS_OF, names))
    assert plan.count("Location: InMemoryFileIndex") in (2, 4)  # two scans, printed for the adaptive plan once or twice


def key_frame(spark, n=20_000):
    k = F.when(F.col("id") % 3 == 0, F.lit(500)).when(F.col("id") % 10 == 1, None).otherwise((F.col("id") * F.col("id")) % 100_000)
    return spark.range(n).select("id", k.cast("long").alias("k"))


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(12,2)", "date", "timestamp_ntz"])
def test_each_row_in_one_range(spark, kind):
    df = key_frame(spark)
    value = F.date_add(F.lit(date(2000, 1, 1)), (F.col("k") % 5000).cast("int")).cast(kind) if kind in ("date", "timestamp_ntz") else F.col("k").cast(kind)
    df = df.select("id", value.alias("k")).cache()
    for second in (None, "id"):
        predicates = equal_depth_predicates(df, "k", 12, second)
        assert union_of(df, predicates).groupBy("id").count().where("count <> 1").count() == 0
        assert union_of(df, predicates).count() == df.count()
        sizes = [df.where(p).count() for p in predicates]
        largest = max(sizes) / df.count()
        assert largest < (0.4 if second is None else 1.6 / 12), (kind, sizes)  # a third of the rows has one value
    # rows that came after the summary
    late = spark.range(5).select(F.col("id"), F.lit(None).cast(df.schema["k"].dataType).alias("k")).union(df.limit(3))
    assert union_of(late, predicates).count() == 8


def test_hot_values_and_small_frames(spark):
    df = key_frame(spark)
    assert hot_values(depths(df, "k", 12)) == [500]
    assert range_predicates(depths(df.limit(0), "k", 4)) == ["k IS NOT NULL", "k IS NULL"]
    one = spark.range(10).select(F.lit(3).alias("k"))
    predicates = equal_depth_predicates(one, "k", 4)
    assert union_of(one, predicates).count() == 10 and "k = 3" in predicates
    assert equal_depth_predicates(one, "k", 1) == ["k IS NOT NULL", "k IS NULL"]
    with pytest.raises(TypeError):
        depths(spark.createDataFrame([("a",)], "k string"), "k", 4)


def test_database_reads_take_predicates(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, **options: seen.update(options, url=url, table=table))
    read_database(spark, "jdbc:x", "t", predicates=["k < 3", "k >= 3", "k IS NULL"])
    assert seen == {"url": "jdbc:x", "table": "t", "predicates": ["k < 3", "k >= 3", "k IS NULL"], "properties": {}}


def test_folders_are_pruned_by_the_days_looked_up(spark, tmp_path):
    lines = spark.read.parquet(f"{BASE}/lineitem.parquet").select("l_orderkey", "l_shipdate")
    write_by_month(lines, str(tmp_path / "facts"), "l_shipdate")
    orders = spark.read.parquet(f"{BASE}/orders.parquet")
    days = orders.where("o_orderkey < 3").select(F.col("o_orderdate").alias("l_shipdate"))
    out = facts_of_days(spark.read.parquet(str(tmp_path / "facts")), days, "l_shipdate")
    plan = final_plan(out)
    assert "dynamicpruning" in plan and "SubqueryBroadcast" in plan
    want = lines.where(F.col("l_shipdate").cast("date").isin([r[0].date() for r in days.collect()]))
    assert rows(out) == rows(want)


def test_bloom_filters_reach_the_fact(spark):
    """With the thresholds of large tables lowered, the fact's scan is filtered by the keys of a filtered dimension."""
    read = lambda name: spark.read.parquet(f"{BASE}/{name}.parquet")
    bloom = dict(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__optimizer__runtime__bloomFilter__enabled="true",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="1",
    )
    with settings(spark, **bloom):
        parts = read("part").where("p_brand = 'Brand#7'").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        joined = read("lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(parts, "l_partkey")
        plan = final_plan(joined)
    assert "might_contain" in plan and "bloom_filter_agg" in plan


def test_texts_of_a_hot_key_are_joined_in_two_steps(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 50).cast("string")).alias("k"),
        ((F.col("id") * 7) % 3000).alias("o"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("t"), F.col("id").cast("string"))).alias("t"),
    )
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.o):
        if r.k is not None and r.t is not None:
            want.setdefault(r.k, []).append(r.t)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        out = joined_text(df, "k", "t", "o")
        assert {r.k: r.t for r in out.collect()} == {k: "\r\n".join(v) for k, v in want.items()}
        plan = plan_of(out)
        assert "rangepartitioning(k" in plan
        ranged = df.where("k is not null and t is not null").repartitionByRange("k", "o").where("k = 'hot'")
        assert ranged.select(F.spark_partition_id().alias("p")).distinct().count() > 2  # the hot key is not in one first-level task


def test_too_much_text_for_a_cell_is_an_error(spark):
    df = spark.range(100).select(F.lit("k").alias("k"), F.col("id").alias("o"), F.lit("x" * 10).alias("t"))
    assert len(joined_text(df, "k", "t", "o", ",", most_bytes=1099).first().t) == 1099
    with pytest.raises(Exception, match="have 1099 bytes, more than 1098"):
        joined_text(df, "k", "t", "o", ",", most_bytes=1098).collect()
    assert joined_text(df.limit(0), "k", "t", "o").collect() == []


def test_batches_read_landed_lines_instead_of_joining_all_again(spark, monkeypatch):
    """Orders and lines are joined once, for the days in question; a batch and the recount read what has landed."""
    joins = []

    def seen(facts, *rest):
        joins.append("Join" in facts["orders"]._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(rollups, "add_batch", lambda facts, *rest: (seen(facts), daily_partials.add_batch(facts, *rest)))
    monkeypatch.setattr(rollups, "recount_day", lambda facts, *rest: (seen(facts), daily_partials.recount_day(facts, *rest)))
    assert rollups.incremental_days(spark, BASE).count() > 0
    assert joins == [False] * 17
