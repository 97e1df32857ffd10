"""One small frame per rule that is easy to get wrong."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reportloom.functions import dates, predicates, text
from reportloom.operators import joins, keys, ordering, reshape, rollup, spine
from reportloom.operators.spine import Slice


def rows(df):
    return [tuple(r) for r in df.collect()]


def bag(df):
    return sorted(rows(df), key=str)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_merge_matches_nulls_and_lookup_does_not(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "x")], "i int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20), (None, 21)], "k string, v int")
    assert bag(joins.left_merge(left, right, "k")) == bag_of([(1, "a", 10), (2, None, 20), (2, None, 21), (3, "x", None)])
    assert bag(joins.left_merge_large_right(left, right, "k")) == bag(joins.left_merge(left, right, "k"))
    assert bag(joins.left_lookup(left, right, "k").select("i", "k", "v")) == bag_of([(1, "a", 10), (2, None, None), (3, "x", None)])


def bag_of(values):
    return sorted(values, key=str)


def test_merge_on_two_keys(spark):
    left = spark.createDataFrame([(1, "a", None), (2, None, "b")], "i int, k string, m string")
    right = spark.createDataFrame([("a", None, 5), (None, "b", 6), ("a", "b", 7)], "k string, m string, v int")
    assert bag(joins.left_merge(left, right, ["k", "m"]).select("i", "v")) == [(1, 5), (2, 6)]
    assert bag(joins.left_merge_large_right(left, right, ["k", "m"]).select("i", "v")) == [(1, 5), (2, 6)]


def test_inequality_keeps_nulls(spark):
    df = spark.createDataFrame([("CBD",), ("x",), (None,)], "c string")
    assert bag(df.where(predicates.differs_or_null(F.col("c"), "CBD"))) == bag_of([("x",), (None,)])


def test_report_sums_give_zero_and_skip_null_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0), (None, 3.0)], "k string, v double")
    assert bag(rollup.report_sums(df, "k", ["v"])) == [("a", 0.0), ("b", 2.0)]


def test_levels_follow_both_sum_rules(spark):
    data = [(1, "g", "c", None), (1, "g", None, None), (1, None, "c", 4), (2, "g", "c", 5)]
    df = spark.createDataFrame(data, "d int, g string, c string, v int")
    got = {(r.level, r.d, r.g, r.c): r.v for r in rollup.three_levels(df, "d", "g", "c", ["v"]).collect()}
    assert got == {
        (1, 1, "g", "c"): None, (1, 1, "g", None): None, (1, 1, None, "c"): 4, (1, 2, "g", "c"): 5,
        (2, 1, "g", None): 0, (2, 2, "g", None): 5,
        (3, 1, None, None): 4, (3, 2, None, None): 5,
    }


def test_last_representative_skips_nulls(spark):
    data = [("k", "old", 1), ("k", "new", 2), ("k", None, 3), ("n", None, 1)]
    df = spark.createDataFrame(data, "k string, r string, d int")
    got = bag(df.groupBy("k").agg(rollup.latest_known(F.col("r"), F.col("d")).alias("r")))
    assert got == [("k", "new"), ("n", None)]


def test_month_pair(spark):
    data = [
        ("a", "r1", 5, date(2024, 2, 1)), ("a", "r2", 7, date(2024, 2, 29)), ("a", None, 1, date(2024, 2, 29)),
        ("a", "r0", 9, date(2024, 1, 31)), ("a", "zz", 99, date(2023, 12, 31)), ("a", "zz", 99, date(2024, 3, 1)),
        ("b", None, None, date(2024, 1, 5)), (None, "r", 3, date(2024, 2, 3)),
    ]
    df = spark.createDataFrame(data, "k string, rep string, v int, d date")
    got = bag(rollup.month_pair_orders(df, "k", "d", "v", "rep", date(2024, 2, 15)))
    assert got == bag_of([("a", 13, 9, "r2", "r0"), ("b", None, 0, None, None)])
    sums = bag(rollup.month_pair_sums(df, "k", "d", "v", date(2024, 2, 15), "x"))
    assert sums == bag_of([("a", 9, 13), ("b", None, None), (None, None, 3)])


def test_nulls_sort_last_both_ways(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "k string, i int")
    assert [r.i for r in df.orderBy(F.col("k").asc_nulls_last()).collect()] == [3, 1, 2]
    assert [r.i for r in df.orderBy(F.col("k").desc_nulls_last()).collect()] == [1, 3, 2]


def test_pivot_rejects_repeated_attribute(spark):
    cells = spark.createDataFrame([("f", "a", "1"), ("f", "a", "2"), ("g", "b", "3")], "form_id string, name string, value string")
    assert bag(reshape.pivot_attributes(cells, "form_id", ["b"], ignore=["a"])) == [("g", "3")]
    with pytest.raises(Exception, match="occurs more than once"):
        reshape.pivot_attributes(cells, "form_id", ["a", "b"]).collect()


def test_forms_without_cells_keep_their_row(spark):
    header = spark.createDataFrame([("f", "h1"), ("g", None)], "form_id string, h string")
    cells = spark.createDataFrame([("f", "a", "", "1"), ("f", "a", "x", "2"), ("f", "b", None, None)], "form_id string, name string, child string, value string")
    name = reshape.composite_attribute(F.col("name"), F.col("child"))
    got = bag(reshape.forms_with_attributes(header, cells, "form_id", ["a", "a-x", "b", "c"], name))
    assert got == [("f", "h1", "1", "2", None, None), ("g", None, None, None, None, None)]


@pytest.mark.parametrize("row_level", [False, True])
def test_gap_filling_adds_rows_only(spark, row_level):
    data = [(date(2024, 1, 2), "a", None, None), (date(2024, 1, 2), "b", "x", 1.5), (date(2024, 1, 3), "a", "y", 2.5)]
    frame = spark.createDataFrame(data, "day date, g string, t string, v double")
    slices = [Slice("sa", ["t", "v"], {"g": "a"}), Slice("sb", ["v"], {"g": "b"}), Slice("it's", ["t"], {"g": "none"})]
    cut = spine.cut_slices(frame, slices, "day")
    got = bag(spine.fill_missing_days(cut, slices, date(2024, 1, 4), "day", 2, row_level).select("slice_id", "day", "t", "v"))
    assert got == bag_of([
        ("sa", date(2024, 1, 2), None, None), ("sa", date(2024, 1, 3), "y", 2.5),
        ("sb", date(2024, 1, 2), None, 1.5), ("sb", date(2024, 1, 3), None, 0.0),
        ("it's", date(2024, 1, 2), "0", None), ("it's", date(2024, 1, 3), "0", None),
    ])


@pytest.mark.parametrize("row_level", [False, True])
def test_gap_filling_keeps_repeated_rows(spark, row_level):
    frame = spark.createDataFrame([(date(2024, 1, 2), 1), (date(2024, 1, 2), 1)], "day date, v int")
    slices = [Slice("s", ["v"])]
    filled = spine.fill_missing_days(spine.cut_slices(frame, slices, "day"), slices, date(2024, 1, 3), "day", 2, row_level)
    assert bag(filled) == [("s", date(2024, 1, 1), 0), ("s", date(2024, 1, 2), 1), ("s", date(2024, 1, 2), 1)]


def test_load_ids_order_as_text(spark):
    df = keys.with_load_id(spark.range(120), "id", now=datetime(2024, 1, 2, 3, 4, 5), name="load_id", digits=6)
    ids = [r.load_id for r in df.orderBy("id").collect()]
    assert ids == sorted(ids) and ids[10] == "20240102030405000010"


def test_month_to_yesterday_bounds(spark):
    stamps = ["2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-02-14 23:59:58", "2024-02-14 23:59:59", "2024-02-15 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").withColumn("t", F.col("s").cast("timestamp_ntz"))
    now = datetime(2024, 2, 15, 9)
    assert [r.s for r in df.where(dates.month_to_yesterday(F.col("t"), now)).orderBy("s").collect()] == stamps[1:3]
    assert [r.s for r in df.where(dates.month_to_yesterday(F.col("t"), now, True)).orderBy("s").collect()] == stamps[1:4]
    first = df.where(dates.month_to_yesterday(F.col("t"), datetime(2024, 2, 1, 9)))
    assert rows(first.select("s")) == []
    whole = df.where(dates.month_to_yesterday(F.col("t"), datetime(2024, 2, 1, 9), True))
    assert rows(whole.select("s")) == [(stamps[0],)]


def test_month_texts():
    assert dates.month_texts(date(2023, 7, 31)) == ("2023-07", "2023-06")
    assert dates.month_texts(date(2023, 7, 31), legacy=True) == ("2023-07", "2023-07")
    assert dates.month_texts(date(2023, 3, 1), legacy=True) == ("2023-03", "2023-01")
    assert dates.month_texts(date(2024, 1, 1)) == ("2024-01", "2023-12")


def test_status_predicate_keeps_all(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "s int")
    assert df.where(predicates.lot_open(F.col("s"))).count() == 4
    assert bag(df.where(predicates.lot_open(F.col("s"), strict_status=True))) == bag_of([(1,), (None,)])


def test_urgency_puts_expired_first(spark):
    df = spark.createDataFrame([(d,) for d in (5, -2, 0, -1, 3, -9)], "d int")
    assert [r.d for r in df.orderBy(*ordering.urgency_order(F.col("d"))).collect()] == [-1, -2, -9, 0, 3, 5]


def test_not_in_use_keeps_repeated_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "p string, v int")
    used = spark.createDataFrame([("b",), ("b",)], "p string")
    assert bag(joins.not_in_use(df, used, "p")) == [("a", 1), ("a", 1)]
    assert bag(joins.in_use(df, used, "p")) == [("b", 2)]


@pytest.mark.parametrize(
    "day, first, last",
    [
        (date(2023, 6, 23), date(2023, 6, 17), date(2023, 6, 23)),  # Friday
        (date(2023, 6, 24), date(2023, 6, 24), date(2023, 6, 30)),  # Saturday
        (date(2023, 6, 26), date(2023, 6, 24), date(2023, 6, 30)),  # Monday
    ],
)
def test_business_week(spark, day, first, last):
    c = F.lit(day)
    got = spark.range(1).select(dates.week_start(c), dates.week_end(c), dates.week_text(c)).first()
    assert tuple(got) == (first, last, f"{first:%Y%m%d}{last:%Y%m%d}")


def test_snowflake_ids_use_sequences_6_to_63(spark):
    start = keys.ID_EPOCH_MS + 1000
    df = keys.with_snowflake_id(spark.range(130).repartition(5), "id", start_ms=start, worker=23, name="sid")
    got = df.withColumns(keys.snowflake_parts(F.col("sid"))).orderBy("id").collect()
    assert [r.sid for r in got] == [((1000 + i // 58) << 12) | (23 << 6) | (6 + i % 58) for i in range(130)]
    assert {r.worker for r in got} == {23}
    assert {r.sequence for r in got} == set(range(6, 64))
    assert [r.time_ms for r in got] == [start + i // 58 for i in range(130)]
    with pytest.raises(ValueError):
        keys.with_snowflake_id(spark.range(1), "id", start_ms=start, worker=64)


def test_comments_skip_nulls_and_keep_order(spark):
    df = spark.createDataFrame([("f", 2, "b"), ("f", 1, "a"), ("f", 3, None), (None, 1, "x")], "form_id string, n int, remark string")
    assert bag(rollup.joined_text(df, "form_id", "remark", "n")) == [("f", "a\r\nb")]


def test_json_shapes(spark):
    docs = [(1, '{"a": "x", "n": {"b": 1}}'), (2, '[{"a": "y"}, {"a": "z", "n": {"b": 2}}]'), (3, "[]"), (4, None)]
    df = reshape.explode_documents(spark.createDataFrame(docs, "i int, j string"), "j", "a string, n struct<b: bigint>")
    assert df.columns == ["i", "a", "n.b"]
    assert bag(df) == bag_of([(1, "x", 1), (2, "y", None), (2, "z", 2)])
    with pytest.raises(Exception):
        reshape.explode_documents(spark.createDataFrame([(1, "{broken")], "i int, j string"), "j", "a string").collect()


def test_bad_number_is_an_error(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("abc",)], "s string").select(F.col("s").cast("double")).collect()


@pytest.mark.parametrize(
    "entry, days", [("2024-01-10 10:00:00", 5), ("2024-01-10 12:00:00", 5), ("2024-01-10 12:00:01", 6), ("2024-01-16 00:00:00", 11), ("2024-01-04 00:00:00", -1)]
)
def test_life_counts_whole_days(spark, entry, days):
    left = dates.whole_days_left(F.lit(10), F.lit(entry).cast("timestamp_ntz"), datetime(2024, 1, 15, 12))
    assert one(spark, left) == days


def test_contacts(spark):
    data = [("1'2", "m"), ("1", None), (None, "m"), (None, None), ("", "m")]
    df = spark.createDataFrame(data, "p string, m string")
    got = [r[0] for r in df.select(text.contact_lines(text.without_quotes(F.col("p")), F.col("m"))).collect()]
    assert got == ["12\r\nm", "1", "m", None, "\r\nm"]


@pytest.mark.parametrize(
    "value, code, rest",
    [
        ("[[BG:H]]-3", "[[BG:H]]", "-3"),
        ("a[[x]]b[[y]]c", "[[x]]b[[y]]", "ac"),
        ("[[x\n]]", None, "[[x\n]]"),
        ("plain", None, "plain"),
        (None, None, None),
    ],
)
def test_style_marks(spark, value, code, rest):
    c = F.lit(value).cast("string")
    assert one(spark, text.style_code(c)) == code
    assert one(spark, text.without_style(c)) == rest


def test_small_texts(spark):
    assert one(spark, text.row_height(F.lit("a\nb\nc"))) == 60
    assert one(spark, text.none_to_dashes(F.lit("None"))) == "--"
    assert one(spark, text.week_digits(F.lit("('20230617', '20230623')"))) == "20230617-20230623"
    assert one(spark, text.week_digits(F.lit("20230617-20230623"))) == "2023061720230623"
    assert one(spark, text.decode(F.lit("q"), {"a": "b"})) == "q"
    assert one(spark, text.sheet_title(F.lit("2024-01-05 10:00:00"), "拜访", F.lit("f1"))) == "2024-01-05拜访 f1"
    assert one(spark, text.workbook_link("b.xlsx", F.lit("t"))) == "=HYPERLINK(\"[b.xlsx]'t'!A1\",\"查看报告\")"


def test_spine_labels(spark):
    df = spine.date_spine(spark, date(2024, 3, 4), 4)
    got = rows(df.select("Date", dates.day_label(F.col("Date")), dates.weekend_style(F.col("Date"))).orderBy("Date"))
    assert got == [
        (date(2024, 2, 29), "2月29号", None), (date(2024, 3, 1), "3月1号", None),
        (date(2024, 3, 2), "3月2号", "BG:G"), (date(2024, 3, 3), "3月3号", "BG:E"),
    ]


def test_sentinel_row_only_when_empty(spark):
    df = spark.createDataFrame([(1, "s")], "i int, sheet_name string")
    assert rows(reshape.with_sentinel_row(df, {"sheet_name": "none"})) == [(1, "s")]
    assert rows(reshape.with_sentinel_row(df.where("i > 1"), {"sheet_name": "none"})) == [(None, "none")]


def test_attribute_joins_multiply(spark):
    header = spark.createDataFrame([("f",), ("g",)], "form_id string")
    cells = spark.createDataFrame([("f", "a", "1"), ("f", "a", "2"), ("f", "b", "3")], "form_id string, name string, value string")
    got = bag(joins.attribute_joins(header, cells, "form_id", {"x": "a", "y": "b"}))
    assert got == [("f", "1", "3"), ("f", "2", "3"), ("g", None, None)]


def test_records_show_nulls_and_plain_times(spark):
    df = spark.createDataFrame([(1, None, datetime(2024, 1, 2, 3, 4, 5))], "i int, s string, t timestamp")
    assert rows(reshape.to_records(df, ["i"])) == [(1, '{"s":null,"t":"2024-01-02 03:04:05"}')]


def test_observed_counts(spark):
    df, seen = rollup.counted(spark.range(7), "seen")
    df.collect()
    assert seen.get == {"rows": 7}
