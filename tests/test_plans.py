"""The reports on hand-made tables."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reportloom.plans import operations_daily as daily
from reportloom.plans.customer_months import customer_months, customer_report, region_spans
from reportloom.plans.customer_status import customer_status
from reportloom.plans.sales_followup import sales_followup, sales_report
from reportloom.plans.settings import DailyKpiNames
from reportloom.plans.shelf_life import bom_view, parts_in_bom, shelf_life_report, stock_lots
from reportloom.plans.visit_reports import visit_reports
from reportloom.plans.work_orders import load_orders, normalised_orders, order_batch
from reportloom.plans.work_reports import work_reports
from reportloom.sinks.files import newest_snapshot, read_snapshot
from reportloom.sources.feed import ORDER_FIELDS, feed_rows, read_feed

AS_OF = date(2023, 7, 5)
NAMES = DailyKpiNames(groups={"north": "North", "south": "South", "odm": "ODM"}, product_lines={"n": "N", "s": "S", "odm": "O"})


def stamp(text):
    return datetime.fromisoformat(text)


def frame(spark, data, schema):
    df = spark.createDataFrame(data, schema.replace("timestamp_ntz", "timestamp"))
    times = [f.strip().split(" ")[0] for f in schema.split(",") if f.strip().endswith("timestamp_ntz")]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def daily_inputs(spark):
    fact = "Date date, Business_Group string, product_code string, Total_Quantity double, Total_Amount decimal(12,2)"
    from decimal import Decimal as D

    orders = [
        (date(2023, 7, 4), "North", "p1", 2.0, D("10.00")),
        (date(2023, 7, 4), "North", "p2", 3.0, D("5.00")),
        (date(2023, 7, 4), "South", "p1", 1.0, D("7.00")),
        (date(2023, 7, 4), "North", "p3", 4.0, D("1.00")),  # product without a category
        (date(2023, 7, 4), "North", "p9", 9.0, D("99.00")),  # product not known
        (date(2023, 7, 4), "Other", "p1", 9.0, D("99.00")),  # group not reported
        (date(2023, 7, 5), "North", "p1", 9.0, D("99.00")),  # today
        (date(2023, 6, 20), "North", "p1", 9.0, D("99.00")),  # too old
        (date(2023, 6, 21), "ODM", "p1", None, None),  # null measures
    ]
    backlog = [
        (date(2023, 7, 1), "North", "p4", 6.0, D("60.00")),  # category left out
        (date(2023, 7, 1), "North", "p3", 1.0, D("8.00")),
        (date(2023, 7, 1), "North", "p1", 2.0, D("4.00")),
    ]
    products = [("p1", "主机"), ("p2", "耗材"), ("p3", None), ("p4", "CBD")]
    kpis = [
        ("2023-07-04", "日报", "1.5", "2", "l1", "日产值", "by产品线", "N"),
        ("2023-07-04", "日报", "2.5", None, "l1", "日产值", "by产品线", "S"),
        ("2023-07-04", "日报", "4", "1", "l1", "日产值", "by工厂", "松岗"),
        ("2023-07-04", "日报", "5", "1", "l1", "other", "by工厂", "松岗"),
        ("2023-07-03", "日报", None, "7", "l1", "人均产值", "x", "寮步"),
        ("2023-07-03", "日报", "3", "4", "l1", "工厂人数", "x", "大岭山"),
        ("2023-07-03", "周报", "100", "100", "l1", "工厂人数", "x", "大岭山"),
        ("2023-07-05", "日报", "100", "100", "l1", "工厂人数", "x", "大岭山"),
    ]
    return (
        spark.createDataFrame(orders, fact),
        spark.createDataFrame(orders[:1], fact),
        spark.createDataFrame(backlog, fact),
        spark.createDataFrame(products, "product_code string, product_categories string"),
        spark.createDataFrame(kpis, "ReportDate string, form_type string, MA0 string, MA1 string, L1Subject1 string, L2Subject2 string, L3Subject3 string, D1 string"),
    )


def test_integer_dates(spark):
    inputs = daily_inputs(spark)
    numbers = [df.withColumn("Date", F.date_format("Date", "yyyyMMdd").cast("int")) for df in inputs[:3]]
    one, two = (sorted(map(str, daily.daily_series(*facts, *inputs[3:], AS_OF, NAMES).collect())) for facts in (inputs[:3], numbers))
    assert one == two


def test_daily_series(spark):
    assert len(daily.daily_slices(NAMES)) == 81
    df = daily.daily_series(*daily_inputs(spark), AS_OF, NAMES)
    rows = df.collect()
    assert [(r.slice_id, r.Date) for r in rows] == sorted((r.slice_id, r.Date) for r in rows)
    by_slice = {}
    for r in rows:
        by_slice.setdefault(r.slice_id, []).append(r)
    assert len(by_slice) == 81
    assert all(len({r.Date for r in part}) == 14 for part in by_slice.values())

    def at(slice_id, day):
        return [r for r in by_slice[slice_id] if r.Date == day]

    assert [float(r.Total_Amount) for r in at("oa_north", 20230704)] == [16.0]
    assert [r.Business_Group for r in at("oa_north", 20230703)] == ["0"]
    assert [(float(r.Total_Amount), r.Business_Group) for r in at("oa_sum", 20230704)] == [(23.0, None)]
    assert [float(r.Total_Amount) for r in at("oa_odm", 20230621)] == [0.0]
    assert [(r.Total_Quantity, r.Total_Amount) for r in at("oq_host_odm", 20230621)] == [(None, None)]
    assert [r.Total_Quantity for r in at("oq_sum", 20230704)] == [10.0]
    assert [(r.Total_Quantity, float(r.Total_Amount), r.product_categories) for r in at("oq_part_north", 20230704)] == [(3.0, 5.0, "耗材")]
    assert [float(r.Total_Amount) for r in at("un_north", 20230701)] == [12.0]
    assert [float(r.Total_Amount) for r in at("ua_sum", 20230701)] == [12.0]
    assert [r.Total_Quantity for r in at("uq_sum", 20230701)] == [3.0]
    assert [r.MA0 for r in at("cpx_sum", 20230704)] == [4.0]
    assert sorted(r.MA0 for r in at("gc_sg", 20230704)) == [4.0, 5.0]
    assert [r.MA0 for r in at("gc_sum", 20230704)] == [9.0]
    assert [(r.MA0, r.MA1) for r in at("rjcz_sum0", 20230703)] == [(0.0, None)]
    assert [(r.MA0, r.MA1) for r in at("rjcz_sum1", 20230703)] == [(None, 7.0)]
    assert [(r.MA0, r.MA1) for r in at("gcrs_sum", 20230703)] == [(3.0, 4.0)]
    assert [(r.MA0, r.MA1, r.D1) for r in at("rjcz_lb", 20230703)] == [(None, 7.0, "寮步")]
    assert [(r.MA0, r.MA1, r.D1, r.L1Subject1) for r in at("fqc_sg", 20230703)] == [(0.0, 0.0, "0", "0")]


def test_level_totals_agree(spark):
    orders, _, _, products, _ = daily_inputs(spark)
    totals = daily.trade_totals({"orders": orders}, products, ["North", "South", "ODM"], AS_OF, "CBD").collect()
    for measure in ("Total_Quantity", "Total_Amount"):
        sums = {level: sum(r[measure] or 0 for r in totals if r.level == level) for level in (1, 2, 3)}
        assert sums[1] == sums[2] == sums[3]


def customer_inputs(spark):
    states = [
        ("k1", "one", "C1", "G1", "west", "是"), ("k2", "two", "C2", "G1", None, "是"), (None, "lost", None, "G1", "moon", "是"),
        ("k4", "four", "C4", "G2", "east", "是"), ("k5", "five", "C5", "G1", "west", "否"), ("k6", "six", "C6", "G3", "west", "是"),
    ]
    orders = [
        ("k1", "ann", 10, date(2023, 7, 1)), ("k1", "bob", 5, date(2023, 7, 3)), ("k1", None, 1, date(2023, 7, 4)),
        ("k1", "old", 3, date(2023, 6, 30)), ("k2", "cat", 8, date(2023, 6, 1)), (None, "nil", 50, date(2023, 7, 1)),
    ]
    shipments = [("k1", 4, date(2023, 7, 2)), (None, 6, date(2023, 7, 2)), (None, 2, date(2023, 6, 2)), ("k4", 9, date(2023, 5, 1))]
    forms = [
        ("f1", '{"customerNo": "C1"}'), ("f2", '[{"customerNo": "C1"}, {"customerNo": "C2"}]'), ("f3", '[{"customerNo": null}]'),
        ("f4", '{"customerNo": "C4"}'), ("f5", '{"customerNo": "C4"}'),
    ]
    cells = [
        ("f1", "Date of Visit", "2023-07-01"), ("f2", "Date of Visit", "2023-06-11"), ("f3", "Date of Visit", "2023-07-01"),
        ("f4", "Date of Visit", None), ("f4", "Remark", "2023-07-01"),
    ]
    return (
        spark.createDataFrame(states, "bos_code string, name string, crm_code string, sale_org_name string, sale_area_name string, isactive string"),
        spark.createDataFrame(orders, "BOS_Group_Id string, Sales_Representative_Name string, Final_Order_Rebate_Amount_Cny int, Order_Date date"),
        spark.createDataFrame(shipments, "BOS_Group_Id string, Rebate_Sales_Amount_Cny int, Stock_Out_Date date"),
        spark.createDataFrame(forms, "form_id string, otherData string"),
        spark.createDataFrame(cells, "form_id string, name string, value string"),
        AS_OF,
        ["G1", "G2"],
    )


def test_customer_months(spark):
    df = customer_report(*customer_inputs(spark), region_order=["east", "west", "none"], no_region="none")
    got = [
        (r.Customer_Name, r.Business_Region, r.Sales_Representative_Name, r.this_month_order_amount, r.last_month_order_amount,
         r.this_month_sales_amount, r.last_month_sales_amount, r.this_month_visit_nums, r.last_month_visit_nums)
        for r in df.collect()
    ]
    assert got == [
        ("one", "west", "bob", 16, 3, 4, 0, 1, 1),
        ("two", "none", "cat", 0, 8, 0, 0, 0, 1),
        ("lost", "moon", None, 0, 0, 6, 2, 0, 0),  # the customer without a code gets the shipments without one
        ("four", "east", None, 0, 0, 0, 0, 0, 0),
    ]
    spans = region_spans(customer_months(*customer_inputs(spark), region_order=["east", "west", "none"], no_region="none"))
    assert sorted(map(tuple, spans.collect())) == [
        ("G1", "moon", 5, 5), ("G1", "none", 4, 4), ("G1", "west", 3, 3), ("G2", "east", 3, 3),
    ]


NOW = stamp("2023-07-05 14:29:00")


def crm_tables(spark):
    forms = [
        ("f1", "7ErjR9Pu", "Acme", "ann", "a@x", "C1", "+8", stamp("2023-07-02 09:00:00"), stamp("2023-07-02 08:00:00")),
        ("f2", "epo32S8g", "Beta", "ann", "a@x", None, "+8", stamp("2023-07-03 09:00:00"), stamp("2023-07-03 08:00:00")),
        ("f3", "MIVvHNoV", None, "bob", None, None, "+8", stamp("2023-07-04 09:00:00"), stamp("2023-07-04 23:59:58")),
        ("f4", "7ErjR9Pu", "Late", "ann", "a@x", "C1", "+8", stamp("2023-07-04 23:59:59"), stamp("2023-07-04 23:59:59")),
        ("f5", "7ErjR9Pu", "Old", "ann", "a@x", "C1", "+8", stamp("2023-06-30 09:00:00"), stamp("2023-06-30 09:00:00")),
        ("f6", "zzz", "Else", "ann", "a@x", "C1", "+8", stamp("2023-07-02 09:00:00"), stamp("2023-07-02 09:00:00")),
    ]
    cells = [
        ("f1", "Date of Visit", "", "2023-07-02"), ("f1", "Order Amount Confirmed in the Meeting (CNY)", "", "12.5"),
        ("f1", "Customer Contact Info", "Contact", "tel"), ("f2", "Date of Visit", "", "2023-07-03"),
        ("f3", "Date of Report", "", "2023-07-04"), ("f3", "Plan for tomorrow", "", "rest"), ("f3", "Date of Visit", "", "2000-01-01"),
        ("f5", "Date of Visit", "", "2023-06-30"),
    ]
    customers = [
        ("C1", "k1", "Acme", "Acme Ltd", "own", "Al", "CEO", "'1", "m@a", "海外营销中心", "欧洲大区", "DE"),
        (None, "k2", "Nameless", "No Code", "own", "Bo", "CTO", None, None, "海外营销中心", "北美大区", "US"),
        ("C3", None, "Third", "Third Ltd", "zed", "Cy", "CFO", "3", None, "海外营销中心", "亚洲", "JP"),
        ("C4", "k4", "Home", "Home Ltd", "zed", "Di", "CFO", "3", None, "国内", "亚洲", "CN"),
        ("C5", "k5", "Gone", "Gone Ltd", "zed", "Ed", "CFO", "3", None, "海外营销中心", None, "CN"),
    ]
    states = [("k1", 3, 1, 2, 3, 4, 5, 6), (None, 9, 9, 9, 9, 9, 9, 9), ("k2", None, None, 1, None, None, None, None)]
    users = [
        ("ann", "a@x", "海外营销中心", "欧洲大区", "DE", "Sales", 1), ("bob", None, "海外营销中心", "北美大区", "US", "Leader", 1),
        ("cat", "c@x", "海外营销中心", "北美大区", "US", "Sales", 1), ("dan", "d@x", "海外营销中心", "北美大区", "US", "Cook", 1),
        ("eve", "e@x", "海外营销中心", "北美大区", "US", "Sales", 0),
    ]
    comments = [("f1", "good", 2), ("f1", "first", 1), ("f9", "none", 1)]
    return dict(
        forms=frame(spark, forms, "form_id string, form_key string, targetIntro string, nickName string, email string, crm_code string, time_zone string, createTime timestamp_ntz, local_time timestamp_ntz"),
        cells=spark.createDataFrame(cells, "form_id string, name string, child_name string, value string"),
        customers=spark.createDataFrame(customers, "crm_code string, bos_code string, customerName string, businessName string, ownerUserName string, contactsName string, contactsPost string, contactsMobile string, email string, region2 string, region3 string, region4 string"),
        states=spark.createDataFrame(states, "bos_code string, no_order_days int, last_month_order_amount int, month_order_amount int, last_month_shipping_amount int, month_shipping_amount int, year_order_amount int, year_shipping_amount int"),
        users=spark.createDataFrame(users, "realname string, systemEmail string, region2 string, region3 string, region4 string, post string, status int"),
        comments=spark.createDataFrame(comments, "form_id string, remark string, n int"),
    )


def test_customer_status(spark):
    t = crm_tables(spark)
    df = customer_status(t["customers"], t["states"], t["forms"], t["cells"], NOW)
    got = [
        (r.customerName, r.last_month_order_amount, r.month_order_amount, r.this_month_visit_nums, r.last_month_visit_nums, r.report_date)
        for r in df.collect()
    ]
    assert got == [
        ("Nameless", 0, 1, 0, 0, "2023-07-04"),
        ("Acme", 1, 2, 1, 1, "2023-07-04"),
        ("Third", 0, 0, 0, 0, "2023-07-04"),  # a null code finds no state
    ]


def test_sales_followup(spark):
    t = crm_tables(spark)
    df = sales_report(t["users"], t["customers"], t["forms"], t["cells"], now=NOW)
    got = [(r.realname, r.form_id, r.form_key, r.visit_date, r.visit_amount, r.businessName, r.has_report) for r in df.collect()]
    assert got == [
        ("bob", "f3", "Daily report", "2023-07-04", "--", "No Code", True),  # null e-mail meets null e-mail
        ("cat", "--", "--", "--", "--", "No Code", False),  # without a visit the null code finds the nameless customer
        ("ann", "f2", "Online", "2023-07-03", "--", "No Code", True),
        ("ann", "f1", "Offline", "2023-07-02", "12.5", "Acme Ltd", True),
    ]
    links = {r.form_id: r.visit_report for r in df.collect()}
    assert links["f1"] == "=HYPERLINK(\"[引用附件勿删BF.xlsx]'2023-07-02拜访 f1'!A1\",\"查看报告\")"
    assert links["f3"] == "=HYPERLINK(\"[引用附件勿删RB.xlsx]'2023-07-04工作日报 f3'!A1\",\"查看报告\")"
    assert {(r.header_data_time, r.header_report_month) for r in df.collect()} == {("2023-07-05 14:29:00", 7)}
    region = sales_followup(t["users"], t["customers"], t["forms"], t["cells"], NOW, region="北美大区")
    assert sorted(r.realname for r in region.collect()) == ["bob", "cat"]


OTHER_FIELDS = ["Date of Visit", "Order Amount Confirmed in the Meeting (CNY)", "Customer Contact Info", "Plan for tomorrow"]


def test_work_reports(spark):
    t = crm_tables(spark)
    df = work_reports(t["forms"], t["cells"], t["users"], ["Date of Report", "Plan for tomorrow", "Help needed"], NOW, ignore=["Date of Visit"])
    rows = df.collect()
    assert [(r.form_id, r.Date_of_Report, r.Plan_for_tomorrow, r.Help_needed, r.region3) for r in rows] == [
        ("f3", "2023-07-04", "rest", None, None)  # a null e-mail finds no user here
    ]
    assert rows[0].sheet_name == "2023-07-04工作日报 f3" and rows[0].local_time == "2023-07-04 23:59:58"
    assert rows[0].form_key == "Daily report"
    late = work_reports(t["forms"], t["cells"], t["users"], ["Date of Report"], NOW, form_key="7ErjR9Pu", inclusive_day=True, ignore=OTHER_FIELDS)
    assert [r.form_id for r in late.collect()] == ["f4", "f1"]
    assert late.where("region3 = '欧洲大区'").count() == 2


VISIT_FIELDS = ["Date of Visit", "Order Amount Confirmed in the Meeting (CNY)", "Customer Contact Info-Contact"]


def test_visit_reports(spark):
    t = crm_tables(spark)
    args = (t["forms"], t["cells"], t["comments"], t["customers"], t["states"], VISIT_FIELDS)
    rows = visit_reports(*args, NOW, comment_order="n").collect()
    got = [
        (r.form_id, r.visit_form, r.Order_Amount_Confirmed_in_the_Meeting, r.Contact, r.area, r.no_order_days, r.month_order_amount,
         r.combined_contact, r.remark, r.sheet_name)
        for r in rows
    ]
    assert got == [
        ("f2", "Online", None, None, "US", "暂未接单", 1, None, None, "2023-07-03拜访 f2"),
        ("f1", "Offline", 12.5, "tel", "DE", "3", 2, "1\r\nm@a", "first\r\ngood", "2023-07-02拜访 f1"),
    ]
    none = visit_reports(*args, stamp("2020-01-10 00:00:00"), comment_order="n")
    assert [r.sheet_name for r in none.collect()] == ["无客户拜访报告"]
    region = visit_reports(*args, NOW, comment_order="n", region="北美大区")
    assert [r.form_id for r in region.collect()] == ["f2"]
    assert visit_reports(*args, NOW, comment_order="n", region="南美").count() == 0


def stock_inputs(spark):
    lots = [
        # product, centre, quantity, entry, issued, status, lot
        ("P1", "W1", 1.0, stamp("2023-06-25 08:00:00"), None, 0, "today"),  # 10 days of 10
        ("P1", "W1", 1.0, stamp("2023-06-24 09:00:00"), 0, 2, "partial"),  # 10 days and 23 hours
        ("P1", "W1", 1.0, stamp("2023-06-23 08:00:00"), None, None, "minus2"),
        ("P1", "W1", 1.0, stamp("2023-06-24 08:00:00"), None, 1, "minus1"),
        ("P1", "W1", 1.0, stamp("2023-06-27 08:00:00"), None, 1, "plus2"),
        ("P1", "W1", 1.0, stamp("2023-06-29 08:00:00"), None, 1, "fresh"),
        ("P1", "W1", 1.0, stamp("2023-07-06 08:00:00"), None, 1, "future"),
        ("P1", "W1", 0.0, stamp("2023-06-01 08:00:00"), None, 1, "no quantity"),
        ("P1", "W1", 1.0, stamp("2023-06-01 08:00:00"), 1, 1, "issued"),
        ("P1", "W1", 1.0, None, None, 1, "no entry"),
        ("P2", "W1", 1.0, stamp("2023-06-01 08:00:00"), None, 1, "no warning life"),
        ("P3", "W1", 1.0, stamp("2023-06-01 08:00:00"), None, 1, "root without centre"),
        ("P1", "W2", 1.0, stamp("2023-06-01 08:00:00"), None, 1, "other plant"),
        ("P1", "W3", 1.0, stamp("2023-06-01 08:00:00"), None, 1, "centre not listed"),
        ("P9", "W1", 1.0, stamp("2023-06-01 08:00:00"), None, 1, "unknown product"),
    ]
    inventory = frame(spark, [(*r, "c", "x") for r in lots], "ProductId string, WorkcenterId string, Qty double, EntryDate timestamp_ntz, IsIssueToPickingList int, LotStatus int, LotSN string, CellId string, FactoryId string")
    products = spark.createDataFrame([("P1", "R1", "n", "s", 10, 3), ("P2", "R1", "n", "s", 10, None), ("P3", "R3", "n", "s", 10, 3)], "ProductId string, ProductRootId string, ProductDescription string, ProductDescription_1 string, VALIDITY int, MINVALIDITY int")
    roots = spark.createDataFrame([("R1", "code1", "w"), ("R3", "code3", None)], "ProductRootId string, ProductName string, WorkcenterName string")
    centres = spark.createDataFrame([("W1", "1102", "松岗一"), ("W2", "1103", "寮步"), ("W3", "7777", "松岗二")], "WorkcenterId string, WorkcenterName string, WorkcenterDescription string")
    cells = spark.createDataFrame([("zz", "cell")], "CellId string, CellName string")
    factories = spark.createDataFrame([("x", "factory")], "FactoryId string, FactoryName string")
    return inventory, products, roots, centres, cells, factories


def test_shelf_life(spark):
    now = stamp("2023-07-05 08:00:00")
    stock = stock_lots(*stock_inputs(spark), factory="松岗")
    rows = shelf_life_report(stock, now).collect()
    assert [(r.LotSN, r.days_until_expiration, r.days_style) for r in rows] == [
        ("minus1", -1, "BG:H"), ("minus2", -2, "BG:H"), ("today", 0, "BG:I"), ("partial", 0, "BG:I"), ("plus2", 2, "BG:I"),
    ]
    assert rows[0].CellName is None and rows[0].FactoryName == "factory" and rows[0].EntryDate == "2023-06-24"
    assert rows[0].data_time == "2023-07-05 08:00:00" and rows[0].report_date == "2023-07-05"
    used = spark.createDataFrame([("code1",)], "product_code string")
    assert shelf_life_report(stock, now, used).count() == 0


def test_bom(spark):
    heads = spark.createDataFrame(
        [(1, 1001, "A", None, 1), (2, 1001, "B", "X", 1), (3, 1002, "C", None, 1), (4, 1001, "D", "", 3)],
        "self_id int, WERKS int, MATNR string, LOEKZ string, STLST int",
    )
    items = spark.createDataFrame(
        [(1, "B", 1001, None), (1, "B", 1001, None), (1, "E", 1001, "X"), (2, "A", 1001, "")], "parent_id int, IDNRK string, WERKS int, DUMPS string"
    )
    assert sorted(r.MATNR for r in parts_in_bom(heads, items).collect()) == ["A", "B"]
    view = bom_view(heads, items)
    assert sorted((r.ID, r.MATNR, r.PARENT_ID) for r in view.collect()) == [(1, "A", 2), (2, "B", 1)]
    assert {r.MATNR for r in view.collect()} == {r.MATNR for r in parts_in_bom(heads, items).collect()}


def order(number, end="2023-06-26", **more):
    return {**{f: None for f in ORDER_FIELDS}, "AUFNR": number, "GLTRP": end, **more}


def test_normalised_orders(spark):
    payloads = [json.dumps(order("1", FTRMI="0000-00-00")), json.dumps([order("2", "0000-00-00"), order("3", "")]), "[]"]
    rows = feed_rows(spark.createDataFrame([(p,) for p in payloads], "DATA string"))
    got = {r.Order_Id: r for r in normalised_orders(rows, NOW).collect()}
    assert set(got) == {"1", "2", "3"}
    assert (got["1"].week_date, got["1"].week_start, got["1"].week_end) == ("2023062420230630", date(2023, 6, 24), date(2023, 6, 30))
    assert got["1"].Approve_Date is None and got["1"].timestamp == NOW
    assert (got["2"].End_Date, got["2"].week_date) == (None, None)
    assert (got["3"].End_Date, got["3"].week_date, got["3"].week_start) == ("", "", None)


def test_load_orders(spark, tmp_path):
    def land(name, data):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "feed.json").write_text(json.dumps({"DATA": data}, indent=1))
        return str(folder)

    table = str(tmp_path / "orders")
    read = lambda: read_snapshot(spark, table)
    with pytest.raises(FileNotFoundError):
        read()
    many = [order(str(i % 12), MATNR=f"first{i}") for i in range(24)] + [order(None)]
    assert load_orders(spark, land("a", many), table, stamp("2023-06-01 00:00:00")) == (1, 12)
    first = read()
    assert first.count() == 12
    assert {r.Product_Code for r in first.collect()} == {f"first{i}" for i in range(12, 24)}  # later rows of a batch win
    assert load_orders(spark, land("b", order("3", MATNR="second")), table, stamp("2023-06-02 00:00:00")) == (2, 12)
    second = {r.Order_Id: r.Product_Code for r in read().collect()}
    assert len(second) == 12 and second["3"] == "second" and second["4"] == "first16"
    assert first.count() == 12 and "second" not in {r.Product_Code for r in first.collect()}  # readers of the old snapshot keep it
    before = sorted(map(str, read().collect()))
    load_orders(spark, str(tmp_path / "b"), table, stamp("2023-06-02 00:00:00"))
    assert sorted(map(str, read().collect())) == before  # the same batch again changes nothing
    older = load_orders(spark, land("c", order("3", MATNR="stale")), table, stamp("2023-05-01 00:00:00"))
    assert newest_snapshot(spark, table) == older.snapshot == 4
    assert {r.Order_Id: r.Product_Code for r in read().collect()}["3"] == "second"
    torn = tmp_path / "orders" / "snapshot=00000005"
    torn.mkdir()
    (torn / "part-0.parquet").write_bytes(b"torn")  # a load that failed
    assert newest_snapshot(spark, table) == 4
    assert load_orders(spark, str(tmp_path / "b"), table, stamp("2023-06-03 00:00:00")) == (5, 12)


def test_a_third_of_a_feed_on_one_day(spark, tmp_path, monkeypatch):
    """Landed files stay small, and a hot day is read and loaded like any other."""
    from pyspark.sql import functions as F

    from reportloom.queries import tables_in_out

    monkeypatch.setattr(tables_in_out, "PAYLOADS_PER_FILE", 500)
    day = F.date_add(F.lit(date(2024, 1, 1)), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).cast("int"))
    data = F.to_json(F.struct(F.col("id").cast("string").alias("AUFNR"), F.lit("x").alias("MATNR")))
    payloads = spark.range(6000).select(F.col("id").alias("event_id"), data.alias("DATA"), day.alias("day"))
    tables_in_out.land_feed(payloads, str(tmp_path / "feed"))
    files = list((tmp_path / "feed").glob("day=*/block=*/part-*"))
    assert len(files) > 12 and max(f.stat().st_size for f in files) < 500 * 40
    stored = load_orders(spark, str(tmp_path / "feed" / "*" / "*"), str(tmp_path / "table"), NOW)
    assert stored == (1, 6000)
    ids = [r.Order_Id for r in read_snapshot(spark, str(tmp_path / "table")).orderBy("id").collect()]
    assert ids == [str(r.event_id) for r in payloads.orderBy("day", "event_id").collect()]


def test_feed_order_follows_arrival(spark, tmp_path):
    for age, (name, numbers) in enumerate((("feed_9.json", ["b", "a"]), ("feed_10.json", ["c", "b"]))):
        (tmp_path / name).write_text(json.dumps({"DATA": [order(n, MATNR=name) for n in numbers]}))
        os.utime(tmp_path / name, (1_700_000_000 + age, 1_700_000_000 + age))
    batch = order_batch(read_feed(spark, str(tmp_path)), NOW)
    assert [(r.Order_Id, r.Product_Code) for r in batch.orderBy("id").collect()] == [
        ("b", "feed_9.json"), ("a", "feed_9.json"), ("c", "feed_10.json"), ("b", "feed_10.json")
    ]
    (tmp_path / "feed_11.json").write_text(json.dumps({"ERROR": "busy"}))
    with pytest.raises(Exception, match="a payload has no DATA"):
        read_feed(spark, str(tmp_path)).collect()
    assert not [c for c in batch.columns if c.startswith("__")]
