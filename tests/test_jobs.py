"""Reports built from stored tables to stored files."""

import json

import pytest
from pyspark.sql import functions as F

from reportloom.plans import jobs
from reportloom.sinks.files import read_snapshot
from test_plans import NAMES, NOW, OTHER_FIELDS, VISIT_FIELDS, crm_tables, customer_inputs, daily_inputs, order, stock_inputs


def store(base, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}.parquet")


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("warehouse"))
    t = crm_tables(spark)
    more = customer_inputs(spark)[0].select("bos_code", "name", "sale_org_name", "sale_area_name", "isactive")
    store(
        base,
        crm_form=t["forms"].withColumn("otherData", F.to_json(F.struct(F.col("crm_code").alias("customerNo")))),
        crm_form_data=t["cells"],
        crm_customer=t["customers"],
        crm_user=t["users"],
        crm_comment=t["comments"],
        bos_customer_state=t["states"].join(more.where("bos_code IS NOT NULL"), "bos_code", "left").withColumn("crm_code", F.lit("C1")),
    )
    orders, _, backlog, products, kpis = daily_inputs(spark)
    extra = [F.lit("k1").alias("BOS_Group_Id"), F.lit("rep").alias("Sales_Representative_Name")]
    order_names = {
        "Date": "Order_Date", "Business_Group": "Business_Group_Name", "product_code": "Product_Code",
        "Total_Quantity": "Confimred_Order_Quantity", "Total_Amount": "Final_Order_Rebate_Amount_Cny",
    }
    shipment_names = {
        "Date": "Stock_Out_Date", "product_code": "Product_Code", "Total_Quantity": "Stock_Out_Quantity",
        "Total_Amount": "Rebate_Sales_Amount_Cny",
    }
    backlog_names = {
        "Date": "undelivered_date", "Business_Group": "Business_Group_Name", "product_code": "Product_Code",
        "Total_Quantity": "Undelivered_Quantity", "Total_Amount": "Undelivered_Order_Rebate_Amount_Cny",
    }
    store(
        base,
        bos_so_correct=orders.withColumnsRenamed(order_names).select("*", *extra),
        bos_sa_correct=orders.withColumnsRenamed(shipment_names).select("*", *extra),
        bos_undelivered=backlog.withColumnsRenamed(backlog_names),
        product_last=products,
        oa_form=kpis,
        **dict(zip(("WW_RMInventory", "Product", "ProductRoot", "Workcenter", "Cell", "Factory"), stock_inputs(spark), strict=True)),
    )
    return base


CASES = {
    "operations_daily": (dict(names=NAMES), lambda df: df.select("slice_id").distinct().count() == 81),
    "customer_months": (dict(groups=["G1"]), lambda df: {r.BOS_Group_Id: float(r.this_month_order_amount) for r in df.collect()} == {"k1": 320.0, "k2": 0.0}),
    "customer_status": ({}, lambda df: df.count() == 3),
    "sales_followup": ({}, lambda df: df.count() == 4),
    "shelf_life": (dict(factory="松岗"), lambda df: df.count() > 0 and df.select("report_date").distinct().count() == 1),
    "work_reports": (dict(attributes=["Date of Report"], ignore=OTHER_FIELDS), lambda df: df.count() == 1),
    "visit_reports": (dict(attributes=VISIT_FIELDS, comment_order="n"), lambda df: df.count() == 2),
}


@pytest.mark.parametrize("job", sorted(CASES))
def test_build(spark, warehouse, tmp_path, job):
    options, holds = CASES[job]
    for _ in range(2):  # building a day again replaces it
        folder, rows = jobs.build(spark, job, warehouse, str(tmp_path), NOW, **options)
    assert folder.endswith(f"{job}/built=2023-07-05")
    assert holds(spark.read.parquet(folder)) and rows == spark.read.parquet(folder).count()


def test_build_by_region(spark, warehouse, tmp_path):
    folder, _ = jobs.build(spark, "sales_followup", warehouse, str(tmp_path), NOW, partition_by=["region3"])
    by_region = {r.region3: r["count"] for r in spark.read.parquet(folder).groupBy("region3").count().collect()}
    assert by_region == {"北美大区": 2, "欧洲大区": 2}
    part = jobs.build(spark, "sales_followup", warehouse, str(tmp_path), NOW, region="欧洲大区")
    assert part.rows == spark.read.parquet(part.folder).count() == 2
    assert spark.read.parquet(folder).count() == 4  # the full report stays beside it


def test_every_job_is_known():
    assert set(jobs.JOBS) == set(CASES)


def test_parts_of_reports_stand_beside_them(spark, warehouse, tmp_path):
    folder, _ = jobs.build(spark, "operations_daily", warehouse, str(tmp_path), NOW, names=NAMES)
    assert {r.header_report_date for r in spark.read.parquet(folder).select("header_report_date").collect()} == {"2023-07-04"}
    days = spark.read.parquet(str(tmp_path / "operations_daily.header_days" / "built=2023-07-05"))
    assert days.count() == 14 and {"label", "style"} < set(days.columns)
    jobs.build(spark, "customer_months", warehouse, str(tmp_path), NOW, groups=["G1"])
    spans = spark.read.parquet(str(tmp_path / "customer_months.region_spans" / "built=2023-07-05"))
    assert spans.columns == ["Business_Group_Name", "Business_Region", "first_row", "last_row"]
    assert sum(r.last_row - r.first_row + 1 for r in spans.collect()) == 2


def test_load_work_orders(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.json").write_text(json.dumps({"DATA": [order("1"), order("2")]}))
    for _ in range(3):
        stored = jobs.load_work_orders(spark, str(tmp_path / "feed"), str(tmp_path / "table"), NOW)
    assert stored == (3, 2) and read_snapshot(spark, str(tmp_path / "table")).count() == 2
