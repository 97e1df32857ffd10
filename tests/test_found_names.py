"""Documents without a schema and forms without declared attributes, against pandas."""

import json
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reportloom.operators import reshape
from reportloom.plans.work_reports import work_reports


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, doc string")


def test_documents_against_json_normalize(spark):
    rng = random.Random(1)

    def document(depth=0):
        out = {}
        for name in rng.sample(["n", "s", "f", "b", "nothing", "list", "x y", "a'b"], rng.randrange(1, 6)):
            out[name] = {"n": rng.randrange(5), "s": rng.choice(["t", "ü\"", ""]), "f": rng.choice([1, 2.5]), "b": rng.random() < 0.5, "nothing": None, "list": [1, 2], "x y": 3, "a'b": "q"}[name]
        if depth < 2 and rng.random() < 0.6:
            out["inner"] = document(depth + 1)
        return out

    docs = [document() if rng.random() < 0.6 else [document() for _ in range(rng.randrange(4))] for _ in range(40)]
    got = reshape.normalised_documents(documents(spark, [json.dumps(d) for d in docs]), "doc").toPandas()
    want = pd.concat([pd.json_normalize(d).assign(i=i) for i, d in enumerate(docs)], ignore_index=True)
    assert set(got.columns) == set(want.columns)

    def plain(value):
        if value is None or isinstance(value, float) and math.isnan(value):
            return None
        return str([float(x) for x in value]) if isinstance(value, (list, tuple)) or hasattr(value, "tolist") and getattr(value, "ndim", 0) else float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value

    rows = lambda df: sorted(str([plain(r[c]) for c in sorted(df.columns)]) for r in df.to_dict("records"))
    assert rows(got) == rows(want)


def test_empty_documents_and_types(spark):
    got = reshape.normalised_documents(documents(spark, ["[]", None, '{"a":1,"e":{},"x":null}', '{"a":2.5,"o":[{"p":1},{"q":"t"}]}']), "doc")
    assert dict(got.dtypes) == {"i": "int", "a": "double", "o": "array<struct<p:bigint,q:string>>", "x": "string"}
    assert [(r.i, r.a) for r in got.orderBy("i").collect()] == [(2, 1.0), (3, 2.5)]
    assert reshape.normalised_documents(documents(spark, ["[]", None]), "doc").collect() == []
    assert reshape.found_schema(documents(spark, []), "doc").fields == []


@pytest.mark.parametrize(
    "texts, message",
    [
        (['{"a":{"b":1}}', '{"a":{"b":"t"}}'], "conflicting types at doc.a.b"),
        (['{"a":1}', '{"a":{"b":1}}'], "conflicting types at doc.a"),
        (['{"a":[1,"t"]}'], r"conflicting types at doc.a\[\]"),
        (['{"a":1}', "3"], "not all objects"),
        (['{"a":1'], "MALFORMED"),
        (['{"a":1}', "[null]"], "a document is null"),
        (['{"a.b":1,"a":{"b":2}}'], "the same name"),
        (['{"i":1}'], "the same name"),
        (['{"":1}'], "can't be addressed"),
    ],
)
def test_documents_that_are_errors(spark, texts, message):
    with pytest.raises(Exception, match=message):
        reshape.normalised_documents(documents(spark, texts), "doc").collect()


def test_columns_are_bounded(spark):
    docs = documents(spark, ['{"k%d":1}' % i for i in range(12)])
    assert len(reshape.found_schema(docs, "doc", most=12).fields) == 12
    with pytest.raises(ValueError, match="12 columns, more than 11"):
        reshape.found_schema(docs, "doc", most=11)


def test_one_schema_job_and_one_pass(spark):
    schema = reshape.found_schema(documents(spark, ['{"a":1}']), "doc")
    got = reshape.normalised_documents(documents(spark, ['{"a":5,"b":6}']), "doc", schema)
    assert got.collect() == [(0, 5)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_attributes_against_pivot(spark):
    rng = random.Random(2)
    cells = [(f"f{i}", f"attr {j}", rng.choice(["x", None, "y"])) for i in range(30) for j in range(20) if rng.random() < 0.4]
    df = spark.createDataFrame([*cells, ("f1", None, "lost"), ("f1", "skip", "1"), ("f1", "skip", "2")], "form_id string, name string, value string")
    got = reshape.pivot_found_attributes(df, "form_id", ignore=["skip"])
    want = pd.DataFrame(cells, columns=["form_id", "name", "value"]).pivot(index="form_id", columns="name", values="value").reset_index()
    assert got.columns == list(want.columns)
    plain = lambda df: sorted(map(str, ([None if x is None or x != x else x for x in r] for r in df.itertuples(index=False))))
    assert plain(got.toPandas()) == plain(want)


def test_repeats_and_bounds_are_errors(spark):
    df = spark.createDataFrame([("f", "a", "1"), ("f", "b", "1"), ("f", "a", "1")], "form_id string, name string, value string")
    with pytest.raises(Exception, match="attribute 'a' occurs more than once"):
        reshape.pivot_found_attributes(df, "form_id").collect()
    with pytest.raises(ValueError, match="more than 1 attributes"):
        reshape.pivot_found_attributes(df, "form_id", most=1)
    assert reshape.pivot_found_attributes(df.limit(0), "form_id").collect() == []


def test_hot_form_and_hot_attribute_stay_small(spark):
    """A repeated attribute of a form is counted before the shuffle; the map holds one entry for each attribute."""
    df = spark.range(50_000).select(F.lit("f").alias("form_id"), F.lit("a").alias("name"), F.col("id").cast("string").alias("value"))
    plan = reshape.pivot_found_attributes(df, "form_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")  # written below it, done before it
    with pytest.raises(Exception, match="more than once"):
        reshape.pivot_found_attributes(df, "form_id").collect()


def test_reports_with_found_attributes(spark):
    from datetime import datetime

    forms = spark.createDataFrame(
        [("k", "d", "n", "2024-01-02 00:00:00", datetime(2024, 1, 2), "t", "e"), ("o", "d", "n", "2024-01-02 00:00:00", datetime(2023, 1, 2), "t", "e")],
        "form_id string, form_key string, nickName string, createTime string, local_time timestamp_ntz, targetIntro string, email string",
    )
    cells = spark.createDataFrame([("k", "To do", "x"), ("k", "Done", "y"), ("o", "Old field", "z")], "form_id string, name string, value string")
    users = spark.createDataFrame([("e", "r2", "r3", "r4")], "systemEmail string, region2 string, region3 string, region4 string")
    args = dict(now=datetime(2024, 1, 31, 9), form_key="d")
    got, want = (work_reports(forms, cells, users, attributes, **args) for attributes in (None, ["Done", "To do"]))
    assert got.columns == want.columns and got.collect() == want.collect()
    assert "Old_field" not in got.columns
