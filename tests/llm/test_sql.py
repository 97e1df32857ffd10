"""Every query of the package that SQL can express, against DuckDB."""

import os

import pytest

from compare import connect, duck_rows, duck_types, spark_rows, spark_types
from reportloom.llm.queries import ORACLE, QUERIES

BASE = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    db = connect(BASE)
    df = QUERIES[name](spark, BASE)
    assert spark_types(df) == duck_types(db, ORACLE[name])
    assert spark_rows(df) == duck_rows(db, ORACLE[name])
