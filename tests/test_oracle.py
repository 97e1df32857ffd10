import os

import pytest

import __spark_entry__ as contract
from reportloom.queries import QUERIES
from compare import connect, duck_rows, duck_types, spark_rows, spark_types

BASE = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(BASE)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = contract.queries()[name](spark, BASE)
    assert spark_types(df) == duck_types(db, contract.oracle_sql()[name])
    got_names, got = spark_rows(df)
    want_names, want = duck_rows(db, contract.oracle_sql()[name])
    assert got_names == want_names
    assert len(got) == len(want)
    assert got == want
    assert len(got) > 0
