"""Every registered query against its SQL in DuckDB, on the smallest data set."""

import os

import pytest

import __spark_entry__ as driver
from tests import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert oracle.difference(df, con, SQL[name]) is None
    else:
        df.collect()


def test_names_match():
    assert set(SQL) <= set(QUERIES)
    # only corpus queries may lack SQL
    assert {n for n in set(QUERIES) - set(SQL) if not n.startswith(("op", "pipeline"))} == set()


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
