import os

import oracle
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return oracle.connect(FOLDER)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, tables, name):
    found = contract.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in found.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    columns, expected = oracle.oracle_rows(tables, sql)
    assert sorted(found.columns) == sorted(columns)
    assert oracle.bag(found.columns, rows) == oracle.bag(columns, expected)
