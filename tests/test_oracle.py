"""Every catalogue query against the same question in DuckDB."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tillmart.plans.catalog import QUERIES

from tests.compare import connect, duck_rows, spark_rows

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables missing")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(queries()) & set(oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, key):
    result = QUERIES[key](spark, FOLDER)
    names, expected = duck_rows(duck, oracle_sql()[key])
    assert sorted(result.columns) == sorted(names)
    assert spark_rows(result) == expected
    assert sum(expected.values()) > 0


def test_entry(spark):
    assert entry(spark).columns[0] == "summary_date"
