import os

import pytest

import __spark_entry__ as entry
from riskspark.plans.queries import QUERIES
from tests.compare import difference, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    result = entry.queries()[name](spark, FOLDER)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "Join Inner\n" not in plan
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert difference(result, connection, sql) is None


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
