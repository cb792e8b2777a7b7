"""Every registered query that has SQL against that SQL."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, difference

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, con, name):
    assert difference(contract.queries()[name](spark, SF_DIR), con, SQL[name]) is None
