"""Every registered query on the smallest tables, against its SQL where it has one."""

import os

import pytest

import __spark_entry__ as registry
from checks.oracle import ORACLE
from checks.queries import QUERIES
from checks.compare import connect, differences

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
SQL = ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_sql_belongs_to_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = registry.queries()[name](spark, FOLDER)
    if name in SQL:
        assert differences(found, con, SQL[name]) == []
    else:
        assert found.count() > 0
