"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.registry import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    assert compare(spark, con, SMALL, name, QUERIES[name], ORACLE.get(name)) == ""
