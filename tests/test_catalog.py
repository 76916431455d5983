"""Every catalog query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from kerbline.plans import catalog, oracle
from tests.compare import differences, open_tables

QUERIES, SQL = catalog.all_queries(), oracle.ORACLE
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return open_tables(sf_dir)


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf_dir, name):
    _, found = differences(spark, duck, QUERIES[name], SQL[name], sf_dir)
    assert not found
