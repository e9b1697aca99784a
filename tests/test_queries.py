"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from shopfloor.catalog.oracle import ORACLE
from shopfloor.catalog.queries import QUERIES
from tools.compare import compare, duckdb_views

WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con(data):
    return duckdb_views(data)


def test_sql_covers_all_but_the_model_queries():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, data, name):
    ok, message = compare(spark, con, data, name, QUERIES[name], ORACLE.get(name))
    assert ok, message


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["trandate", "tranid", "customer_phone", "location_id", "item_count", "net_amount"]
    assert df.count() > 0
