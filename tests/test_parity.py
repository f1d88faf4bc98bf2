"""Every registered query against its SQL on the supplied tables."""

import pytest

import __spark_entry__ as entry
from clickstar.plans.registry import QUERIES, SQL
from tests.compare import difference


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(w, con, name):
    assert difference(QUERIES[name](w), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(w, name):
    assert not QUERIES[name](w).isEmpty()


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["channel_group", "sessions", "conversions", "conversion_rate"]
    assert rows.count() > 0


def test_contract_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())
