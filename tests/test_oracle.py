"""Every SQL-checked query against DuckDB at sf0.01 (the driver's correctness gate)."""

import pytest

from featuremill.plans.catalog import all_queries
from featuremill.plans.oracle import compare

from conftest import SF01

SQL_KEYS = sorted(k for k, q in all_queries().items() if q.sql is not None)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_query_matches_duckdb(spark, duck, key):
    r = compare(spark, duck, key, SF01)
    assert r["status"] == "match", r


def test_entry_contract(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    df = E.entry(spark)
    assert "target" in df.columns and "business_id" in df.columns
    assert df.count() > 0


def test_every_oracle_is_one_plain_select(duck):
    """The driver turns each SQL into a view."""
    import __spark_entry__ as E
    for key, sql in E.oracle_sql().items():
        duck.sql(sql).create_view("checked", replace=True)
        duck.execute("DROP VIEW checked")
