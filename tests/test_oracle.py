"""Every registered query with a SQL oracle equals DuckDB at sf0.001."""

import pytest

import __spark_entry__ as E
from tools.oracle_compare import compare

SMOKE = "/root/testdata/sf0.001"
SQL_NAMES = sorted(E.oracle_sql())


def test_all_queries_have_callables():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SQL_NAMES)
def test_query_matches_duckdb(spark, name):
    res = compare(spark, SMOKE, [name], verbose=False)
    assert res[name][0] == "match", res[name]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
