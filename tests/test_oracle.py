"""Every query with an SQL twin must equal DuckDB exactly (sf0.001; the driver checks sf0.01)."""

import pytest

from tests.oracle_harness import compare

import __spark_entry__ as E

NAMES = sorted(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, name):
    r = compare(spark, "/root/testdata/sf0.001", [name], verbose=False)[name]
    assert "error" not in r, r.get("error")
    assert r["schema"] and r["count"] and r["values"], r
