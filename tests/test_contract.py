"""The driver contract: entry() runs, and every registered query matches its
DuckDB oracle on sf0.001 (rows-only where no SQL exists)."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck_conn


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "event_id" in df.columns


def test_oracle_keys_are_queries():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


@pytest.mark.parametrize("name", sorted(entry_mod.queries()))
def test_query_matches_oracle(spark, con, name):
    line = compare(spark, SF_SMALL, name, entry_mod.queries()[name], entry_mod.oracle_sql().get(name), con)
    assert "FAIL" not in line, line
