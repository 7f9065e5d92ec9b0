"""Every registered query against its DuckDB oracle (sf0.001 for speed; the
driver repeats this at sf0.01). Queries without SQL must run and return rows."""

import pytest

from oracle_check import compare, duck
from pharmaflow.plans import REGISTRY

SF = "/root/testdata/sf0.001"
ORACLE = sorted(n for n, (_f, sql) in REGISTRY.items() if sql)
ROWS_ONLY = sorted(n for n, (_f, sql) in REGISTRY.items() if not sql)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", ORACLE)
def test_matches_oracle(spark, con, name):
    fn, sql = REGISTRY[name]
    r = compare(spark, con, name, fn, sql, SF)
    assert r["ok"], r
    assert "type_warn" not in r, r


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = REGISTRY[name][0](spark, SF)
    assert df.count() >= 1


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
