"""Queries with SQL against DuckDB; the others must give a row for each input row."""

import pytest

from oracle_check import compare, duck
from pharmaflow.llm import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n, (_f, sql) in REGISTRY.items() if sql))
def test_matches_oracle(spark, con, name):
    fn, sql = REGISTRY[name]
    r = compare(spark, con, name, fn, sql, SF)
    assert r["ok"], r
    assert "type_warn" not in r, r


def test_operators_are_registered():
    import __spark_entry__ as e
    names = e.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
