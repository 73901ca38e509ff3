"""Every registered query with an oracle agrees with DuckDB (rows, names, values)."""

import pytest

import __spark_entry__ as E
from conftest import SMALL
from oracle_check import compare

ORACLE = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck_small, name):
    ok, n, _, detail = compare(spark, duck_small, name, E.queries()[name], ORACLE[name], SMALL)
    assert ok, detail


def test_every_query_registered_with_a_callable():
    qs = E.queries()
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 55


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "h13" in df.columns
