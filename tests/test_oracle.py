"""Every registered query with an oracle agrees with DuckDB (small scale factor)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["accuracy", "precision", "recall"]
    assert df.count() == 1


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, small_dir, name):
    r = compare(spark, con, name, E.queries()[name], SQL[name], small_dir)
    assert r["ok"], r
