"""Every registered query against its DuckDB oracle (sf0.001), the same check
the driver runs at sf0.01 (tools/check.py runs it at any scale)."""

import pytest

import __spark_entry__ as entry
from tools.check import duck_conn, rows_of

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_conn(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(ORACLE[name])
    want = rows_of(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == want


def test_every_query_has_an_entry(spark):
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "kpi_outcome" in df.columns
