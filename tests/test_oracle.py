"""Every registered query against its DuckDB oracle (row count, column
names, order-insensitive value hash) on the smallest scale."""

import pytest

import __spark_entry__ as E
from oracles.sql import SQL
from quarry.plans.workloads import W
from conftest import SF_SMALL

duckdb = pytest.importorskip("duckdb")

SLOW = set()


@pytest.fixture(scope="module")
def con():
    from quarry.sources.tables import TABLES
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    from tools.oracle_check import digest
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, drows)[0]


def test_every_query_has_an_oracle():
    assert set(W) == set(SQL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "rank" in df.columns and "score" in df.columns
