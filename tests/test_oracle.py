"""Every registered query against its DuckDB oracle (driver's check, small SF)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import duck, rows_of

from conftest import SF_ORACLE

# the training-data queries are tested in tests/llm
QUERIES = {k: v for k, v in E.queries().items() if k != "pipeline" and not k.startswith("op")}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_is_registered_with_unique_names():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 70


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    a = rows_of(df.columns, srows)
    b = rows_of(rel.columns, rel.fetchall())
    assert len(a) == len(b)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_ORACLE)
    rows = df.collect()
    assert rows and all(any(v is not None for v in r) for r in rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Date", "Category", "Sector_VWAP", "MovingAvg_VWAP", "BuySell"]
