"""The registered queries of this package against their SQL, and their registration."""

import pytest

import __spark_entry__ as entry
from tonetide.llm import queries
from tools.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rel = duck(SF).sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())
