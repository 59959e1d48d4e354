"""Models that take all days of the buy/sell features, with and without news, on rows of their own."""

import datetime as dt

import pytest

import __spark_entry__ as E
from tools.oracle_check import rows_of

DAYS = [dt.date(1997, 11, 1) + dt.timedelta(days=i) for i in range(0, 160, 2)]  # the news is of 1998-01-02 to 1998-01-20


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("few"))
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    put("region", [(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string")
    put("nation", [(0, 0), (1, 1)], "n_nationkey int, n_regionkey int")
    put("supplier", [(s, s % 2) for s in range(4)], "s_suppkey long, s_nationkey int")
    put("lineitem", [(i * 4 + s, s, 1, dt.datetime.combine(d, dt.time()), 2.0, float(100 + (i * 7 + s * 5) % 13)) for i, d in enumerate(DAYS) for s in range(4)],
        "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp, l_quantity double, l_extendedprice double")
    put("documents", [(i, f"good day\nthe {i} of the bad", f"src{i % 2}") for i in range(1, 20)], "doc_id long, text string, source string")
    return at


@pytest.mark.parametrize("name", ["logit_buysell", "poly_logit"])
def test_models_take_days_without_news(spark, tables, name):
    duckdb = pytest.importorskip("duckdb")
    df = E.queries()[name](spark, tables)
    rows = [tuple(r) for r in df.collect()]
    # the last fifth of the days of two sectors, all of them after the news
    assert sorted({r[0] for r in rows}) == DAYS[64:] and len(rows) == 2 * len(DAYS[64:])
    con = duckdb.connect()
    for t in ("region", "nation", "supplier", "lineitem", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    rel = con.sql(E.oracle_sql()[name])
    assert rows_of(df.columns, rows) == rows_of(rel.columns, rel.fetchall())
