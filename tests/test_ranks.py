"""Totals over range partitions against plain sums."""

import random

import pytest
from pyspark.sql import functions as F

from tonetide.operators import ranks, split


@pytest.mark.parametrize("part_rows", [1, 7, 10**6])
def test_totals_before_match_plain_sums(spark, part_rows):
    rnd = random.Random(part_rows)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([rnd.randrange(9), 4, None]), k, rnd.randrange(5)) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, s int, k int, w int").withColumn("__t", F.lit("x"))
    got = ranks.with_totals_before(df.repartition(5), ["s", "k"], {"w_before": F.col("w"), "n": F.lit(1)}, by=["g"], part_rows=part_rows)
    assert got.columns == [*df.columns, "w_before", "n", "w_before_all", "n_all"]
    order = lambda r: (r[1] is not None, r[1] or 0, r[2])
    want = set()
    for g in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == g), key=order)
        want |= {(r[2], sum(x[3] for x in own[:i]), i, sum(x[3] for x in own), len(own)) for i, r in enumerate(own)}
    assert {(r.k, r.w_before, r.n, r.w_before_all, r.n_all) for r in got.collect()} == want


def test_a_hot_date_is_split_by_its_rows(spark):
    rows = [(1, k) for k in range(20)] + [(2, k) for k in range(300)] + [(3, k) for k in range(20)]
    df = spark.createDataFrame(rows, "Date int, Stock int").repartition(3)
    got = split.chrono_split_global(df, frac=0.5)
    assert {(r.Date, r.Stock) for r in got.where("is_train").collect()} == set(sorted(rows)[:170]) and got.count() == 340
    assert split.chrono_split_global(df.limit(0), frac=0.5).count() == 0


def test_shares_beside_a_whole_percent_agree_with_it(spark):
    df = spark.range(20_000)
    at = {f: {r.id for r in split.hash_split(df, "id", f).where("is_train").collect()} for f in (0.69999, 0.7, 0.7000001, 0.75)}
    assert at[0.69999] <= at[0.7] <= at[0.7000001] <= at[0.75]
    assert len(at[0.7]) - len(at[0.69999]) < 10 and len(at[0.7000001]) - len(at[0.7]) < 10 and len(at[0.75]) - len(at[0.7]) > 500
