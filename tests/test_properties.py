"""Property tests (hypothesis) on the operators' invariants."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonetide.operators import normalize, split, tone

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

floats = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(floats, min_size=2, max_size=30))
def test_scale_in_range_and_round_trip(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    out = normalize.minmax_range(df, ["x"], -1.0, 1.0)
    out = normalize.unscale_range(out, "x_scaled", "x", -1.0, 1.0, "x_back").collect()
    for r in out:
        assert -1.0 - 1e-9 <= r.x_scaled <= 1.0 + 1e-9
        if max(xs) != min(xs):
            assert abs(r.x_back - r.x) <= 1e-6 * max(1.0, abs(r.x))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 60)), min_size=1, max_size=60, unique=True),
       st.floats(0.1, 0.9))
def test_chrono_split_partitions_and_keeps_order(spark, rows, frac):
    base = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(k, base + dt.timedelta(days=d)) for k, d in rows], "Stock int, Date date")
    out = split.chrono_split(df, "Stock", "Date", frac).collect()
    assert len(out) == len(rows)
    for k in {r.Stock for r in out}:
        mine = sorted((r.Date, r.is_train) for r in out if r.Stock == k)
        flags = [f for _, f in mine]
        assert flags == sorted(flags, reverse=True)  # all train rows precede test rows
        assert sum(flags) == int(len(mine) * frac + 1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=80), st.floats(0.1, 0.9))
def test_chrono_split_global_counts(spark, rows, frac):
    base = dt.date(2020, 1, 1)
    data = [(i, base + dt.timedelta(days=d), c) for i, (d, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, Date date, Category int")
    out = split.chrono_split_global(df, "Date", ("Category", "id"), frac).collect()
    assert len(out) == len(rows)
    want = sorted(data, key=lambda t: (t[1], t[2], t[0]))
    cut = int(len(data) * frac + 1e-9)
    train_ids = {t[0] for t in want[:cut]}
    assert {r.id for r in out if r.is_train} == train_ids


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 2)), min_size=1, max_size=50))
def test_dedup_is_idempotent(spark, rows):
    data = [(i, 20200101 + d, f"u{u}") for i, (d, u) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id int, Day int, SOURCEURL string")
    once = tone.dedup_url(df)
    twice = tone.dedup_url(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == len({(d, u) for d, u in rows})


@SETTINGS
@given(st.lists(floats, min_size=1, max_size=40))
def test_hash_split_is_reproducible(spark, xs):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "k int, x double")
    a = split.hash_split(df, F.col("k").cast("string"), 0.7).collect()
    b = split.hash_split(df, F.col("k").cast("string"), 0.7).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
