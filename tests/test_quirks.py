"""Hand-made edge fixtures for the reference's quirks."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from tonetide.functions import calendar, scalar, text
from tonetide.operators import market, normalize, profile, signal, split, tone


def d(s):
    return dt.date.fromisoformat(s)


def test_q3_bround_half_even(spark):
    df = spark.createDataFrame([(x,) for x in (1234.5, 0.125, 0.375, 2.675, 1.005, -0.125)], "x double")
    got = [r[0] for r in df.select(scalar.bar_round("x")).collect()]
    # bround rounds the decimal representation half-even and has no thousands separator
    assert got == [1234.5, 0.12, 0.38, 2.68, 1.0, -0.12]


def test_q5_moving_average_uses_six_rows(spark):
    rows = [(d("2020-01-%02d" % i), "A", float(i)) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "Date date, Category string, Sector_VWAP double")
    out = {r.Date.day: r.MovingAvg_VWAP for r in market.moving_avg(df).collect()}
    assert out[1] == 1.0
    assert out[6] == sum(range(1, 7)) / 6
    assert out[8] == sum(range(3, 9)) / 6


def test_q5_moving_average_of_constant_is_constant(spark):
    rows = [(d("2020-01-%02d" % i), "A", 7.5) for i in range(1, 12)]
    df = spark.createDataFrame(rows, "Date date, Category string, Sector_VWAP double")
    assert {r.MovingAvg_VWAP for r in market.moving_avg(df, preceding=3).collect()} == {7.5}


def test_q6_category_rank_is_always_one(spark):
    rows = [(d("2020-01-0%d" % i), c, float(i)) for i in range(1, 4) for c in ("A", "B")]
    df = spark.createDataFrame(rows, "Date date, Category string, Sector_Average_Price double")
    assert {r.Category_Rank for r in market.category_rank(df).collect()} == {1}


def test_q9_except_vs_except_all(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,), (3,)], "x int")
    train = spark.createDataFrame([(1,), (2,)], "x int")
    assert sorted(r.x for r in split.except_distinct(a, train).collect()) == [3]
    assert sorted(r.x for r in split.except_all(a, train).collect()) == [2, 3, 3]


def test_q19_signal_last_row_null_and_flat_is_sell(spark):
    rows = [(d("2020-01-01"), "A", 1.0), (d("2020-01-02"), "A", 1.0), (d("2020-01-03"), "A", 2.0),
            (d("2020-01-04"), "A", 1.5), (d("2020-01-01"), "B", 5.0)]
    df = spark.createDataFrame(rows, "Date date, Category string, sectorIndex double")
    out = {(r.Category, r.Date.day): r.BuySell for r in signal.buysell_signal(df).collect()}
    assert out[("A", 1)] == 0  # flat -> sell
    assert out[("A", 2)] == 1
    assert out[("A", 3)] == 0
    assert out[("A", 4)] is None
    assert out[("B", 1)] is None  # single date


def test_zero_volume_vwap_is_null(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 2.0)], "Close double, Volume double")
    assert [r.VWAP for r in market.with_row_vwap(df).collect()] == [None, 10.0]
    ticks = spark.createDataFrame([(d("2020-01-01"), 1, "A", 5.0, 0.0)],
                                  "Date date, Stock int, Category string, Price double, Quantity double")
    assert market.vwap_window(ticks).collect()[0].VWAP is None


def test_flat_series_minmax(spark):
    df = spark.createDataFrame([(d("2020-01-0%d" % i), 1, 3.0) for i in range(1, 4)], "Date date, Stock int, x double")
    assert {r.normalized_x for r in normalize.minmax_normalize(df, ["x"]).collect()} == {None}
    assert {r.x_scaled for r in normalize.minmax_per_key(df, ["x"], "Stock").collect()} == {0.5}


def test_gap_days_become_zero_rows(spark):
    daily = spark.createDataFrame([(d("2020-02-27"), 3, 1.5), (d("2020-02-29"), 1, -2.0)],
                                  "Date date, num bigint, avg_tone double")
    out = tone.gap_fill(daily, tone.month_spine(daily)).orderBy("Date").collect()
    assert len(out) == 29  # leap February
    by_day = {r.Date.day: (r.num, r.avg_tone) for r in out}
    assert by_day[28] == (0, 0.0)
    assert by_day[27] == (3, 1.5)


def test_days_in_month_matches_calendar(spark):
    import calendar as cal

    rows = [(y, m) for y in (1900, 2000, 2023, 2024) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "y int, m int")
    out = df.select("y", "m", calendar.days_in_month(F.make_date("y", "m", F.lit(1))).alias("n")).collect()
    assert all(r.n == cal.monthrange(r.y, r.m)[1] for r in out)


def test_blanks_are_unicode(spark):
    rows = [("see http://x.y/z\u00a0next a\u00a0b",), ("can't\u2003do",), ("\u00a0 \u3000",), (" one\u2028two ",)]
    df = spark.createDataFrame(rows, "t string")
    assert [r[0] for r in df.select(text.clean_text("t")).collect()] == ["see next a b", "cannot do", "", "one two"]
    assert [r[0] for r in df.select(text.whitespace_tokens("t")).collect()][2:] == [[], ["one", "two"]]


def test_letters_of_any_script_hold_a_word_together(spark):
    from tonetide.operators import sentiment as st

    rows = [(1, "modèle"), (2, "le modèle"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id int, headline_description string")
    got = {r.doc_id: r.sentiment for r in st.score_docs(df, st.lexicon_frame(spark)).collect()}
    assert got == {1: 0.0, 2: 0.35, 3: 0.0, 4: 0.0}
    assert {r.doc_id: r.sentiment for r in st.score_text(df).collect()} == got


def test_dates_that_do_not_exist_are_not_valid(spark):
    df = spark.createDataFrame([("2016-02-30",), ("2016-02-29",), ("n/a",), (None,)], "d string")
    assert [r[0] for r in df.where(calendar.valid_iso_date("d")).collect()] == ["2016-02-29"]


def test_clean_text_chain(spark):
    df = spark.createDataFrame([("Can't stop; won't stop! see http://x.y/z  NOW\tok",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(text.clean_text("t")).collect()]
    # "Can't" is matched before lower-casing, so only the lower-case contraction expands
    assert got[0] == "can't stop will not stop see now ok"
    assert got[1] == ""
    assert got[2] is None


def test_dedup_keeps_smallest_event_id(spark):
    rows = [(3, 20200101, "u"), (1, 20200101, "u"), (2, 20200102, "u")]
    df = spark.createDataFrame(rows, "event_id int, Day int, SOURCEURL string")
    out = sorted(tuple(r) for r in tone.dedup_url(df).collect())
    assert out == [(1, 20200101, "u"), (2, 20200102, "u")]


def test_conform_pads_and_orders(spark):
    from tonetide import schemas

    df = spark.createDataFrame([("X", 1.0)], "Stock string, close double")
    out = profile.conform(df, schemas.BAR_FACTORS)
    assert out.columns == [f.name for f in schemas.BAR_FACTORS.fields]
    r = out.collect()[0]
    assert r.Close == 1.0 and r.Open is None and r.Stock == "X"


def test_lag_array_matches_lag_columns(spark):
    rows = [(1, d("2020-01-%02d" % i), float(i) if i != 3 else None) for i in range(1, 7)]
    df = spark.createDataFrame(rows, "Stock int, Date date, x double")
    cols = signal.lag_features(df, "x", 3).orderBy("Date").collect()
    arr = signal.lag_array(df, "x", 3).orderBy("Date").collect()
    for c, a in zip(cols, arr):
        assert list(a.lags) == [c["x_Lag_1"], c["x_Lag_2"], c["x_Lag_3"]]


def test_sorted_csv_export_and_error_mode(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    from tonetide.sources import files

    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "out")
    files.write_csv(df.repartition(3), path, order_by="k")
    back = files.read_csv(spark, path, df.schema)
    assert [r.k for r in back.collect()] == [1, 2, 3]
    with pytest.raises(AnalysisException):
        files.write_csv(df, path, mode="errorifexists")


def test_random_split_is_seeded(spark):
    df = spark.range(200)
    a1, b1 = split.random_split(df, 0.8, seed=7)
    a2, b2 = split.random_split(df, 0.8, seed=7)
    assert sorted(r.id for r in a1.collect()) == sorted(r.id for r in a2.collect())
    assert a1.count() + b1.count() == 200


def test_ticker_dim_is_110_rows_in_11_sectors(spark):
    from tonetide.sources import dims

    t = dims.ticker_dim(spark)
    assert t.count() == 110
    assert t.select("Category").distinct().count() == 11


def test_minmax_per_key_fit_on_train_only(spark):
    rows = [(1, d("2020-01-0%d" % i), float(i), i <= 3) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "Stock int, Date date, x double, is_train boolean")
    leak = {r.Date.day: r.x_scaled for r in normalize.minmax_per_key(df, ["x"]).collect()}
    fit = {r.Date.day: r.x_scaled for r in normalize.minmax_per_key(df, ["x"], fit_on="is_train").collect()}
    assert leak[5] == 1.0 and leak[1] == 0.0
    assert fit[1] == 0.0 and fit[3] == 1.0 and fit[5] == 2.0  # test row beyond the train range


def test_q11_label_must_exist(spark):
    import pytest

    from tonetide.plans import models

    df = spark.createDataFrame([(1.0, 0.0)], "buySell double, x double")
    with pytest.raises(ValueError):
        models.linear_probability(df, df, label="buysell_typo")


def test_empty_frames_stay_empty(spark):
    from tonetide.plans import metrics

    bars = spark.createDataFrame([], "Date date, Stock long, Category string, VWAP double, Open double, "
                                     "High double, Low double, Close double, Volume double")
    assert market.sector_vwap(bars).count() == 0
    assert market.moving_avg(market.sector_vwap(bars)).count() == 0
    assert signal.buysell_signal(market.sector_index(bars, "VWAP", "sectorIndex")).count() == 0
    ev = spark.createDataFrame([], "event_id long, Day int, SOURCEURL string, AvgTone double")
    assert tone.tone_daily_stats(tone.dedup_url(ev)).count() == 0
    scored = spark.createDataFrame([], "y int, s double")
    assert metrics.regression_metrics(scored.selectExpr("cast(y as double) y", "s"), "y", "s").collect()[0].n == 0


def test_describe_of_text_columns(spark):
    df = spark.createDataFrame([("b", "1"), ("a", "x"), (None, None)], "t string, v string")
    got = {r["column"]: tuple(r)[1:] for r in profile.summary_text(df, ["t", "v"]).collect()}
    assert got == {"t": (2, "a", "b"), "v": (2, "1", "x")}
    one = profile.summary_long(df, ["v"]).first()  # text that is no number counts as null
    assert (one["count"], one["mean"]) == (1, 1.0)


def test_skipped_files_are_listed(spark, tmp_path):
    from tonetide.sources import files

    spark.createDataFrame([(1,), (2,)], "k int").coalesce(1).write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "in"))
    (tmp_path / "in" / "bad.csv.gz").write_bytes(b"no gzip at all")
    rows = files.read_csv(spark, str(tmp_path / "in"), "k int", ignore_corrupt_files=True)
    assert sorted(r.k for r in rows.collect()) == [1, 2]
    listed = [r.path for r in files.skipped_files(spark, str(tmp_path / "in"), rows).collect()]
    assert any(p.endswith("bad.csv.gz") for p in listed) and not any("part-" in p for p in listed)


def test_load_ledger_tells_sources_apart(spark, tmp_path):
    from tonetide.sources import files
    import gzip

    (tmp_path / "in").mkdir()
    whole = b"k,v\n1,a\n2,b\n"
    for name, data in (("good.csv", whole), ("zipped.csv.gz", gzip.compress(whole)), ("half.csv", b"k,v\n1,a\nx,b\n\n"), ("bad.csv", b"k,v\nx,a\n"),
                       ("title.csv", b"k,v\n"), ("nothing.csv", b""), ("broken.csv.gz", b"no gzip at all"), ("no title.csv", b"7,z\n")):
        (tmp_path / "in" / name).write_bytes(data)
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    ledger = files.load_ledger(spark, str(tmp_path / "in"), schema, header=True, source=lambda c: F.regexp_extract(c, "([^/]*)$", 1))
    got = {r.source: (r.outcome, r.good_rows, r.rejected_rows) for r in ledger.collect()}
    assert got == {"good.csv": ("loaded", 2, 0), "zipped.csv.gz": ("loaded", 2, 0), "half.csv": ("partial", 1, 1), "bad.csv": ("rejected", 0, 1),
                   "title.csv": ("empty", 0, 0), "nothing.csv": ("empty", 0, 0), "broken.csv.gz": ("unreadable", 0, 0), "no%20title.csv": ("loaded", 1, 0)}
    both = files.load_ledger(spark, str(tmp_path / "in"), schema, header=True, source=lambda c: F.lit("all")).collect()
    assert [(r.outcome, r.reason, r.files) for r in both] == [("unreadable", "1 of 8 files can't be read", 8)]


@pytest.mark.parametrize("ranked, cuts", [(3, 4), (10, 8), (100_000, 256)])
def test_exact_median_by_rounds(spark, monkeypatch, ranked, cuts):
    """A far value, heavy ties, even and odd counts; the last round ranks at most ``ranked`` values."""
    import random
    import statistics

    monkeypatch.setattr(tone, "RANKED", ranked)
    monkeypatch.setattr(tone, "CUTS", cuts)
    rnd = random.Random(1)
    rows = [(k % 5, round(rnd.expovariate(1) ** 3, 2)) for k in range(400)] + [(7, 1.0), (8, 2.0), (8, 3.0), (9, 5.0), (9, 5.0), (9, 5.0), (None, 4.0)]
    rows += [(10, 1e9), (10, -1e300), *[(10, rnd.uniform(-10, 10)) for _ in range(200)], *[(11, float(k)) for k in range(40)], *[(11, 19.0)] * 300]
    df = spark.createDataFrame(rows, "k int, v double").groupBy("k", "v").count()
    got = {r.k: r.median for r in tone.exact_median(df, "k", "v", "count").collect()}
    want = {k: statistics.median(v for a, v in rows if a == k) for k in {r[0] for r in rows}}
    assert got == want


@pytest.mark.parametrize("ranked", [5, 100_000])
def test_daily_statistics_with_far_values(spark, monkeypatch, ranked):
    import random
    import statistics

    monkeypatch.setattr(tone, "RANKED", ranked)
    monkeypatch.setattr(tone, "CUTS", 4)
    rnd = random.Random(2)
    rows = [(20200101, rnd.uniform(90, 110)) for _ in range(60)] + [(20200102, 1e9)] + [(20200102, rnd.gauss(0, 1)) for _ in range(30)]
    rows += [(20200103, 4.0), (20200104, None), (20200104, 2.0), (20200104, 3.0), (None, 7.0), (20200105, None)]
    got = {r.Date and r.Date.day: r for r in tone.tone_daily_stats(spark.createDataFrame(rows, "Day int, AvgTone double")).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    for day, r in got.items():
        own = [t for d_, t in rows if (d_ and d_ % 100) == day and t is not None]
        assert r.num == len(own) and r.median_tone == (statistics.median(own) if own else None)
        assert r.avg_tone == (pytest.approx(statistics.mean(own)) if own else None)
        assert r.var_tone == (pytest.approx(statistics.variance(own), rel=1e-9) if len(own) > 1 else None)


def test_dedup_of_ties(spark):
    rows = [("u", 1, 5, "b"), ("u", 1, 5, "a"), ("u", 1, 5, "a"), ("u", 1, None, "c"), ("v", 1, None, "d"), ("v", 1, None, "d"), (None, 2, 1, "e"),
            (None, 2, 3, "f"), ("w", None, -4, "g"), ("w", None, -3, "h")]
    df = spark.createDataFrame(rows, "url string, day int, event_id long, x string")
    got = sorted((tuple(r) for r in tone.dedup_on(df, ["url", "day"], "event_id").collect()), key=repr)
    assert [r for r in got if r[0] != "u"] == sorted([("v", 1, None, "d"), (None, 2, 1, "e"), ("w", None, -4, "g")], key=repr)
    assert [r[2] for r in got if r[0] == "u"] == [5] and len(got) == 4


def test_null_keys_stay_in_the_row_level_vwap(spark):
    ticks = spark.createDataFrame([(None, 1, 5.0, 2.0), (d("2020-01-01"), None, 4.0, 1.0), (None, 1, 9.0, 2.0)],
                                  "Date date, Stock int, Price double, Quantity double")
    assert sorted((r.Price, r.VWAP) for r in market.vwap_window(ticks).collect()) == [(4.0, 4.0), (5.0, 7.0), (9.0, 7.0)]


def test_fractions_of_a_percent_are_kept(spark):
    df = spark.range(20000)
    n = split.hash_split(df, "id", 0.005).where("is_train").count()
    assert 60 <= n <= 140
    assert split.hash_split(df, "id", 0.0).where("is_train").count() == 0
