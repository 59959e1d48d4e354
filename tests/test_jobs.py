"""Jobs over the reference's input shapes, fed with dumps written from the fixture views."""

import os
import statistics

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tonetide.plans import flows, jobs
from tonetide.plans.catalog import rounded
from tonetide.sources import files, fixtures as fx

from conftest import SF_SMALL

Q = E.queries()


@pytest.fixture(scope="module")
def dumps(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dumps"))
    p = lambda n: os.path.join(root, n)
    # volumes in share units, as real bar dumps have them (the job scales by 1e-7)
    bars = fx.bars(spark, SF_SMALL).select("Date", F.col("Stock").cast("string").alias("Stock"), "Category",
                                           "Open", "High", "Low", "Close", (F.col("Volume") * 1e6).alias("Volume"))
    files.write_csv(bars, p("merged.csv"))
    idx = Q["buysell_signal"](spark, SF_SMALL).select("Date", "Category", "sectorIndex")
    files.write_csv(idx, p("sectorIndex.csv"))
    feats = flows.stock_features(spark, SF_SMALL).select(
        "Date", F.col("Stock").cast("string").alias("Stock"), "avg_articles_count", "avg_subjectivity",
        "Momentum", "Close-Open")
    files.write_csv(feats, p("features.csv"))
    bi = flows.buysell_in(spark, SF_SMALL).withColumnRenamed("buySell", "BuySell")
    files.write_csv(bi, p("new_data.csv"))
    news = fx.news(spark, SF_SMALL).select("date", "category", "headline", "short_description",
                                           F.lit("l").alias("link"), F.lit("a").alias("authors"))
    news.write.json(p("news.json"))
    ev = fx.events_in(spark, SF_SMALL).orderBy("event_id").select(
        "DATEADDED", "CAMEOCodeDescription", "AvgTone", "SOURCEURL", "ActionGeo_CountryCode")
    files.write_csv(ev, p("events.csv"), single_file=True)
    return p


def test_buysell_job_matches_query(spark, dumps):
    out = jobs.buysell(spark, dumps("sectorIndex.csv"), dumps("o_buysell"))
    want = Q["buysell_signal"](spark, SF_SMALL)
    assert sorted((r.Date, r.Category, r.BuySell) for r in out.collect()) == \
        sorted((r.Date, r.Category, r.BuySell) for r in want.collect())


def test_sentiment_job_matches_query(spark, dumps):
    out = rounded(jobs.sentiment(spark, dumps("news.json"), dumps("o_sent")))
    want = Q["daily_sentiment"](spark, SF_SMALL)
    key = lambda r: (r.date, r.category, r.avg_sentiment, r.avg_subjectivity, r.articles_count)
    assert sorted(map(key, out.collect())) == sorted(map(key, want.collect()))


def test_daily_tone_job_keeps_one_row_of_a_url_by_content(spark, dumps):
    out = rounded(jobs.daily_tone(spark, dumps("events.csv"), dumps("o_tone")))
    seen = {}  # (url, day) -> the smallest row by content
    cols = ["DATEADDED", "CAMEOCodeDescription", "AvgTone", "SOURCEURL", "ActionGeo_CountryCode"]
    for r in fx.events_in(spark, SF_SMALL).where("ActionGeo_CountryCode = 'US'").select(*cols).collect():
        key = (r.SOURCEURL, r.DATEADDED)
        seen[key] = min(seen.get(key, tuple(r)), tuple(r))
    by_day = {}
    for row in seen.values():
        by_day.setdefault(str(row[0]), []).append(row[2])
    got = {r.Date.strftime("%Y%m%d"): r for r in out.collect() if r.num}
    assert got.keys() == by_day.keys()
    for day, tones in by_day.items():
        assert got[day].num == len(tones)
        assert got[day].median_tone == pytest.approx(statistics.median(tones), abs=1e-4)
        assert got[day].std_tone == pytest.approx(statistics.stdev(tones), abs=1e-4)


def test_per_stock_regression_job_matches_query(spark, dumps):
    out = jobs.per_stock_regression(spark, dumps("features.csv"), dumps("o_lr"))
    want = {str(r.Stock): r.r2 for r in Q["lr_per_stock"](spark, SF_SMALL).collect()}
    got = {r.Stock: r.r2 for r in out.collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert (got[k] is None and want[k] is None) or abs(got[k] - want[k]) < 1e-3


def test_bar_jobs(spark, dumps):
    si = jobs.sector_index(spark, dumps("merged.csv"), dumps("o_si"))
    vals = [r.Normalized_Sector_VWAP for r in si.collect()]
    assert min(vals) == 0.0 and max(vals) == 1.0
    ma = jobs.moving_average(spark, dumps("merged.csv"), dumps("o_ma"))
    assert ma.count() == si.count()
    rp = jobs.ranked_price(spark, dumps("merged.csv"), dumps("o_rp"))
    assert {r.Category_Rank for r in rp.collect()} == {1}


def test_model_jobs(spark, dumps):
    assert jobs.lag_sweep(spark, dumps("features.csv"), dumps("o_lag")).count() == 32
    aucs = jobs.classifiers(spark, dumps("new_data.csv"), dumps("o_clf")).collect()
    assert {r.model for r in aucs} == {"logistic", "random_forest", "poly_logistic"}
    lpm = jobs.linear_probability(spark, dumps("new_data.csv"), dumps("o_lpm")).collect()
    assert len(lpm) == 5 and all(r.n > 0 and r.r2 is not None for r in lpm)


def test_sentiment_to_regression(spark, dumps):
    """The headline flow from files: scores, prices of a year, regression."""
    jobs.sentiment(spark, dumps("news.json"), dumps("daily"))
    joined = jobs.sentiment_price(spark, dumps("daily"), dumps("merged.csv"), dumps("aa"), year="1998")
    want = flows.sentiment_price(spark, SF_SMALL)
    assert joined.columns == want.columns
    near = lambda df: sorted((r.date, round(r.avg_sentiment, 6), round(r.open_close_diff, 4)) for r in df.collect())
    assert near(joined) == near(want)
    pred = jobs.sentiment_regression(spark, dumps("aa"), dumps("pred")).collect()
    assert pred and all(r.prediction is not None for r in pred)


def test_three_way_and_dump(spark, dumps):
    jobs.sentiment(spark, dumps("news.json"), dumps("daily3"))
    jobs.daily_tone(spark, dumps("events.csv"), dumps("tone3"))
    tone3 = spark.read.option("header", True).csv(dumps("tone3")).select("Date", "num", "avg_tone", "std_tone", "median_tone")
    files.write_csv(tone3, dumps("tone3b"))
    jobs.sector_index(spark, dumps("merged.csv"), dumps("idx3"))
    idx = spark.read.option("header", True).csv(dumps("idx3")).select("Date", "Category", "Normalized_Sector_VWAP")
    files.write_csv(idx, dumps("idx3b"))
    out = jobs.three_way(spark, dumps("daily3"), dumps("tone3b"), dumps("idx3b"), dumps("o_three"))
    want = flows.three_way(spark, SF_SMALL)
    assert sorted(out.columns) == sorted(want.columns)
    assert sorted((r.date, r.category) for r in out.collect()) == sorted((r.date, r.category) for r in want.collect())
    dump = jobs.stock_dump(spark, dumps("merged.csv"), dumps("o_dump"))
    assert "Custom_Metric" in dump.columns and spark.read.parquet(dumps("o_dump")).count() == dump.count()


def test_ingest_events_job(spark, dumps):
    jobs.ingest_events(spark, dumps("events.csv"), dumps("o_ingest"))
    back = spark.read.parquet(dumps("o_ingest"))
    assert back.count() == Q["tone_source"](spark, SF_SMALL).count()


def test_cli_lists_jobs(capsys):
    assert jobs.main([]) == 2
    assert "sector_index" in capsys.readouterr().out
