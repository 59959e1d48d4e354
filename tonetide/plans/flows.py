"""Composed feature flows: each is one lazy plan over the fixture views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import cut_lineage
from ..functions.calendar import in_year
from ..functions.scalar import close_open, open_close_diff
from ..operators import market, normalize, sentiment as st, signal, tone
from ..sources import fixtures as fx


def sector_ohlc(bars: DataFrame) -> DataFrame:
    """Sector-level daily Open/Close: mean over the sector's stocks."""
    return bars.groupBy("Date", "Category").agg(F.avg("Open").alias("Open"), F.avg("Close").alias("Close"))


def daily_sentiment(spark, sf_dir) -> DataFrame:
    return st.daily_sentiment(st.news_scored(fx.news(spark, sf_dir)))


def sentiment_price(spark, sf_dir, year: int | None = 1998, keep_category: bool = False) -> DataFrame:
    """Daily sentiment ⋈ sector Open/Close on (date, lower(category)), then the
    year and either-nonzero filters and ``open_close_diff`` (the regression input)."""
    sent = daily_sentiment(spark, sf_dir).withColumn("date", F.to_date("date"))
    px = sector_ohlc(fx.bars(spark, sf_dir)).select(
        F.col("Date").alias("date"), F.lower("Category").alias("category"), "Open", "Close")
    return sentiment_with_prices(sent, px, year, keep_category)


def sentiment_with_prices(sent: DataFrame, px: DataFrame, year: int | None, keep_category: bool = False) -> DataFrame:
    """Join on (date, category), keep a year and rows with a non-zero score, add ``open_close_diff``."""
    j = sent.join(px, ["date", "category"], "inner").select(
        "date", *(["category"] if keep_category else []), "avg_sentiment", "avg_subjectivity", "Open", "Close")
    if year is not None:
        j = j.where(in_year("date", year))
    j = j.where((F.col("avg_sentiment") != 0) | (F.col("avg_subjectivity") != 0))
    return j.withColumn("open_close_diff", open_close_diff())


def stock_features(spark, sf_dir, momentum_k: int = 5) -> DataFrame:
    """Per stock and day: article count and subjectivity of its sector's news
    (0 on days without news), Momentum and the Close-Open label."""
    bars = fx.bars(spark, sf_dir)
    sent = daily_sentiment(spark, sf_dir).select(
        F.to_date("date").alias("__d"), F.col("category").alias("__c"),
        F.col("articles_count").cast("double").alias("avg_articles_count"), "avg_subjectivity")
    # one row per (day, sector); Spark broadcasts it while it is small (adaptive execution
    # knows its size) and splits hot keys of a sort-merge join otherwise
    j = bars.join(sent, (F.col("__d") == bars.Date) & (F.col("__c") == F.lower(bars.Category)), "left")
    j = signal.momentum(j, "Close", momentum_k)
    return j.select(
        "Date", "Stock", "Category",
        F.coalesce("avg_articles_count", F.lit(0.0)).alias("avg_articles_count"),
        F.coalesce("avg_subjectivity", F.lit(0.0)).alias("avg_subjectivity"),
        "Momentum",
        close_open().alias("Close-Open"),
    )


def in_news_span(df: DataFrame, spark, sf_dir, date: str = "Date") -> DataFrame:
    """Rows from the first to the last day that has news: a model of news features is fitted and tested there."""
    day = F.to_date("date")
    span = st.valid_dates(fx.news(spark, sf_dir)).agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()  # two dates
    return df.where(F.col(date).between(F.lit(span.lo), F.lit(span.hi)))


def buysell_in(spark, sf_dir) -> DataFrame:
    """Per (Date, Category): sentiment features and the next-day sector signal."""
    idx = market.sector_index(fx.daily_vwap(spark, sf_dir), "VWAP", "sectorIndex")
    sig = signal.buysell_signal(idx, "sectorIndex")
    sent = daily_sentiment(spark, sf_dir).select(
        F.to_date("date").alias("__d"), F.col("category").alias("__c"),
        "avg_sentiment", "avg_subjectivity", F.col("articles_count").cast("double").alias("avg_articles_count"))
    j = sig.join(sent, (F.col("__d") == sig.Date) & (F.col("__c") == F.lower(sig.Category)), "left")
    return j.select(
        "Date", "Category",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("avg_sentiment", "avg_subjectivity", "avg_articles_count")],
        F.col("BuySell").cast("double").alias("buySell"),
    )


def tone_features(spark, sf_dir) -> DataFrame:
    """US daily tone, URL-deduped, gap-filled, min-max normalised (num kept)."""
    ev = tone.dedup_url(tone.country(fx.events_in(spark, sf_dir), "US"))
    # A row for each day, materialised before the spine and the fill read it, and again before the bounds do.
    daily = cut_lineage(tone.tone_daily_stats(ev, count_nulls=True).drop("var_tone"))
    filled = cut_lineage(tone.gap_fill(daily, tone.month_spine(daily)))
    return normalize.minmax_normalize(filled, ["avg_tone", "std_tone", "median_tone"])


def three_way(spark, sf_dir) -> DataFrame:
    """sentiment ⋈ tone (date) ⋈ normalised sector index (date, category)."""
    sent = daily_sentiment(spark, sf_dir).withColumn("date", F.to_date("date"))
    tn = tone_features(spark, sf_dir).withColumnRenamed("Date", "date")
    # A row for each day and sector; its bounds and its rows are read from one result.
    sec = normalize.normalize_column(cut_lineage(market.sector_vwap(fx.daily_vwap(spark, sf_dir))), "Sector_VWAP",
                                     "Normalized_Sector_VWAP")
    sec = sec.select(F.col("Date").alias("date"), F.lower("Category").alias("category"),
                     "Normalized_Sector_VWAP")
    return sent.join(tn, "date").join(sec, ["date", "category"])
