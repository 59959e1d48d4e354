"""Declared schemas of the library's inputs (FIXTURES.md §1)."""

from pyspark.sql import types as T

BARS = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Stock", T.LongType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
    T.StructField("VWAP", T.DoubleType()),
])

# The reference's per-ticker frame after padding: factors in fixed order.
BAR_FACTORS = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
    T.StructField("Stock", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Dividends", T.DoubleType()),
])

SECTOR_SIGNAL = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Sector_VWAP", T.DoubleType()),
    T.StructField("MovingAvg_VWAP", T.DoubleType()),
    T.StructField("BuySell", T.IntegerType()),
])

EVENTS_RAW = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("Day", T.IntegerType()),
    T.StructField("AvgTone", T.DoubleType()),
    T.StructField("SOURCEURL", T.StringType()),
])

NEWS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("short_description", T.StringType()),
])

TONE = T.StructType([
    T.StructField("Tone", T.DoubleType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Url", T.StringType()),
    T.StructField("Date", T.DateType()),
])

LEXICON = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("polarity", T.DoubleType()),
    T.StructField("subjectivity", T.DoubleType()),
])

# ---- input shapes of the reference's CSV dumps (header row, declared types) ----

MERGED_BARS = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Stock", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
])

SECTOR_INDEX = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Category", T.StringType()),
    T.StructField("sectorIndex", T.DoubleType()),
])

DAILY_SENTIMENT_IN = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Category", T.StringType()),
    T.StructField("avg_sentiment", T.DoubleType()),
    T.StructField("avg_subjectivity", T.DoubleType()),
    T.StructField("articles_count", T.DoubleType()),
])

STOCK_FEATURES = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Stock", T.StringType()),
    T.StructField("avg_articles_count", T.DoubleType()),
    T.StructField("avg_subjectivity", T.DoubleType()),
    T.StructField("Momentum", T.DoubleType()),
    T.StructField("Close-Open", T.DoubleType()),
])

BUYSELL_IN = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Category", T.StringType()),
    T.StructField("avg_sentiment", T.DoubleType()),
    T.StructField("avg_subjectivity", T.DoubleType()),
    T.StructField("avg_articles_count", T.DoubleType()),
    T.StructField("BuySell", T.DoubleType()),
])

EVENT_FEED = T.StructType([
    T.StructField("DATEADDED", T.IntegerType()),
    T.StructField("CAMEOCodeDescription", T.StringType()),
    T.StructField("AvgTone", T.DoubleType()),
    T.StructField("SOURCEURL", T.StringType()),
    T.StructField("ActionGeo_CountryCode", T.StringType()),
])

NEWS_DUMP = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("short_description", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("authors", T.StringType()),
])

DAILY_SENTIMENT_OUT = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("category", T.StringType()),
    T.StructField("avg_sentiment", T.DoubleType()),
    T.StructField("avg_subjectivity", T.DoubleType()),
    T.StructField("articles_count", T.LongType()),
])

REGRESSION_IN = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("avg_sentiment", T.DoubleType()),
    T.StructField("avg_subjectivity", T.DoubleType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("open_close_diff", T.DoubleType()),
])

TONE_DAILY = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("num", T.LongType()),
    T.StructField("avg_tone", T.DoubleType()),
    T.StructField("std_tone", T.DoubleType()),
    T.StructField("median_tone", T.DoubleType()),
])

SECTOR_INDEX_NORMALIZED = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Normalized_Sector_VWAP", T.DoubleType()),
])
