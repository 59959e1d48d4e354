"""Views that give the driver's tables the reference's input shapes (FIXTURES.md §3).

* ticks / bars  <- lineitem, supplier, nation, region
* category_dim  <- supplier, nation, region   (Stock -> Category)
* news          <- documents (+ region for the category name)
* events_in     <- events

Scale notes
-----------
* ``bars`` aggregates lineitem by (Date, Stock) *before* joining the supplier
  dimension. The aggregation is partial (map-side combine), so a hot supplier
  or day collapses to one row per map task before any shuffle; the later join
  sees at most one row per stock and day, so it cannot be skewed.
* No join is force-broadcast. Spark broadcasts a side only when its size
  (file statistics, re-checked by AQE on runtime sizes) is under
  ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge
  join beyond it: nation/region (25/5 rows) always qualify; supplier, which
  grows with the data, qualifies only while it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SHIFT_MONTHS = 312  # 26 years: 2024-01 -> 1998-01


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def region_of_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_nationkey, r_regionkey, r_name): 25 rows."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "r_regionkey", "r_name"
    )


def category_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock -> Category dimension: supplier key -> region name."""
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Stock"), "s_nationkey"
    )
    nr = region_of_nation(spark, sf_dir)
    return s.join(nr, s.s_nationkey == nr.n_nationkey).select(
        "Stock", F.col("r_name").alias("Category")
    )


def attach_category(df: DataFrame, spark: SparkSession, sf_dir: str, key: str = "Stock") -> DataFrame:
    """Add ``Category`` (region name) to a frame keyed by supplier; null for an unknown supplier.

    The raw dimension scans are joined one at a time so that every build side
    carries exact file statistics: without CBO Spark estimates a join's size
    as the product of its inputs, and a pre-joined dimension would look larger
    than the fact side it should be joined into.
    """
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias(key), "s_nationkey")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"),
                                              F.col("r_name").alias("Category"))
    return (df.join(s, key, "left").join(n, "s_nationkey", "left").join(r, "n_regionkey", "left")
            .drop("s_nationkey", "n_regionkey"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trade: Date, Stock, Category, Price, Quantity + tie-break keys."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("Date"),
        F.col("l_suppkey").alias("Stock"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("Price"),
        F.col("l_quantity").alias("Quantity"),
    )
    return attach_category(li, spark, sf_dir).select(
        "Date", "Stock", "Category", "Price", "Quantity", "l_orderkey", "l_linenumber"
    )


# Cents of a price that take part in the order of trades with one key; dearer trades tie.
CENTS = 999_999_999


def trade_order(order="l_orderkey", line="l_linenumber", price="l_extendedprice"):
    """(orderkey, linenumber, price) as one decimal: 19, 10 and 9 digits."""
    cents = F.greatest(F.lit(0), F.least(F.round(F.col(price) * 100), F.lit(CENTS))).cast("decimal(9,0)")
    head = F.col(order).cast("decimal(19,0)") * F.lit(10**10).cast("decimal(11,0)") + F.col(line).cast("decimal(10,0)")
    return (head.cast("decimal(29,0)") * F.lit(10**9).cast("decimal(10,0)") + cents).cast("decimal(38,0)")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bar per stock, with per-bar VWAP: one hash aggregate on (Date, Stock).

    Open/Close are the first/last trade of the day in (orderkey, linenumber,
    price) order -- the price joins the order because (orderkey, linenumber)
    repeats in the test data. The order is one fixed-width decimal, which a
    hash aggregate updates in place (a struct would force an interpreted sort
    aggregate). The aggregate is partial first, so a hot stock or day is
    combined before the one shuffle.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("Date"),
        F.col("l_suppkey").alias("Stock"),
        trade_order().alias("k"),
        F.col("l_extendedprice").alias("p"),
        F.col("l_quantity").alias("q"),
    )
    daily = li.groupBy("Date", "Stock").agg(
        F.min_by("p", "k").alias("Open"),
        F.max("p").alias("High"),
        F.min("p").alias("Low"),
        F.max_by("p", "k").alias("Close"),
        F.sum("q").alias("Volume"),
        F.try_divide(F.sum(F.col("p") * F.col("q")), F.sum("q")).alias("VWAP"),
    )
    return attach_category(daily, spark, sf_dir).select(
        "Date", "Stock", "Category", "Open", "High", "Low", "Close", "Volume", "VWAP"
    )


def stock_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Date, Stock) of every bar, from those two columns alone."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("Date"), F.col("l_suppkey").alias("Stock")).distinct()


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("Stock")).distinct()


def daily_vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Date, Stock, Category, VWAP): the per-bar VWAP without Open/Close, one
    partial aggregate -- what the sector-index chain needs."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("Date"),
        F.col("l_suppkey").alias("Stock"),
        F.col("l_extendedprice").alias("p"),
        F.col("l_quantity").alias("q"),
    )
    daily = li.groupBy("Date", "Stock").agg(
        F.try_divide(F.sum(F.col("p") * F.col("q")), F.sum("q")).alias("VWAP"))
    return attach_category(daily, spark, sf_dir).select("Date", "Stock", "Category", "VWAP")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline rows: doc_id, date (text, some malformed), category, headline,
    short_description (the whole rest of the document after its first line)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    headline = F.split(F.col("text"), "\n", 2).getItem(0)
    src_num = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    withkey = docs.select(
        "doc_id",
        F.when(F.col("doc_id") % 50 == 0, F.lit("n/a"))
        .otherwise(
            F.date_format(
                F.date_add(F.lit("1998-01-01").cast("date"), (F.col("doc_id") % 366).cast("int")),
                "yyyy-MM-dd",
            )
        )
        .alias("date"),
        "source",
        (src_num % 5).alias("rk"),
        headline.alias("headline"),
        F.expr("substring(text, length(split(text, '\\n', 2)[0]) + 2)").alias("short_description"),
    )
    return withkey.join(r, withkey.rk == r.r_regionkey, "left").select(
        "doc_id", "date", F.initcap("r_name").alias("category"), "source", "headline",
        "short_description"
    )


def events_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News-event rows with the event feed's column names."""
    ev = table(spark, sf_dir, "events")
    # The feed is moved back EVENT_SHIFT_MONTHS so its days overlap the news
    # (1998) and bar (1995-2001) dates of the fixture tables.
    day = F.date_format(F.add_months(F.col("ts").cast("date"), -EVENT_SHIFT_MONTHS), "yyyyMMdd").cast("int")
    return ev.select(
        "event_id",
        day.alias("Day"),
        day.alias("DATEADDED"),
        (F.col("value") - F.lit(50.0)).alias("AvgTone"),
        F.col("event_type").alias("CAMEOCodeDescription"),
        F.concat(
            F.lit("u/"), F.col("user_id").cast("string"), F.lit("/"),
            F.get_json_object("props", "$.k"),
        ).alias("SOURCEURL"),
        F.when(F.col("user_id") % 2 == 0, F.lit("US")).otherwise(F.lit("FR")).alias(
            "ActionGeo_CountryCode"
        ),
    )
