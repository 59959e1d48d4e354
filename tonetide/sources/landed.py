"""Readers for landed dumps that replace the reference's network fetches.

* bars: one scan over files partitioned by ``Month`` (yyyy-MM) and clustered by
  stock inside the files (instead of one fetch and one local DataFrame per
  ticker, unioned in a loop). Partitioning by month keeps the directory count
  bounded by the calendar, not by the number of tickers; the date window prunes
  month directories and pushes down to the row groups. Provider-only columns
  are dropped, the sector is attached by a join to the dimension, then conformed.
* events: files partitioned by ``Day``; a day range prunes partitions.
* news: a dump read with a declared schema (json, parquet or csv).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.profile import conform
from .files import rebalance
from ..schemas import BAR_FACTORS, NEWS

PROVIDER_ONLY = ("Dividends", "Stock Splits")


def land_bars(bars: DataFrame, path: str) -> None:
    """Write bars as ``path/Month=<yyyy-MM>/``, one file per month, sorted by stock and date."""
    out = bars.withColumn("Month", F.date_format("Date", "yyyy-MM"))
    out = rebalance(out, "Month").sortWithinPartitions("Stock", "Date")
    out.write.mode("overwrite").partitionBy("Month").parquet(path)


def read_landed_bars(spark: SparkSession, path: str, start: str, end: str, dim: DataFrame,
                     schema: T.StructType | None = None) -> DataFrame:
    """Bars landed by :func:`land_bars`; [start, end) date window (prunes months)."""
    r = spark.read.option("basePath", path)
    if schema is not None:
        r = r.schema(schema)
    raw = r.parquet(path)
    raw = raw.drop(*[c for c in PROVIDER_ONLY if c in raw.columns])
    if "Month" in raw.columns:
        raw = raw.where((F.col("Month") >= F.lit(start[:7])) & (F.col("Month") <= F.lit(end[:7]))).drop("Month")
    raw = raw.where((F.col("Date") >= F.lit(start).cast("date")) & (F.col("Date") < F.lit(end).cast("date")))
    if "Category" in raw.columns:
        raw = raw.drop("Category")
    d = dim.select("Stock", "Category")
    joined = raw.join(d, "Stock", "left")
    out_schema = T.StructType([f for f in BAR_FACTORS.fields if f.name != "Dividends"])
    return conform(joined, out_schema)


def read_landed_events(spark: SparkSession, path: str, first_day: int | None = None,
                       last_day: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Events landed as ``path/Day=<yyyyMMdd>/``; the day range prunes partitions."""
    r = spark.read.option("basePath", path)
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    if first_day is not None:
        df = df.where(F.col("Day") >= F.lit(first_day))
    if last_day is not None:
        df = df.where(F.col("Day") <= F.lit(last_day))
    return df


def read_landed_news(spark: SparkSession, path: str, fmt: str = "json",
                     schema: T.StructType = NEWS) -> DataFrame:
    r = spark.read.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("multiLine", True).option("escape", '"')
    return r.format(fmt).load(path)
