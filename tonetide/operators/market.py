"""Bar, sector-index and ranking operators.

Window partitions here are (Category) or (Stock) over *daily* rows, so a
partition holds at most one row per calendar day: its size is bounded by the
date range, not by the data volume, even when one key carries a large share
of the raw trades (those collapse in the partial aggregation that builds the
bars).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import (
    BAR_WEIGHTS,
    average_price,
    bar_round,
    custom_metric,
    row_vwap,
    weighted,
)


def scale_and_round_bars(bars: DataFrame, weights: dict | None = None, digits: int = 2) -> DataFrame:
    """Weight each attribute, round it to cents (HALF_EVEN) and add Custom_Metric."""
    weights = weights or BAR_WEIGHTS
    out = bars.withColumns({c: bar_round(weighted(c, w), digits) for c, w in weights.items()})
    return out.withColumn("Custom_Metric", custom_metric(tuple(weights), digits))


def with_row_vwap(bars: DataFrame, price="Close", volume="Volume", out="VWAP") -> DataFrame:
    return bars.withColumn(out, row_vwap(price, volume))


def vwap_by_stock_day(ticks: DataFrame, price="Price", qty="Quantity") -> DataFrame:
    """Σ(price·qty)/Σqty per (Date, Stock, Category) as an aggregate.

    Same numbers as ``sum(..) over (partition by Date, Stock)`` without the
    window: the partial aggregation makes a hot (Date, Stock) key harmless.
    """
    return ticks.groupBy("Date", "Stock", "Category").agg(
        F.try_divide(F.sum(F.col(price) * F.col(qty)), F.sum(qty)).alias("VWAP"),
        F.sum(qty).alias("Volume"),
        F.count(F.lit(1)).alias("n_ticks"),
    )


def vwap_window(ticks: DataFrame, price="Price", qty="Quantity") -> DataFrame:
    """Row-level VWAP column: every trade row gets its (Date, Stock) VWAP; null keys are keys too.

    Implemented as aggregate + equi-join back rather than an unordered window,
    so a hot key is pre-aggregated and the join-back can be split by AQE's
    skew-join handling instead of sorting one huge window partition.
    """
    per_key = ticks.groupBy(F.col("Date").alias("__d"), F.col("Stock").alias("__s")).agg(
        F.try_divide(F.sum(F.col(price) * F.col(qty)), F.sum(qty)).alias("VWAP")
    )
    same = F.col("Date").eqNullSafe(F.col("__d")) & F.col("Stock").eqNullSafe(F.col("__s"))
    return ticks.join(per_key, same).drop("__d", "__s")


def sector_index(bars: DataFrame, metric: str = "VWAP", out: str = "Sector_VWAP") -> DataFrame:
    """Average of a per-stock metric by (Date, Category) (partial + final aggregate)."""
    return bars.groupBy("Date", "Category").agg(F.avg(metric).alias(out))


def sector_vwap(bars: DataFrame) -> DataFrame:
    return sector_index(bars, "VWAP", "Sector_VWAP")


def sector_avg_price(bars: DataFrame) -> DataFrame:
    return sector_index(bars.withColumn("Average_Price", average_price()), "Average_Price",
                        "Sector_Average_Price")


def moving_avg(df: DataFrame, value="Sector_VWAP", out="MovingAvg_VWAP", preceding: int = 5,
               key="Category", order="Date") -> DataFrame:
    """Trailing mean over ``preceding`` rows plus the current one.

    ``preceding=5`` gives a six-row frame, as in the reference (labelled 5-day).
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-preceding, 0)
    return df.withColumn(out, F.avg(value).over(w))


def category_rank(df: DataFrame) -> DataFrame:
    """Reference ranking: rank() by Category ordered by Category -> always 1."""
    w = Window.partitionBy("Category").orderBy("Category")
    return df.withColumn("Category_Rank", F.rank().over(w))


def category_rank_by_value(df: DataFrame, value="Sector_Average_Price", out="Category_Value_Rank") -> DataFrame:
    """Useful variant: rank of the categories within each Date by value (desc)."""
    w = Window.partitionBy("Date").orderBy(F.col(value).desc())
    return df.withColumn(out, F.rank().over(w))


def date_rank(df: DataFrame, key="Category", order="Date", out="Date_Rank") -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn(out, F.rank().over(w))


def row_rank(df: DataFrame, key="Category", order="Date", out="Rank") -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn(out, F.row_number().over(w))
