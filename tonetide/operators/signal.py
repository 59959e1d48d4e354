"""Signals and lag features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import positive_bit


def buysell_signal(df: DataFrame, index_col="sectorIndex", key="Category", order="Date",
                   out="BuySell") -> DataFrame:
    """1 if the next row's index is higher, 0 otherwise; null on the last row of a key.

    A zero change counts as sell (0), as in the reference.
    """
    w = Window.partitionBy(key).orderBy(order)
    nxt = F.lead(index_col, 1).over(w)
    return df.withColumn(out, positive_bit(nxt - F.col(index_col)))


def lag_features(df: DataFrame, col: str, max_lag: int, key="Stock", order="Date",
                 prefix: str | None = None) -> DataFrame:
    """``col_Lag_i = lag(col, i)`` for i in 1..max_lag on one shared window spec.

    All lags share one Window object, so Catalyst plans one sort and one
    Exchange for any number of lags.
    """
    prefix = prefix or f"{col}_Lag_"
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumns({f"{prefix}{i}": F.lag(col, i).over(w) for i in range(1, max_lag + 1)})


def lag_array(df: DataFrame, col: str, max_lag: int, key="Stock", order="Date", out="lags") -> DataFrame:
    """All lags as one array column [lag1, lag2, ...] (nulls kept), one window."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-max_lag, -1)
    hist = F.collect_list(F.struct(F.col(col).alias("v"))).over(w)
    # collect_list drops null structs only, not struct(null): nulls survive.
    lags = F.reverse(F.transform(hist, lambda s: s["v"]))
    pad = F.array_repeat(F.lit(None).cast("double"), F.lit(max_lag) - F.size(hist))
    return df.withColumn(out, F.concat(lags, pad))


def momentum(df: DataFrame, price="Close", k: int = 5, key="Stock", order="Date", out="Momentum") -> DataFrame:
    """Close - lag(Close, k): this repo's definition of the reference's Momentum."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn(out, F.col(price) - F.lag(price, k).over(w))


def sequence_features(df: DataFrame, cols, steps: int = 1, key="Stock", order="Date",
                      out="sequence") -> DataFrame:
    """Sliding (steps x k) feature windows for a recurrent model: array<array<double>>."""
    cols = list(cols)
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(steps - 1), 0)
    rows = F.collect_list(F.array(*[F.col(c).cast("double") for c in cols])).over(w)
    return df.withColumn(out, rows)
