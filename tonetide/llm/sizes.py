"""Broadcasts of counted sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counted_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for the build side of a join: with a broadcast hint while it has at most ``rows`` rows.

    Beyond that the join is left to Spark, which sorts, merges and splits hot keys. ``df`` should be cut
    (a checkpoint or a written table), so that counting it costs nothing.
    """
    return F.broadcast(df) if df.count() <= rows else df
