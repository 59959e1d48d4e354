"""Schema conformance and summary statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing columns become typed nulls, present ones are cast; declared order."""
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        c = F.col(f"`{src}`").cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def union_all_by_name(frames) -> DataFrame:
    """Fold ``unionByName(allowMissingColumns=True)`` over a list of frames."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def summary_long(df: DataFrame, cols) -> DataFrame:
    """count/mean/stddev/min/max per column in one aggregation pass, long format.

    Numeric counterpart of ``describe()`` (which returns strings).
    """
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.expr(f"try_cast(`{c}` AS double)")  # text that is no number counts as null
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = ", ".join(
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`" for c in cols
    )
    return wide.selectExpr(
        f"stack({len(cols)}, {rows}) AS (column, count, mean, stddev, min, max)"
    )


def summary_text(df: DataFrame, cols) -> DataFrame:
    """count/min/max per column as text in one pass: ``describe()`` of columns that aren't numbers."""
    cols = list(cols)
    wide = df.agg(*[f(F.col(c).cast("string")).alias(f"{c}__{n}") for c in cols
                    for n, f in (("count", F.count), ("min", F.min), ("max", F.max))])
    rows = ", ".join(f"'{c}', `{c}__count`, `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {rows}) AS (column, count, min, max)")
