"""Global running totals without a single-partition window.

Rows are dealt to range partitions of their order and written once. Each partition's totals are summed,
cumulated over the partitions (one row for each), and rows add what stands before them inside their own
partition. So a date, a score or a key that holds a third of all rows is split like any other range, and
no split point is fitted on the driver beyond Spark's own sample of range bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import cut_lineage

ROWS = 1_000_000  # of a range partition, about


def with_totals_before(df: DataFrame, order: list[str], sums: dict[str, Column], by: list[str] = (), part_rows: int = ROWS) -> DataFrame:
    """``df`` with, for each name of ``sums``, the total of its column over the rows before this one.

    Rows are ordered by ``order`` within ``by``; rows that tie get one after the other. Each name with ``_all`` is
    the total of all rows of ``by``. A range partition has about ``part_rows`` rows. ``df`` is cut, so it runs once.
    """
    by = list(by)
    df = cut_lineage(df)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // part_rows + 1)
    dealt = df.withColumns({f"__x_{n}": c for n, c in sums.items()}).repartitionByRange(parts, *by, *order)
    dealt = cut_lineage(dealt.withColumn("__part", F.spark_partition_id()))
    totals = dealt.groupBy(*by, "__part").agg(*[F.sum(f"__x_{n}").alias(f"__t_{n}") for n in sums])
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)], F.col("__part").alias("__of_part"),
        *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums],
        *[F.sum(f"__t_{n}").over(Window.partitionBy(*by)).alias(f"{n}_all") for n in sums])
    same = F.col("__part") == F.col("__of_part")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__by{i}"))
    inside = Window.partitionBy(*by, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumns({f"__i_{n}": F.coalesce(F.sum(f"__x_{n}").over(inside), F.lit(0)) for n in sums}).join(offsets, same)
    return out.select(*df.columns, *[(F.col(f"__o_{n}") + F.col(f"__i_{n}")).alias(n) for n in sums], *[f"{n}_all" for n in sums])
