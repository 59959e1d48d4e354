"""Train/test splits and set differences.

* ``chrono_split``: per key, first ``floor(frac*n)`` rows by date are train.
  Window per key over daily rows: at most one row per day per key.
* ``chrono_split_global``: the first ``floor(frac*N)`` rows of the whole
  frame by (date, tie-break), numbered by totals over range partitions
  (:mod:`.ranks`): a date may hold any number of rows.
* ``hash_split``: reproducible pseudo-random split from an md5 of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col_
from .ranks import with_totals_before


def chrono_split(df: DataFrame, key="Stock", order="Date", frac: float = 0.8,
                 out="is_train", index_col: str | None = "idx") -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    idx = F.row_number().over(w)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    res = df.withColumns({"__idx": idx, "__n": n})
    res = res.withColumn(out, F.col("__idx") <= F.floor(F.col("__n") * F.lit(frac)))
    if index_col:
        res = res.withColumnRenamed("__idx", index_col)
    return res.drop("__idx", "__n")


def chrono_split_global(df: DataFrame, order="Date", tiebreak=("Stock",), frac: float = 0.8,
                        out="is_train") -> DataFrame:
    tiebreak = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    numbered = with_totals_before(df, [order, *tiebreak], {"__before": F.lit(1)})
    cut = F.floor(F.col("__before_all") * F.lit(frac))
    return numbered.withColumn(out, F.col("__before") < cut).drop("__before", "__before_all")


def hash_value(key: Column | str) -> Column:
    """The first 24 bits of md5(key)."""
    return F.conv(F.substring(F.md5(col_(key).cast("string")), 1, 6), 16, 10).cast("long")


def hash_split(df: DataFrame, key: Column | str, frac: float = 0.8, out="is_train") -> DataFrame:
    """Reproducible split by a key's hash.

    The hash modulo 100 is the whole percent; the next three bytes of the md5 are its fraction. So a split
    by whole percents looks at the first 24 bits only, and a share a little larger keeps all its rows.
    """
    finer = F.conv(F.substring(F.md5(col_(key).cast("string")), 7, 6), 16, 10).cast("long")
    place = (hash_value(key) % 100) * F.lit(1 << 24) + finer  # of 100 * 2**24
    return df.withColumn(out, place < F.lit(round(frac * 100 * (1 << 24))))


def random_split(df: DataFrame, frac: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Seeded ``randomSplit`` (the reference's split, made reproducible)."""
    train, test = df.randomSplit([frac, 1.0 - frac], seed=seed)
    return train, test


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL EXCEPT (the reference's ``except``): duplicates collapse.

    Both sides are made distinct first, so a heavy duplicate row is combined map-side.
    """
    return a.distinct().subtract(b.select(*a.columns).distinct())


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference: keeps duplicates not matched in ``b``."""
    return a.exceptAll(b)
