"""Min-max normalisation.

Global min/max are attached as scalar subqueries (``DataFrame.scalar()``): the
one-row aggregate is computed once (partial aggregation on every partition)
and inlined as a value. No driver round trip in user code, no single-partition
window, no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import minmax_scale, scale_to, unscale_from


def global_bounds(df: DataFrame, cols) -> dict:
    """{col: (min, max)} as fields of ONE struct-valued scalar subquery, so the
    input is aggregated once however many columns are scaled."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    fields = [F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)] + \
             [F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]
    b = df.select(F.struct(*fields).alias("b")).scalar()
    return {c: (b.getField(f"lo{i}"), b.getField(f"hi{i}")) for i, c in enumerate(cols)}


def minmax_normalize(df: DataFrame, cols, prefix: str = "normalized_", drop: bool = True) -> DataFrame:
    """``prefix+c = (c - min c)/(max c - min c)`` with global min/max; zero range -> null."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    bounds = global_bounds(df, cols)
    out = df.withColumns({f"{prefix}{c}": minmax_scale(c, *bounds[c]) for c in cols})
    return out.drop(*cols) if drop else out


def normalize_column(df: DataFrame, col: str, out: str) -> DataFrame:
    """Keep the original and add ``out`` (the sector-index / date-rank form)."""
    lo, hi = global_bounds(df, [col])[col]
    return df.withColumn(out, minmax_scale(col, lo, hi))


def minmax_per_key(df: DataFrame, cols, key="Stock", suffix: str = "_scaled", fit_on: str | None = None) -> DataFrame:
    """MinMaxScaler semantics per key: range [0, 1], constant column -> 0.5.

    ``fit_on=None`` fits on all rows of the key (the reference's behaviour,
    which leaks test rows into the scaling); ``fit_on="<boolean column>"``
    fits on the rows where it is true (train) and applies to all rows, so
    test values may fall outside [0, 1] as with a fitted scaler.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    w = Window.partitionBy(key)
    out = df
    for c in cols:
        x = F.col(c) if fit_on is None else F.when(F.col(fit_on), F.col(c))
        lo, hi = F.min(x).over(w), F.max(x).over(w)
        out = out.withColumn(
            f"{c}{suffix}",
            F.when(hi == lo, F.lit(0.5)).otherwise((F.col(c) - lo) / (hi - lo)),
        )
    return out


def minmax_range(df: DataFrame, cols, a: float, b: float, suffix: str = "_scaled",
                 bounds: dict | None = None) -> DataFrame:
    """Scale each column into [a, b] with global min/max (sklearn feature_range).

    Pass ``bounds`` from :func:`global_bounds` to share one aggregation between
    several scalings (and their inverse)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    bounds = bounds or global_bounds(df, cols)
    return df.withColumns({f"{c}{suffix}": scale_to(c, *bounds[c], a, b) for c in cols})


def unscale_range(df: DataFrame, col: str, ref_col: str, a: float, b: float, out: str,
                  bounds: dict | None = None) -> DataFrame:
    """Inverse transform of :func:`minmax_range` using ``ref_col``'s min/max."""
    lo, hi = (bounds or global_bounds(df, [ref_col]))[ref_col]
    return df.withColumn(out, unscale_from(col, lo, hi, a, b))
