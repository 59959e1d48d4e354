"""Scalar column expressions. All JVM-side, codegen friendly."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Per-attribute weights of the bar scaling step (Volume is
# scaled by 1e-7 before rounding and summing).
BAR_WEIGHTS = {"Open": 1.0, "High": 1.0, "Low": 1.0, "Close": 1.0, "Volume": 0.0000001}


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_round(c, digits: int = 4, scale: int = 8, precision: int = 28) -> Column:
    """Round a double through a decimal so engines agree bit for bit.

    Plain ``round(double)`` can differ by an ulp between engines and flip on
    ties; going through ``decimal(28,8)`` first removes that noise.
    """
    return F.round(col_(c).cast(f"decimal({precision},{scale})"), digits).cast("double")


def bar_round(c, digits: int = 2) -> Column:
    """HALF_EVEN rounding of a bar attribute to cents (``bround``).

    ``format_number(x, 2)`` cast back to double rounds half-even but inserts
    thousands separators (null/raise above 1,000); ``bround`` keeps the
    rounding rule without that defect.
    """
    return F.bround(col_(c), digits)


def weighted(c: str, weight: float) -> Column:
    return (F.col(c) * F.lit(weight)).cast("double")


def custom_metric(cols=("Open", "High", "Low", "Close", "Volume"), digits: int = 2) -> Column:
    """Sum of the (already weighted) bar attributes, rounded HALF_UP."""
    return F.round(reduce(add, [F.col(c) for c in cols]), digits)


def row_vwap(price="Close", volume="Volume") -> Column:
    """(price*volume)/volume; null (not an error) when volume is 0."""
    return F.try_divide(col_(price) * col_(volume), col_(volume))


def average_price(o="Open", h="High", l="Low", c="Close") -> Column:
    return (col_(o) + col_(h) + col_(l) + col_(c)) / F.lit(4.0)


def positive_bit(c) -> Column:
    """(x > 0) as 0/1 integer; null stays null."""
    return (col_(c) > F.lit(0)).cast("int")


def open_close_diff(o="Open", c="Close") -> Column:
    return col_(o) - col_(c)


def close_open(o="Open", c="Close") -> Column:
    return col_(c) - col_(o)


def minmax_scale(x, lo, hi) -> Column:
    """(x - lo) / (hi - lo); null when the range is 0."""
    return F.try_divide(col_(x) - col_(lo), col_(hi) - col_(lo))


def scale_to(x, lo, hi, a: float, b: float) -> Column:
    """Min-max scale into [a, b] (sklearn ``feature_range``); constant column -> a."""
    span = col_(hi) - col_(lo)
    unit = F.when(span == 0, F.lit(0.0)).otherwise((col_(x) - col_(lo)) / span)
    return unit * F.lit(b - a) + F.lit(a)


def unscale_from(y, lo, hi, a: float, b: float) -> Column:
    """Inverse of :func:`scale_to`."""
    return (col_(y) - F.lit(a)) / F.lit(b - a) * (col_(hi) - col_(lo)) + col_(lo)


def sig_round(c, sig: int = 9) -> Column:
    """Round to ``sig`` significant digits, identically in any IEEE engine.

    Scales by an exact power of ten (10^n is exact for 0 <= n <= 22), rounds
    the scaled value through a decimal and scales back with one correctly
    rounded multiplication or division.
    """
    x = col_(c)
    e = F.floor(F.log10(F.abs(x)))
    n = F.lit(sig - 1) - e
    scaled = F.when(n >= 0, x * F.pow(F.lit(10.0), n)).otherwise(x / F.pow(F.lit(10.0), -n))
    k = F.round(scaled.cast("decimal(38,4)"), 0).cast("double")
    res = F.when(n >= 0, k / F.pow(F.lit(10.0), n)).otherwise(k * F.pow(F.lit(10.0), -n))
    return F.when((x == 0) | x.isNull() | F.isnan(x), x).otherwise(res)
