"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col_

# Fixed value: the shape a valid date text must have.
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def days_in_month(d) -> Column:
    """Days in the month of ``d`` (Gregorian leap rule via last_day)."""
    return F.dayofmonth(F.last_day(col_(d)))


def parse_iso_date(c) -> Column:
    """'yyyy-MM-dd' text -> date; invalid text -> null (ANSI-safe)."""
    return F.try_to_date(col_(c), "yyyy-MM-dd")


def parse_compact_date(c) -> Column:
    """yyyyMMdd integer/text -> date; invalid -> null."""
    return F.try_to_date(col_(c).cast("string"), "yyyyMMdd")


def iso_text(c) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd")


def compact_int(c) -> Column:
    return F.date_format(col_(c), "yyyyMMdd").cast("int")


def valid_iso_date(c) -> Column:
    """The shape of ISO_DATE_PATTERN (the reference's validity test) and a date that exists."""
    return col_(c).rlike(ISO_DATE_PATTERN) & parse_iso_date(c).isNotNull()


def in_year(d, year: int) -> Column:
    """Range form of ``year(d) == year``: prunes on Parquet min/max stats."""
    return (col_(d) >= F.lit(f"{year:04d}-01-01").cast("date")) & (
        col_(d) < F.lit(f"{year + 1:04d}-01-01").cast("date")
    )
