"""News-event tone: URL dedup, daily statistics, day spine and gap fill
(SURVEY A3, A4, A8, D3, D5, F6, S6).

Scale notes
-----------
* Dedup finds each key's smallest tie-break by a hash aggregate of fixed-width values
  (combined map-side, so a hot URL collapses), then keeps the rows that meet it.
* Daily statistics come from one table of (day, value) counts. The exact median is a
  distributed selection: while some day has more than ``RANKED`` values left, its middle
  ranks are looked for in the next bits of the values' order (counts per prefix,
  combined map-side), and only values under these prefixes stay. No task ranks more.
* The day spine is generated from the data's own min/max: one row per
  calendar day, bounded by the date range. ``daily`` is materialised once for the
  spine, the fill and the days that couldn't be read.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import cut_lineage
from ..functions.calendar import parse_compact_date


def dedup_on(df: DataFrame, keys, tiebreak: str) -> DataFrame:
    """Keep one row per ``keys``: the one with the smallest ``tiebreak`` (an integer; null comes last).

    Deterministic version of ``dropDuplicates(keys)``: of rows that tie, one of the least hash stays.
    The tie-break and the hash of the other columns are one decimal of fixed width, so each key's
    least is a hash aggregate; the rows themselves only meet it in a semi-join.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = F.coalesce(F.col(tiebreak).cast("decimal(19,0)"), F.lit(Decimal(10**19 - 1)))
    digits = F.pmod(F.xxhash64(*rest), F.lit(10**18)).cast("decimal(18,0)")
    rows = df.withColumn("__o", (order * F.lit(Decimal(10**18)) + digits).cast("decimal(38,0)"))
    least = rows.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min("__o").alias("__least"))
    # Equal keys as one condition that is no join key: rows are dealt by the order value alone, which hardly
    # repeats, and rows that are equal throughout lie together for ``distinct``.
    same = F.struct(*keys).eqNullSafe(F.struct(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)]))
    met = rows.join(least, (F.col("__o") == F.col("__least")) & (same | F.lit(None).cast("boolean")), "left_semi")
    return met.distinct().select(*df.columns)


def dedup_url(events: DataFrame, url="SOURCEURL", day="Day", tiebreak="event_id") -> DataFrame:
    """One event per (URL, day) -- the reference dedups one day's file by URL."""
    return dedup_on(events, [url, day], tiebreak)


def country(events: DataFrame, code: str = "US", col="ActionGeo_CountryCode") -> DataFrame:
    return events.where(F.col(col) == F.lit(code))


def ingest_events(events: DataFrame, dedup: bool = True) -> DataFrame:
    """Feed rows -> (Date, Tone, Type, Url), URL-deduplicated per day, any-null rows dropped."""
    base = events.select("event_id", "DATEADDED", "CAMEOCodeDescription", "AvgTone", "SOURCEURL")
    if dedup:
        base = dedup_on(base, ["SOURCEURL", "DATEADDED"], "event_id")
    out = base.select(
        parse_compact_date("DATEADDED").alias("Date"),
        F.col("AvgTone").cast("double").alias("Tone"),
        F.col("CAMEOCodeDescription").alias("Type"),
        F.col("SOURCEURL").alias("Url"),
    )
    return out.na.drop("any")


RANKED = 100_000  # values of a day that a task ranks at most
CUTS = 256  # cuts of a round of the selection


def tone_daily_stats(events: DataFrame, tone="AvgTone", day="Day", count_nulls: bool = False) -> DataFrame:
    """Per day: num, avg_tone, var_tone (sample), std_tone (sample), median_tone (exact).

    ``count_nulls=False`` counts non-null tones (Spark path of the reference);
    ``True`` counts rows, nulls included (its pandas ``len`` path).
    """
    rows = events.select(parse_compact_date(day).alias("Date"), F.col(tone).cast("double").alias("t"))
    # (day, tone) counts: all statistics follow from them, and the input is read once
    values = cut_lineage(rows.groupBy("Date", "t").agg(F.count(F.lit(1)).alias("c")))
    known = F.when(F.col("t").isNotNull(), F.col("c"))
    num = F.coalesce(F.sum("c") if count_nulls else F.sum(known), F.lit(0)).alias("num")
    shift = values.agg(F.percentile_approx("t", 0.5, 100)).scalar()  # near the values, so that the squares keep their digits
    x = F.col("t") - F.col("shift")
    sums = values.withColumn("shift", shift).groupBy("Date").agg(
        num, F.sum(known).alias("n"), F.max("shift").alias("shift"), F.sum(x * F.col("c")).alias("s"), F.sum(x * x * F.col("c")).alias("q"))
    medians = exact_median(values.where("t IS NOT NULL"), "Date", "t", "c")
    mean = F.try_divide(F.col("s"), F.col("n"))
    daily = sums.join(medians.select(F.col("Date").alias("d"), "median"), F.col("Date").eqNullSafe(F.col("d")), "left").select(
        "Date", "num", "n", (F.col("shift") + mean).alias("avg_tone"),
        F.greatest(F.col("q") - F.col("s") * mean, F.lit(0.0)).alias("ss"), F.col("median").alias("median_tone"))
    var = F.when(F.col("n") > 1, F.col("ss") / (F.col("n") - 1))
    return daily.select("Date", "num", "avg_tone", var.alias("var_tone"), F.sqrt(var).alias("std_tone"), "median_tone")


def most_values(values: DataFrame, key: str, value: str) -> int:
    """The largest number of (distinct) values of a key."""
    return values.groupBy(key).agg(F.count(value).alias("d")).agg(F.max("d").alias("d")).collect()[0].d or 0


def middle(value: str) -> Column:
    """The median of a group whose rows cover the ranks from ``start`` to ``end`` of ``n``."""
    at = lambda rank: F.max(F.when((F.col("start") <= rank) & (rank < F.col("end")), F.col(value)))
    return (at(F.floor((F.col("n") - 1) / 2)) + at(F.floor(F.col("n") / 2))) / 2


def exact_median(values: DataFrame, key: str, value: str, count: str) -> DataFrame:
    """(key, median): the exact median of each key from its (value, count) rows, one row for each value.

    While a key has more than RANKED values, a sketch of its values gives CUTS cuts; counts between the cuts
    (combined map-side) tell which one or two intervals hold the middle ranks, and only these go on. The sketch
    is of ranks, so far values don't widen an interval: a round leaves about one value in CUTS.
    """
    left = values.select(F.col(key).alias("k"), F.col(value).alias("v"), F.col(count).alias("c"), F.lit(0).cast("long").alias("before"))
    total = F.sum("c").over(Window.partitionBy("k"))
    if most_values(left, "k", "v") > RANKED:
        counts = values.groupBy(F.col(key).alias("k2")).agg(F.sum(count).alias("n"))
        left = cut_lineage(left.join(counts, F.col("k").eqNullSafe(F.col("k2"))).drop("k2"))
        total = F.col("n")
    while most_values(left, "k", "v") > RANKED:
        shares = [i / CUTS for i in range(1, CUTS)]
        cuts = left.groupBy(F.col("k").alias("k2")).agg(F.percentile_approx("v", shares, 20 * CUTS).alias("cuts"))
        placed = cut_lineage(left.join(cuts, F.col("k").eqNullSafe(F.col("k2"))).select(
            "k", "v", "c", "n", "before", F.size(F.filter("cuts", lambda x: x <= F.col("v"))).alias("b")))
        bins = placed.groupBy("k", "n", "before", "b").agg(F.sum("c").alias("c"))
        upto = F.sum("c").over(Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        bins = bins.withColumn("end", F.col("before") + upto).withColumn("start", F.col("end") - F.col("c"))
        holds = lambda rank: (F.col("start") <= rank) & (rank < F.col("end"))
        middles = bins.where(holds(F.floor((F.col("n") - 1) / 2)) | holds(F.floor(F.col("n") / 2)))
        kept = middles.groupBy(F.col("k").alias("k2")).agg(F.min("start").alias("below"), F.min("b").alias("lo"), F.max("b").alias("hi"))
        left = cut_lineage(placed.join(kept, F.col("k").eqNullSafe(F.col("k2")) & F.col("b").isin(F.col("lo"), F.col("hi"))).select(
            "k", "v", "c", F.col("below").alias("before"), "n"))
    so_far = F.sum("c").over(Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = left.withColumn("n", total).withColumn("end", F.col("before") + so_far).withColumn("start", F.col("end") - F.col("c"))
    return ranked.groupBy(F.col("k").alias(key)).agg(middle("v").alias("median"))


def month_spine(df: DataFrame, date_col="Date") -> DataFrame:
    """Every calendar day of every month between the data's first and last date."""
    bounds = df.agg(
        F.trunc(F.min(date_col), "month").alias("lo"),
        F.last_day(F.max(date_col)).alias("hi"),
    )
    return bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias(date_col)
    )


def months_between_spine(df: DataFrame, date_col="Date", out="month") -> DataFrame:
    """Month spine: every month (yyyyMM int) from the data's first to last month."""
    bounds = df.agg(F.trunc(F.min(date_col), "month").alias("lo"), F.trunc(F.max(date_col), "month").alias("hi"))
    months = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("__m"))
    return months.select(F.date_format("__m", "yyyyMM").cast("int").alias(out),
                         F.dayofmonth(F.last_day("__m")).alias("days_in_month"))


def gap_fill(daily: DataFrame, spine: DataFrame, date_col="Date", fill: float = 0.0) -> DataFrame:
    """Spine LEFT JOIN daily; a day without data becomes a row of zeros. Data whose day couldn't be
    read (a null day) stays as the row it is."""
    vals = [c for c in daily.columns if c != date_col]
    joined = spine.join(daily, date_col, "left")
    filled = joined.select(
        date_col, *[F.coalesce(F.col(c), F.lit(fill).cast(daily.schema[c].dataType)).alias(c) for c in vals]
    )
    return filled.union(daily.where(F.col(date_col).isNull()).select(date_col, *vals))
