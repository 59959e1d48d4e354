"""Event-tone queries (A3, A4, A8, D1-D5, F6, S6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import cut_lineage
from ..functions.calendar import days_in_month
from ..operators import tone
from ..sources import fixtures as fx
from .catalog import query, rounded
from .sqlviews import EVENTS, r4

DEDUP = """
dedup AS (
  SELECT * FROM events_in
  QUALIFY row_number() OVER (PARTITION BY SOURCEURL, Day ORDER BY event_id) = 1)"""


@query("dedup_url", sql=f"""
WITH {EVENTS},{DEDUP}
SELECT event_id, Day, DATEADDED, {r4('AvgTone')} AS AvgTone, CAMEOCodeDescription, SOURCEURL,
       ActionGeo_CountryCode
FROM dedup""")
def q_dedup_url(spark, sf_dir):
    return rounded(tone.dedup_url(fx.events_in(spark, sf_dir)))


@query("tone_source", sql=f"""
WITH {EVENTS},
d AS (SELECT * FROM events_in
      QUALIFY row_number() OVER (PARTITION BY SOURCEURL, DATEADDED ORDER BY event_id) = 1)
SELECT strptime(CAST(DATEADDED AS VARCHAR), '%Y%m%d')::DATE AS Date, {r4('AvgTone')} AS Tone,
       CAMEOCodeDescription AS Type, SOURCEURL AS Url
FROM d
WHERE DATEADDED IS NOT NULL AND AvgTone IS NOT NULL AND CAMEOCodeDescription IS NOT NULL
  AND SOURCEURL IS NOT NULL""")
def q_tone_source(spark, sf_dir):
    return rounded(tone.ingest_events(fx.events_in(spark, sf_dir)))


@query("drop_nulls", sql=f"""
WITH {EVENTS}
SELECT Day, {r4('AvgTone')} AS AvgTone, SOURCEURL
FROM (SELECT Day, CASE WHEN CAMEOCodeDescription = 'error' THEN NULL ELSE AvgTone END AS AvgTone, SOURCEURL
      FROM events_in)
WHERE Day IS NOT NULL AND AvgTone IS NOT NULL AND SOURCEURL IS NOT NULL""")
def q_drop_nulls(spark, sf_dir):
    ev = fx.events_in(spark, sf_dir)
    # error events carry no tone: null it, then drop any-null rows
    ev = ev.select("Day", F.when(F.col("CAMEOCodeDescription") == "error", F.lit(None))
                   .otherwise(F.col("AvgTone")).alias("AvgTone"), "SOURCEURL")
    return rounded(ev.na.drop("any"))


@query("tone_daily_variance", sql=f"""
WITH {EVENTS}
SELECT strptime(CAST(Day AS VARCHAR), '%Y%m%d')::DATE AS Date, count(AvgTone) AS num,
       {r4('avg(AvgTone)')} AS avg_tone, {r4('var_samp(AvgTone)')} AS var_tone,
       {r4('stddev_samp(AvgTone)')} AS std_tone, {r4('median(AvgTone)')} AS median_tone
FROM events_in WHERE ActionGeo_CountryCode = 'US' GROUP BY 1""")
def q_tone_daily_variance(spark, sf_dir):
    ev = tone.country(fx.events_in(spark, sf_dir), "US")
    return rounded(tone.tone_daily_stats(ev))


@query("tone_daily_std", sql=f"""
WITH {EVENTS},
us AS (SELECT * FROM events_in WHERE ActionGeo_CountryCode = 'US'),
dedup AS (SELECT * FROM us QUALIFY row_number() OVER (PARTITION BY SOURCEURL, Day ORDER BY event_id) = 1)
SELECT strptime(CAST(Day AS VARCHAR), '%Y%m%d')::DATE AS Date, count(*) AS num,
       {r4('avg(AvgTone)')} AS avg_tone, {r4('var_samp(AvgTone)')} AS var_tone,
       {r4('stddev_samp(AvgTone)')} AS std_tone, {r4('median(AvgTone)')} AS median_tone
FROM dedup GROUP BY 1""")
def q_tone_daily_std(spark, sf_dir):
    ev = tone.dedup_url(tone.country(fx.events_in(spark, sf_dir), "US"))
    return rounded(tone.tone_daily_stats(ev, count_nulls=True))


TONE_DAILY_FILLED = f"""{EVENTS},
us AS (SELECT * FROM events_in WHERE ActionGeo_CountryCode = 'US'),
dedup AS (SELECT * FROM us QUALIFY row_number() OVER (PARTITION BY SOURCEURL, Day ORDER BY event_id) = 1),
tdaily AS (SELECT strptime(CAST(Day AS VARCHAR), '%Y%m%d')::DATE AS Date, count(*) AS num,
                 avg(AvgTone) AS avg_tone, var_samp(AvgTone) AS var_tone,
                 stddev_samp(AvgTone) AS std_tone, median(AvgTone) AS median_tone
          FROM dedup GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(Date)), last_day(max(Date)),
                                             INTERVAL 1 DAY)) AS DATE) AS Date FROM tdaily),
tg AS (SELECT s.Date, coalesce(num, 0) AS num, coalesce(avg_tone, 0.0) AS avg_tone,
              coalesce(var_tone, 0.0) AS var_tone, coalesce(std_tone, 0.0) AS std_tone,
              coalesce(median_tone, 0.0) AS median_tone
       FROM spine s LEFT JOIN tdaily d ON s.Date = d.Date)"""

TONE_GAPFILL_SQL = f"""
WITH {TONE_DAILY_FILLED}
SELECT Date, num, {r4('avg_tone')} AS avg_tone, {r4('var_tone')} AS var_tone, {r4('std_tone')} AS std_tone,
       {r4('median_tone')} AS median_tone
FROM tg"""


def tone_gapfill_df(spark, sf_dir):
    ev = tone.dedup_url(tone.country(fx.events_in(spark, sf_dir), "US"))
    daily = cut_lineage(tone.tone_daily_stats(ev, count_nulls=True))  # a row for each day: read by the spine and the fill
    return tone.gap_fill(daily, tone.month_spine(daily))


@query("tone_gapfill", sql=TONE_GAPFILL_SQL)
def q_tone_gapfill(spark, sf_dir):
    return rounded(tone_gapfill_df(spark, sf_dir))


@query("date_spine", sql=f"""
WITH {EVENTS},
d AS (SELECT strptime(CAST(Day AS VARCHAR), '%Y%m%d')::DATE AS Date FROM events_in),
spine AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(Date)), last_day(max(Date)),
                                             INTERVAL 1 DAY)) AS DATE) AS Date FROM d)
SELECT Date, strftime(Date, '%Y-%m-%d') AS date_text, CAST(dayofmonth(last_day(Date)) AS INTEGER) AS days_in_month
FROM spine""")
def q_date_spine(spark, sf_dir):
    ev = fx.events_in(spark, sf_dir).select(F.to_date(F.col("Day").cast("string"), "yyyyMMdd").alias("Date"))
    sp = tone.month_spine(ev)
    return sp.select("Date", F.date_format("Date", "yyyy-MM-dd").alias("date_text"),
                     days_in_month("Date").alias("days_in_month"))


@query("month_spine", sql="""
WITH b AS (SELECT date_trunc('month', min(l_shipdate)) AS lo, date_trunc('month', max(l_shipdate)) AS hi FROM lineitem),
m AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS mo FROM b)
SELECT CAST(strftime(mo, '%Y%m') AS INTEGER) AS month, CAST(dayofmonth(last_day(CAST(mo AS DATE))) AS INTEGER) AS days_in_month
FROM m""")
def q_month_spine(spark, sf_dir):
    """Every month between the first and last ship date, with its length."""
    li = fx.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("Date"))
    return tone.months_between_spine(li)


@query("days_in_month", sql="""
WITH m AS (SELECT DISTINCT year(l_shipdate) AS y, month(l_shipdate) AS m FROM lineitem)
SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month,
       CAST(CASE WHEN m IN (4, 6, 9, 11) THEN 30
                 WHEN m = 2 THEN CASE WHEN (y % 4 = 0 AND y % 100 <> 0) OR y % 400 = 0 THEN 29 ELSE 28 END
                 ELSE 31 END AS INTEGER) AS days
FROM m""")
def q_days_in_month(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    m = li.select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).distinct()
    return m.select("year", "month", days_in_month(F.make_date("year", "month", F.lit(1))).alias("days"))
