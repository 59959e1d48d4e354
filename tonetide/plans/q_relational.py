"""Joins, filters, splits, set operations, scaling, lags, sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schemas
from ..config import cut_lineage, scratch_path
from ..functions.calendar import in_year, iso_text, parse_iso_date
from ..operators import market, normalize, profile, signal, split
from ..sources import files, fixtures as fx
from . import flows
from .catalog import query, rounded
from .q_market import sector_signal_df
from .q_text import DAILY_SQL
from .q_tone import TONE_DAILY_FILLED
from .sqlviews import BARS, EVENTS, NEWS, r4

SENT_PRICE_SQL = f"""{BARS},{DAILY_SQL},
px AS (SELECT Date AS date, lower(Category) AS category, avg(Open) AS Open, avg(Close) AS Close
       FROM bars GROUP BY 1, 2),
sp AS (SELECT CAST(d.date AS DATE) AS date, d.avg_sentiment, d.avg_subjectivity, p.Open, p.Close,
              p.Open - p.Close AS open_close_diff
       FROM daily d JOIN px p ON CAST(d.date AS DATE) = p.date AND d.category = p.category
       WHERE CAST(d.date AS DATE) >= DATE '1998-01-01' AND CAST(d.date AS DATE) < DATE '1999-01-01'
         AND (d.avg_sentiment <> 0 OR d.avg_subjectivity <> 0))"""

STOCK_FEATURES_SQL = f"""{BARS},{DAILY_SQL},
sf AS (SELECT b.Date, b.Stock, b.Category,
              coalesce(CAST(d.articles_count AS DOUBLE), 0.0) AS avg_articles_count,
              coalesce(d.avg_subjectivity, 0.0) AS avg_subjectivity,
              b.Close - lag(b.Close, 5) OVER (PARTITION BY b.Stock ORDER BY b.Date) AS Momentum,
              b.Close - b.Open AS "Close-Open"
       FROM bars b LEFT JOIN daily d ON CAST(d.date AS DATE) = b.Date AND d.category = lower(b.Category))"""

BUYSELL_IN_SQL = f"""{BARS},{DAILY_SQL},
idx AS (SELECT Date, Category, avg(VWAP) AS sectorIndex FROM bars GROUP BY 1, 2),
sig AS (SELECT *, CAST(CAST(lead(sectorIndex) OVER (PARTITION BY Category ORDER BY Date) - sectorIndex > 0 AS INTEGER) AS DOUBLE) AS buySell FROM idx),
bi AS (SELECT s.Date, s.Category, coalesce(d.avg_sentiment, 0.0) AS avg_sentiment,
              coalesce(d.avg_subjectivity, 0.0) AS avg_subjectivity,
              coalesce(CAST(d.articles_count AS DOUBLE), 0.0) AS avg_articles_count, s.buySell
       FROM sig s LEFT JOIN daily d ON CAST(d.date AS DATE) = s.Date AND d.category = lower(s.Category))"""


def _cols(*names):
    return ", ".join(f'{r4(chr(34) + n + chr(34))} AS "{n}"' for n in names)


@query("join_sentiment_price", sql=f"""
WITH {SENT_PRICE_SQL}
SELECT date, {_cols('avg_sentiment', 'avg_subjectivity', 'Open', 'Close', 'open_close_diff')} FROM sp""")
def q_join_sentiment_price(spark, sf_dir):
    return rounded(flows.sentiment_price(spark, sf_dir))


@query("filter_year", sql=f"""
WITH {BARS}
SELECT Date, Stock, Category, {r4('Close')} AS Close FROM bars
WHERE Date >= DATE '1998-01-01' AND Date < DATE '1999-01-01'""")
def q_filter_year(spark, sf_dir):
    b = fx.bars(spark, sf_dir).where(in_year("Date", 1998))
    return rounded(b.select("Date", "Stock", "Category", "Close"))


@query("filter_nonzero", sql=f"""
WITH {DAILY_SQL}
SELECT date, category, {r4('avg_sentiment')} AS avg_sentiment, {r4('avg_subjectivity')} AS avg_subjectivity
FROM daily WHERE avg_sentiment <> 0 OR avg_subjectivity <> 0""")
def q_filter_nonzero(spark, sf_dir):
    d = flows.daily_sentiment(spark, sf_dir)
    d = d.where((F.col("avg_sentiment") != 0) | (F.col("avg_subjectivity") != 0))
    return rounded(d.select("date", "category", "avg_sentiment", "avg_subjectivity"))


THREE_WAY_SQL = f"""{BARS},{DAILY_SQL},{TONE_DAILY_FILLED},
tn AS (SELECT Date AS date, num,
              (avg_tone - (SELECT min(avg_tone) FROM tg)) / ((SELECT max(avg_tone) FROM tg) - (SELECT min(avg_tone) FROM tg)) AS normalized_avg_tone,
              (std_tone - (SELECT min(std_tone) FROM tg)) / ((SELECT max(std_tone) FROM tg) - (SELECT min(std_tone) FROM tg)) AS normalized_std_tone,
              (median_tone - (SELECT min(median_tone) FROM tg)) / ((SELECT max(median_tone) FROM tg) - (SELECT min(median_tone) FROM tg)) AS normalized_median_tone
       FROM tg),
sec AS (SELECT Date, Category, avg(VWAP) AS v FROM bars GROUP BY 1, 2),
secn AS (SELECT Date AS date, lower(Category) AS category,
                (v - (SELECT min(v) FROM sec)) / ((SELECT max(v) FROM sec) - (SELECT min(v) FROM sec)) AS Normalized_Sector_VWAP
         FROM sec),
tw AS (SELECT CAST(d.date AS DATE) AS date, d.category, d.avg_sentiment, d.avg_subjectivity, d.articles_count, tn.num,
              normalized_avg_tone, normalized_std_tone, normalized_median_tone, Normalized_Sector_VWAP
       FROM daily d JOIN tn ON CAST(d.date AS DATE) = tn.date
       JOIN secn s ON CAST(d.date AS DATE) = s.date AND d.category = s.category)"""


@query("join_three_way", sql=f"""
WITH {THREE_WAY_SQL}
SELECT date, category, articles_count, num, {", ".join(f"{r4(c)} AS {c}" for c in (
    'avg_sentiment', 'avg_subjectivity', 'normalized_avg_tone', 'normalized_std_tone', 'normalized_median_tone',
    'Normalized_Sector_VWAP'))}
FROM tw""")
def q_join_three_way(spark, sf_dir):
    return rounded(flows.three_way(spark, sf_dir))


@query("distinct_keys", sql=f"WITH {BARS} SELECT DISTINCT Stock FROM bars")
def q_distinct_keys(spark, sf_dir):
    return fx.stocks(spark, sf_dir)


@query("union_by_name", sql=f"""
WITH {BARS},
a AS (SELECT Date, Stock, Category, Open, Close, Volume, CAST(NULL AS DOUBLE) AS VWAP, CAST(NULL AS BIGINT) AS n_ticks FROM bars),
t AS (SELECT CAST(l_shipdate AS DATE) AS Date, l_suppkey AS Stock, c.Category,
             sum(l_extendedprice * l_quantity) / sum(l_quantity) AS VWAP, sum(l_quantity) AS Volume, count(*) AS n_ticks
      FROM lineitem LEFT JOIN cat c ON l_suppkey = c.Stock GROUP BY 1, 2, 3),
u AS (SELECT * FROM a UNION ALL
      SELECT Date, Stock, Category, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), Volume, VWAP, n_ticks FROM t)
SELECT Date, Stock, Category, {r4('Open')} AS Open, {r4('Close')} AS Close, {r4('Volume')} AS Volume,
       {r4('VWAP')} AS VWAP, n_ticks FROM u""")
def q_union_by_name(spark, sf_dir):
    a = fx.bars(spark, sf_dir).select("Date", "Stock", "Category", "Open", "Close", "Volume")
    t = market.vwap_by_stock_day(fx.ticks(spark, sf_dir))
    return rounded(profile.union_all_by_name([a, t]))


@query("conform_schema", sql=f"""
WITH {BARS}
SELECT Date, {r4('Open')} AS Open, {r4('High')} AS High, {r4('Low')} AS Low, {r4('Close')} AS Close,
       {r4('Volume')} AS Volume, CAST(Stock AS VARCHAR) AS Stock, Category, CAST(NULL AS DOUBLE) AS Dividends
FROM bars""")
def q_conform_schema(spark, sf_dir):
    return rounded(profile.conform(fx.bars(spark, sf_dir), schemas.BAR_FACTORS))


@query("describe_bars", sql=f"""
WITH {BARS}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {r4(f'avg({c})')} AS mean, {r4(f'stddev_samp({c})')} AS stddev, "
    f"{r4(f'min({c})')} AS min, {r4(f'max({c})')} AS max FROM bars"
    for c in ("Open", "High", "Low", "Close", "Volume", "VWAP")))
def q_describe_bars(spark, sf_dir):
    return rounded(profile.summary_long(fx.bars(spark, sf_dir), ["Open", "High", "Low", "Close", "Volume", "VWAP"]))


@query("chrono_split", sql=f"""
WITH {STOCK_FEATURES_SQL}
SELECT Date, Stock, CAST(row_number() OVER (PARTITION BY Stock ORDER BY Date) AS INTEGER) AS idx,
       row_number() OVER (PARTITION BY Stock ORDER BY Date) <= floor(count(*) OVER (PARTITION BY Stock) * 0.8) AS is_train
FROM sf""")
def q_chrono_split(spark, sf_dir):
    s = split.chrono_split(fx.stock_days(spark, sf_dir), "Stock", "Date", 0.8)
    return s.select("Date", "Stock", "idx", "is_train")


@query("chrono_split_global", sql=f"""
WITH {BUYSELL_IN_SQL}
SELECT Date, Category, row_number() OVER (ORDER BY Date, Category) <= floor((SELECT count(*) FROM bi) * 0.8) AS is_train
FROM bi""")
def q_chrono_split_global(spark, sf_dir):
    s = split.chrono_split_global(flows.buysell_in(spark, sf_dir), "Date", ("Category",), 0.8)
    return s.select("Date", "Category", "is_train")


@query("hash_split", sql=f"""
WITH {BARS}
SELECT Date, Stock,
       CAST(('0x' || substr(md5(CAST(Stock AS VARCHAR) || '|' || strftime(Date, '%Y-%m-%d')), 1, 6)) AS BIGINT) % 100 < 80 AS is_train
FROM bars""")
def q_hash_split(spark, sf_dir):
    b = fx.stock_days(spark, sf_dir)
    key = F.concat_ws("|", F.col("Stock").cast("string"), iso_text("Date"))
    return split.hash_split(b, key, 0.8).select("Date", "Stock", "is_train")


_EXC_BASE = f"""{BUYSELL_IN_SQL},
allr AS (SELECT Category, CAST(year(Date) AS INTEGER) AS yr FROM bi),
ranked AS (SELECT Category, CAST(year(Date) AS INTEGER) AS yr,
                  row_number() OVER (ORDER BY Date, Category) <= floor((SELECT count(*) FROM bi) * 0.8) AS is_train
           FROM bi),
train AS (SELECT Category, yr FROM ranked WHERE is_train)"""


def _exc_frames(spark, sf_dir):
    s = cut_lineage(split.chrono_split_global(flows.buysell_in(spark, sf_dir), "Date", ("Category",), 0.8))
    allr = s.select("Category", F.year("Date").alias("yr"))
    train = s.where("is_train").select("Category", F.year("Date").alias("yr"))
    return allr, train


@query("except_distinct", sql=f"WITH {_EXC_BASE} SELECT * FROM allr EXCEPT SELECT * FROM train")
def q_except_distinct(spark, sf_dir):
    a, t = _exc_frames(spark, sf_dir)
    return split.except_distinct(a, t)


@query("except_all", sql=f"WITH {_EXC_BASE} SELECT * FROM allr EXCEPT ALL SELECT * FROM train")
def q_except_all(spark, sf_dir):
    a, t = _exc_frames(spark, sf_dir)
    return split.except_all(a, t)


LAGS = (1, 2, 3, 30, 60, 90, 120)  # of the 120 that are made


@query("lag_features", sql=f"""
WITH {STOCK_FEATURES_SQL}
SELECT Date, Stock, {r4('"Close-Open"')} AS "Close-Open",
       {", ".join(f'{r4(f'lag("Close-Open", {i}) OVER (PARTITION BY Stock ORDER BY Date)')} AS "Close-Open_Lag_{i}"' for i in LAGS)}
FROM sf""")
def q_lag_features(spark, sf_dir):
    s = signal.lag_features(flows.stock_features(spark, sf_dir), "Close-Open", 120)
    return rounded(s.select("Date", "Stock", "Close-Open", *[f"Close-Open_Lag_{i}" for i in LAGS]))


@query("stock_features", sql=f"""
WITH {STOCK_FEATURES_SQL}
SELECT Date, Stock, Category, {_cols('avg_articles_count', 'avg_subjectivity', 'Momentum', 'Close-Open')} FROM sf""")
def q_stock_features(spark, sf_dir):
    return rounded(flows.stock_features(spark, sf_dir))


@query("minmax_per_stock", sql=f"""
WITH {STOCK_FEATURES_SQL}
SELECT Date, Stock, """ + ", ".join(
    f"""{r4(f'CASE WHEN max("{c}") OVER w = min("{c}") OVER w THEN 0.5 ELSE ("{c}" - min("{c}") OVER w) / (max("{c}") OVER w - min("{c}") OVER w) END')} AS "{c}_scaled\""""
    for c in ("avg_articles_count", "avg_subjectivity", "Momentum")) + """
FROM sf WINDOW w AS (PARTITION BY Stock)""")
def q_minmax_per_stock(spark, sf_dir):
    cols = ["avg_articles_count", "avg_subjectivity", "Momentum"]
    s = normalize.minmax_per_key(flows.stock_features(spark, sf_dir), cols, "Stock")
    return rounded(s.select("Date", "Stock", *[f"{c}_scaled" for c in cols]))


@query("minmax_range", sql=f"""
WITH {SENT_PRICE_SQL},
st AS (SELECT min(avg_sentiment) a0, max(avg_sentiment) a1, min(avg_subjectivity) b0, max(avg_subjectivity) b1,
              min(open_close_diff) y0, max(open_close_diff) y1 FROM sp),
sc AS (SELECT sp.date,
              CASE WHEN a1 = a0 THEN 0.0 ELSE (avg_sentiment - a0) / (a1 - a0) END * 2.0 - 1.0 AS avg_sentiment_scaled,
              CASE WHEN b1 = b0 THEN 0.0 ELSE (avg_subjectivity - b0) / (b1 - b0) END * 2.0 - 1.0 AS avg_subjectivity_scaled,
              CASE WHEN y1 = y0 THEN 0.0 ELSE (open_close_diff - y0) / (y1 - y0) END * 100.0 AS open_close_diff_scaled,
              y0, y1
       FROM sp, st)
SELECT date, {r4('avg_sentiment_scaled')} AS avg_sentiment_scaled, {r4('avg_subjectivity_scaled')} AS avg_subjectivity_scaled,
       {r4('open_close_diff_scaled')} AS open_close_diff_scaled,
       {r4('(open_close_diff_scaled - 0.0) / 100.0 * (y1 - y0) + y0')} AS open_close_diff_restored
FROM sc""")
def q_minmax_range(spark, sf_dir):
    sp = flows.sentiment_price(spark, sf_dir)
    bounds = normalize.global_bounds(sp, ["avg_sentiment", "avg_subjectivity", "open_close_diff"])
    s = normalize.minmax_range(sp, ["avg_sentiment", "avg_subjectivity"], -1.0, 1.0, bounds=bounds)
    s = normalize.minmax_range(s, ["open_close_diff"], 0.0, 100.0, bounds=bounds)
    s = normalize.unscale_range(s, "open_close_diff_scaled", "open_close_diff", 0.0, 100.0,
                                "open_close_diff_restored", bounds=bounds)
    return rounded(s.select("date", "avg_sentiment_scaled", "avg_subjectivity_scaled",
                            "open_close_diff_scaled", "open_close_diff_restored"))


@query("sequence_features", sql=f"""
WITH {SENT_PRICE_SQL.replace("SELECT CAST(d.date AS DATE) AS date, d.avg_sentiment", "SELECT CAST(d.date AS DATE) AS date, d.category, d.avg_sentiment")}
SELECT date, category,
       list([{r4('avg_sentiment')}, {r4('avg_subjectivity')}, {r4('Open')}, {r4('Close')}])
         OVER (PARTITION BY category ORDER BY date ROWS BETWEEN CURRENT ROW AND CURRENT ROW) AS sequence
FROM sp""")
def q_sequence_features(spark, sf_dir):
    """(steps x k) feature windows per sector series; steps = 1 as in the reference."""
    sp = rounded(flows.sentiment_price(spark, sf_dir, keep_category=True))
    s = signal.sequence_features(sp, ["avg_sentiment", "avg_subjectivity", "Open", "Close"], steps=1,
                                 key="category", order="date")
    return s.select("date", "category", "sequence")


@query("parse_dates", sql=f"""
WITH {NEWS}
SELECT doc_id, date, try_strptime(date, '%Y-%m-%d')::DATE AS parsed,
       strftime(try_strptime(date, '%Y-%m-%d')::DATE, '%Y-%m-%d') AS formatted
FROM news""")
def q_parse_dates(spark, sf_dir):
    n = fx.news(spark, sf_dir)
    return n.select("doc_id", "date", parse_iso_date("date").alias("parsed"),
                    iso_text(parse_iso_date("date")).alias("formatted"))


# ---- sources and sinks: write to the shared folder, read back -------------

SIGNAL_SQL = f"""
WITH {BARS},
sec AS (SELECT Date, Category, avg(VWAP) AS Sector_VWAP FROM bars GROUP BY 1, 2)
SELECT Date, Category, {r4('Sector_VWAP')} AS Sector_VWAP,
       {r4('avg(Sector_VWAP) OVER (PARTITION BY Category ORDER BY Date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)')} AS MovingAvg_VWAP,
       CAST(lead(Sector_VWAP) OVER (PARTITION BY Category ORDER BY Date) - Sector_VWAP > 0 AS INTEGER) AS BuySell
FROM sec"""


@query("sink_csv", sql=SIGNAL_SQL)
def q_sink_csv(spark, sf_dir):
    path = scratch_path(spark, "sector_signal_csv")
    files.write_csv(rounded(sector_signal_df(spark, sf_dir)), path)
    return files.read_csv(spark, path, schemas.SECTOR_SIGNAL)


@query("scan_csv_roundtrip", sql=f"""
WITH {BARS}
SELECT Date, Stock, Category, {r4('Open')} AS Open, {r4('High')} AS High, {r4('Low')} AS Low,
       {r4('Close')} AS Close, {r4('Volume')} AS Volume, {r4('VWAP')} AS VWAP
FROM bars""")
def q_scan_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bars_csv")
    files.write_csv(rounded(fx.bars(spark, sf_dir)), path)
    return files.read_csv(spark, path, schemas.BARS)


@query("scan_csv_infer", sql=SIGNAL_SQL)
def q_scan_csv_infer(spark, sf_dir):
    path = scratch_path(spark, "signal_csv_infer")
    files.write_csv(rounded(sector_signal_df(spark, sf_dir)), path)
    df = files.read_csv(spark, path, infer=True)
    return df.select(F.col("Date").cast("date").alias("Date"), "Category",
                     F.col("Sector_VWAP").cast("double").alias("Sector_VWAP"),
                     F.col("MovingAvg_VWAP").cast("double").alias("MovingAvg_VWAP"),
                     F.col("BuySell").cast("int").alias("BuySell"))


@query("scan_csv_strings", sql=f"""
WITH {EVENTS}
SELECT event_id, Day, {r4('AvgTone')} AS AvgTone, SOURCEURL FROM events_in""")
def q_scan_csv_strings(spark, sf_dir):
    path = scratch_path(spark, "events_csv")
    ev = rounded(fx.events_in(spark, sf_dir).select("event_id", "Day", "AvgTone", "SOURCEURL"))
    files.write_csv(ev, path)
    return files.read_csv_strings(spark, path, {"event_id": "bigint", "Day": "int", "AvgTone": "double"})


@query("scan_csv_multiline", sql=f"WITH {NEWS} SELECT doc_id, category, headline, short_description FROM news")
def q_scan_csv_multiline(spark, sf_dir):
    path = scratch_path(spark, "news_csv")
    n = fx.news(spark, sf_dir).select("doc_id", "category", "headline", "short_description")
    files.write_csv(n, path)
    schema = schemas.NEWS
    from pyspark.sql import types as T
    sch = T.StructType([schema["doc_id"], schema["category"], schema["headline"], schema["short_description"]])
    return files.read_csv(spark, path, sch, multiline=True, escape='"', empty_is_null=False)


@query("scan_rejects", sql=f"""
WITH {EVENTS}
SELECT event_id, CASE WHEN CAMEOCodeDescription = 'error' THEN 'reject' ELSE 'good' END AS status,
       CASE WHEN CAMEOCodeDescription = 'error' THEN NULL ELSE {r4('AvgTone')} END AS AvgTone
FROM events_in""")
def q_scan_rejects(spark, sf_dir):
    path = scratch_path(spark, "events_bad_csv")
    ev = rounded(fx.events_in(spark, sf_dir))
    # error events are landed with a non-numeric tone: they must come back as rejects
    tone_txt = F.when(F.col("CAMEOCodeDescription") == "error", F.lit("n/a")).otherwise(F.col("AvgTone").cast("string"))
    lines = ev.select(F.concat_ws(",", F.col("event_id").cast("string"), F.col("Day").cast("string"),
                                  tone_txt, F.col("SOURCEURL")).alias("value"))
    lines.write.mode("overwrite").text(path)
    df = files.read_csv(spark, path, schemas.EVENTS_RAW, header=False, keep_rejects=True)
    return df.select("event_id",
                     F.when(F.col(files.CORRUPT).isNotNull(), F.lit("reject")).otherwise(F.lit("good")).alias("status"),
                     "AvgTone")


def write_bytes(spark, path: str, data: bytes) -> None:
    """One small file in the shared folder, written by the driver."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()


@query("load_ledger", sql=f"""
WITH {EVENTS},
s AS (SELECT CAMEOCodeDescription AS source, count(*) AS n,
             count(*) FILTER (CAMEOCodeDescription = 'error' AND event_id % 2 = 1) AS bad FROM events_in GROUP BY 1)
SELECT source, CASE WHEN bad = 0 THEN 'loaded' WHEN bad < n THEN 'partial' ELSE 'rejected' END AS outcome,
       CASE WHEN bad > 0 THEN bad || ' of ' || n || ' records don''t fit the schema' END AS reason, n - bad AS good_rows, bad AS rejected_rows FROM s
UNION ALL SELECT 'all_bad', 'rejected', count(*) || ' of ' || count(*) || ' records don''t fit the schema', 0, count(*)
          FROM events_in WHERE CAMEOCodeDescription = 'error'
UNION ALL SELECT * FROM (VALUES ('broken', 'unreadable', '1 of 1 files can''t be read', 0, 0), ('nothing', 'empty', 'no records', 0, 0),
                                ('title_only', 'empty', 'no records', 0, 0))""")
def q_load_ledger(spark, sf_dir):
    """Each event type is a source: odd error events are landed broken; one source is no gzip, two hold no record."""
    path = scratch_path(spark, "ledger")
    ev = fx.events_in(spark, sf_dir)
    error = F.col("CAMEOCodeDescription") == "error"
    value = F.when(error & (F.col("event_id") % 2 == 1), "n/a").otherwise(F.round("AvgTone", 4).cast("string"))

    def line(tone):
        return F.concat_ws(",", F.col("event_id").cast("string"), F.col("Day").cast("string"), tone, F.col("SOURCEURL")).alias("value")

    ev.select(line(value), F.col("CAMEOCodeDescription").alias("source")).write.partitionBy("source").text(path)
    ev.where(error).select(line(F.lit("n/a"))).write.text(f"{path}/source=all_bad")
    write_bytes(spark, f"{path}/source=broken/part-0.txt.gz", b"no gzip at all")
    write_bytes(spark, f"{path}/source=nothing/part-0.txt", b"")
    write_bytes(spark, f"{path}/source=title_only/part-0.txt", b"event_id,Day,AvgTone,SOURCEURL\n")
    ledger = files.load_ledger(spark, path, schemas.EVENTS_RAW, header=True, source=lambda c: F.regexp_extract(c, "source=([^/]*)/", 1))
    return ledger.drop("files")  # how many files a source was written in depends on the cluster


@query("sink_refuses", sql=f"""
WITH {BARS}
SELECT 'first' AS attempt, 'written' AS outcome, count(*) AS rows_there, {r4('sum(Close) / count(*)')} AS avg_close FROM bars
UNION ALL SELECT 'second', 'refused', count(*), {r4('sum(Close) / count(*)')} FROM bars""")
def q_sink_refuses(spark, sf_dir):
    """An export that refuses to overwrite: the second attempt fails and what was there stays."""
    path = scratch_path(spark, "refusing_csv")
    bars = rounded(fx.bars(spark, sf_dir)).select("Date", "Stock", "Close")
    seen = []
    for attempt, rows in (("first", bars), ("second", bars.where("Close > 1000"))):
        try:
            files.write_csv(rows, path, mode="errorifexists", order_by=["Date", "Stock"])
            outcome = "written"
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            outcome = "refused"
        there = files.read_csv(spark, path, "Date date, Stock long, Close double")
        seen.append(there.agg(F.count(F.lit(1)).alias("rows_there"), F.avg("Close").alias("avg_close"))
                    .select(F.lit(attempt).alias("attempt"), F.lit(outcome).alias("outcome"), "rows_there", "avg_close"))
    return rounded(seen[0].unionByName(seen[1]))


@query("sink_csv_single", sql=SIGNAL_SQL)
def q_sink_csv_single(spark, sf_dir):
    """A small export as one file (an explicit choice): the daily sector signal."""
    path = scratch_path(spark, "signal_single_csv")
    files.write_csv(rounded(sector_signal_df(spark, sf_dir)), path, single_file=True)
    if files.listed_files(spark, f"{path}/*.csv").count() != 1:
        raise ValueError(f"{path} is not one file")
    return files.read_csv(spark, path, schemas.SECTOR_SIGNAL)


@query("sink_parquet", sql=f"""
WITH {EVENTS},
d AS (SELECT * FROM events_in
      QUALIFY row_number() OVER (PARTITION BY SOURCEURL, DATEADDED ORDER BY event_id) = 1)
SELECT {r4('AvgTone')} AS Tone, CAMEOCodeDescription AS Type, SOURCEURL AS Url,
       strptime(CAST(DATEADDED AS VARCHAR), '%Y%m%d')::DATE AS Date
FROM d""")
def q_sink_parquet(spark, sf_dir):
    from ..operators import tone

    path = scratch_path(spark, "tone_parquet")
    files.write_parquet(rounded(tone.ingest_events(fx.events_in(spark, sf_dir))), path, partition_by="Date")
    return files.read_parquet(spark, path, schemas.TONE)


@query("landed_bars", sql=f"""
WITH {BARS}
SELECT Date, {r4('Open')} AS Open, {r4('High')} AS High, {r4('Low')} AS Low, {r4('Close')} AS Close,
       {r4('Volume')} AS Volume, CAST(Stock AS VARCHAR) AS Stock, Category
FROM bars WHERE Date >= DATE '1995-01-01' AND Date < DATE '2002-01-01'""")
def q_landed_bars(spark, sf_dir):
    """Bars landed by month (clustered by stock) with provider-only columns, read back in one scan."""
    from ..sources import landed

    path = scratch_path(spark, "landed_bars")
    b = rounded(fx.bars(spark, sf_dir)).drop("VWAP", "Category")
    b = b.withColumns({"Dividends": F.lit(0.0), "Stock Splits": F.lit(0.0)})
    landed.land_bars(b.withColumn("Stock", F.col("Stock").cast("string")), path)
    dim = fx.category_dim(spark, sf_dir).select(F.col("Stock").cast("string").alias("Stock"), "Category")
    return landed.read_landed_bars(spark, path, "1995-01-01", "2002-01-01", dim)


@query("landed_events", sql=f"""
WITH {EVENTS}
SELECT event_id, {r4('AvgTone')} AS AvgTone, SOURCEURL, Day FROM events_in
WHERE Day BETWEEN 19980101 AND 19980115""")
def q_landed_events(spark, sf_dir):
    """Event feed landed per day; a day range reads only its partitions."""
    from ..sources import landed

    path = scratch_path(spark, "landed_events")
    ev = rounded(fx.events_in(spark, sf_dir)).select("event_id", "AvgTone", "SOURCEURL", "Day")
    files.rebalance(ev, "Day").write.mode("overwrite").partitionBy("Day").parquet(path)
    return landed.read_landed_events(spark, path, 19980101, 19980115)


@query("landed_news", sql=f"WITH {NEWS} SELECT * FROM news")
def q_landed_news(spark, sf_dir):
    """Headline dump landed as JSON lines, read back with the declared schema."""
    from ..sources import landed

    path = scratch_path(spark, "landed_news")
    fx.news(spark, sf_dir).write.mode("overwrite").json(path)
    return landed.read_landed_news(spark, path, "json")


@query("tone_normalized", sql=f"""
WITH {TONE_DAILY_FILLED}
SELECT Date, num,
       {r4('(avg_tone - (SELECT min(avg_tone) FROM tg)) / ((SELECT max(avg_tone) FROM tg) - (SELECT min(avg_tone) FROM tg))')} AS normalized_avg_tone,
       {r4('(std_tone - (SELECT min(std_tone) FROM tg)) / ((SELECT max(std_tone) FROM tg) - (SELECT min(std_tone) FROM tg))')} AS normalized_std_tone,
       {r4('(median_tone - (SELECT min(median_tone) FROM tg)) / ((SELECT max(median_tone) FROM tg) - (SELECT min(median_tone) FROM tg))')} AS normalized_median_tone
FROM tg""")
def q_tone_normalized(spark, sf_dir):
    """Daily tone with each statistic min-max normalised and the original dropped."""
    return rounded(flows.tone_features(spark, sf_dir))


@query("buysell_features", sql=f"""
WITH {BUYSELL_IN_SQL}
SELECT Date, Category, {r4('avg_sentiment')} AS avg_sentiment, {r4('avg_subjectivity')} AS avg_subjectivity,
       {r4('avg_articles_count')} AS avg_articles_count, buySell
FROM bi""")
def q_buysell_features(spark, sf_dir):
    """Classifier input: per (Date, Category) sentiment features and the next-day signal."""
    return rounded(flows.buysell_in(spark, sf_dir))


@query("sector_ohlc", sql=f"""
WITH {BARS}
SELECT Date, Category, {r4('avg(Open)')} AS Open, {r4('avg(Close)')} AS Close FROM bars GROUP BY 1, 2""")
def q_sector_ohlc(spark, sf_dir):
    """Sector-level daily Open/Close (mean over the sector's stocks): the price side of
    the sentiment-price join."""
    return rounded(flows.sector_ohlc(fx.bars(spark, sf_dir)))


@query("describe_news", sql=f"""
WITH {NEWS}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, min(CAST({c} AS VARCHAR)) AS min, max(CAST({c} AS VARCHAR)) AS max FROM news"
    for c in ("date", "category", "source")))
def q_describe_news(spark, sf_dir):
    return profile.summary_text(fx.news(spark, sf_dir), ["date", "category", "source"])


@query("sink_csv_headerless", sql=SIGNAL_SQL)
def q_sink_csv_headerless(spark, sf_dir):
    path = scratch_path(spark, "signal_csv_headerless")
    files.write_csv(rounded(sector_signal_df(spark, sf_dir)), path, header=False)
    return files.read_csv(spark, path, schemas.SECTOR_SIGNAL, header=False)


@query("sink_csv_sorted", sql=f"""
SELECT CAST(row_number() OVER (PARTITION BY Category ORDER BY Date) AS INTEGER) AS place, * FROM ({SIGNAL_SQL})""")
def q_sink_csv_sorted(spark, sf_dir):
    """Rows sorted at the sink: the place of each row in its sector, by file and position in the file."""
    path = scratch_path(spark, "signal_csv_sorted")
    files.write_csv(rounded(sector_signal_df(spark, sf_dir)), path, order_by=["Date", "Category"])
    back = files.read_csv(spark, path, schemas.SECTOR_SIGNAL).withColumns(
        {"f": F.col("_metadata.file_name"), "i": F.monotonically_increasing_id()})
    w = Window.partitionBy("Category").orderBy("f", "i")
    return back.withColumn("place", F.row_number().over(w)).drop("f", "i")


@query("minmax_train_fit", sql=f"""
WITH {STOCK_FEATURES_SQL},
spl AS (SELECT *, row_number() OVER (PARTITION BY Stock ORDER BY Date) <= floor(count(*) OVER (PARTITION BY Stock) * 0.8) AS is_train FROM sf),
b AS (SELECT Stock, min(Momentum) FILTER (WHERE is_train) AS lo, max(Momentum) FILTER (WHERE is_train) AS hi FROM spl GROUP BY Stock)
SELECT Date, Stock, is_train, {r4('CASE WHEN hi = lo THEN 0.5 ELSE (Momentum - lo) / (hi - lo) END')} AS "Momentum_scaled"
FROM spl JOIN b USING (Stock)""")
def q_minmax_train_fit(spark, sf_dir):
    """Per-stock scaling fitted on the train days only."""
    s = split.chrono_split(flows.stock_features(spark, sf_dir), "Stock", "Date", 0.8)
    s = normalize.minmax_per_key(s, ["Momentum"], "Stock", fit_on="is_train")
    return rounded(s.select("Date", "Stock", "is_train", "Momentum_scaled"))
