"""End-to-end jobs over the reference's own input shapes (CSV dumps with a header).

Each job reads its inputs with a declared schema, builds one lazy plan from
the library's operators and writes its result with a distributed writer
(``single_file=True`` reproduces a one-file CSV export for small results).
Run from the command line::

    python -m tonetide.plans.jobs sector_index input=merged.csv output=out/ [format=csv]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import clean_scratch, cut_lineage
from ..functions.scalar import row_vwap
from ..operators import market, normalize, sentiment as st, signal, split, tone
from ..sources import files
from . import flows, metrics, models, ols


def _write(df: DataFrame, output: str, fmt: str = "csv", single_file: bool = False, partition_by=None):
    if fmt == "csv":
        files.write_csv(df, output, single_file=single_file, partition_by=partition_by)
    else:
        files.write_parquet(df, output, partition_by=partition_by)


def sector_index(spark: SparkSession, input: str, output: str, fmt: str = "csv") -> DataFrame:
    """Bars -> weighted/rounded bars -> row VWAP -> sector mean -> min-max normalised index."""
    bars = files.read_csv(spark, input, schemas.MERGED_BARS)
    bars = market.scale_and_round_bars(bars)
    idx = market.sector_index(bars.withColumn("VWAP", row_vwap()), "VWAP", "Sector_VWAP")
    out = normalize.normalize_column(idx, "Sector_VWAP", "Normalized_Sector_VWAP")
    _write(out, output, fmt)
    return out


def stock_dump(spark: SparkSession, input: str, output: str, fmt: str = "parquet") -> DataFrame:
    """Bars -> weighted/rounded bars with Custom_Metric: the full per-stock dump, by month."""
    bars = market.scale_and_round_bars(files.read_csv(spark, input, schemas.MERGED_BARS))
    out = bars.withColumn("Month", F.date_format("Date", "yyyy-MM"))
    _write(out, output, fmt, partition_by="Month")
    return out


def moving_average(spark: SparkSession, input: str, output: str, preceding: int = 5, fmt: str = "csv") -> DataFrame:
    """Bars -> VWAP per (Date, Stock) -> sector mean -> trailing moving average."""
    bars = files.read_csv(spark, input, schemas.MERGED_BARS)
    per_stock = bars.groupBy("Date", "Stock", "Category").agg(
        F.try_divide(F.sum(F.col("Close") * F.col("Volume")), F.sum("Volume")).alias("VWAP"))
    sec = market.moving_avg(market.sector_vwap(per_stock), preceding=int(preceding))
    out = sec.select("Date", "Category", "MovingAvg_VWAP")
    _write(out, output, fmt)
    return out


def ranked_price(spark: SparkSession, input: str, output: str, fmt: str = "csv") -> DataFrame:
    """Bars -> sector average price -> category rank, normalised date rank."""
    bars = files.read_csv(spark, input, schemas.MERGED_BARS)
    s = market.date_rank(market.category_rank(market.sector_avg_price(bars)))
    s = normalize.normalize_column(s, "Date_Rank", "Normalized_Date_Rank")
    out = s.select("Date", "Category", "Sector_Average_Price", "Category_Rank", "Normalized_Date_Rank")
    _write(out, output, fmt)
    return out


def buysell(spark: SparkSession, input: str, output: str, fmt: str = "csv") -> DataFrame:
    """Sector index -> next-day buy (1) / sell (0) signal."""
    out = signal.buysell_signal(files.read_csv(spark, input, schemas.SECTOR_INDEX), "sectorIndex")
    _write(out, output, fmt)
    return out


def average_rank(spark: SparkSession, input: str, output: str, fmt: str = "csv") -> DataFrame:
    """Per-source daily sentiment -> mean of means per (Date, Category) -> row rank."""
    per_source = files.read_csv(spark, input, schemas.DAILY_SENTIMENT_IN)
    out = market.row_rank(st.avg_of_avgs(per_source), "Category", "Date", "Rank")
    _write(out, output, fmt)
    return out


def sentiment(spark: SparkSession, input: str, output: str, input_format: str = "json",
              fmt: str = "csv") -> DataFrame:
    """Headline dump -> valid dates -> lexicon scores -> daily sentiment by (date, category)."""
    news = spark.read.schema(schemas.NEWS_DUMP).format(input_format).load(input)
    # scored inside each row, so equal articles need no id to stay apart
    docs = st.with_text(st.valid_dates(news.drop("link", "authors"))).select("date", "category", "headline_description")
    out = st.daily_sentiment(st.score_text(docs))
    _write(out, output, fmt)
    return out


def _by_content(feed: DataFrame) -> DataFrame:
    """``event_id`` for feeds that have none: a hash of the row's own content, so the row that a dedup
    keeps doesn't depend on files, their order or the cluster."""
    return feed.withColumn("event_id", F.xxhash64(*[F.col(f"`{c}`") for c in feed.columns]))


def ingest_events(spark: SparkSession, input: str, output: str) -> DataFrame:
    """Event CSV (quoted newlines) -> URL dedup per day -> (Date, Tone, Type, Url) Parquet by Date."""
    raw = files.read_csv(spark, input, schemas.EVENT_FEED, multiline=True, escape='"')
    out = tone.ingest_events(_by_content(raw))
    _write(out, output, "parquet", partition_by="Date")
    return out


def daily_tone(spark: SparkSession, input: str, output: str, country: str = "US", fmt: str = "csv") -> DataFrame:
    """Event CSV -> country filter -> URL dedup -> daily tone stats -> gap-filled months."""
    raw = files.read_csv(spark, input, schemas.EVENT_FEED, multiline=True, escape='"')
    ev = tone.dedup_url(tone.country(_by_content(raw).withColumnRenamed("DATEADDED", "Day"), country))
    daily = tone.tone_daily_stats(ev, count_nulls=True)
    out = tone.gap_fill(daily, tone.month_spine(daily))
    _write(out, output, fmt)
    return out


STOCK_X = ["avg_articles_count", "avg_subjectivity", "Momentum"]


def per_stock_regression(spark: SparkSession, input: str, output: str, fmt: str = "csv") -> DataFrame:
    """Per stock: chronological 80/20 split, OLS on three features, test mse/rmse/r2, sorted by r2."""
    feats = files.read_csv(spark, input, schemas.STOCK_FEATURES).na.drop("any")
    s = split.chrono_split(feats, "Stock", "Date", 0.8)
    m = ols.fit_evaluate_closed_form(s, STOCK_X, "Close-Open", "is_train", by="Stock")
    out = m.where(F.col("n_test") > 0).select("Stock", "mse", "rmse", "r2").orderBy(F.col("r2").desc_nulls_last())
    _write(out, output, fmt)
    return out


def lag_sweep(spark: SparkSession, input: str, output: str, fmt: str = "csv") -> DataFrame:
    """Per stock and lag count: OLS with label lags; mean test mse/r2 per lag."""
    feats = files.read_csv(spark, input, schemas.STOCK_FEATURES)
    per_stock = ols.lag_sweep_per_stock(feats, ["avg_articles_count", "Momentum", "avg_subjectivity"], "Close-Open")
    out = ols.lag_sweep_summary(per_stock).orderBy("lag")
    _write(out, output, fmt)
    return out


def sentiment_price(spark: SparkSession, sentiment: str, prices: str, output: str, year: str = "2016", fmt: str = "csv") -> DataFrame:
    """Daily sentiment x sector Open/Close of a year, either score non-zero, with ``open_close_diff``."""
    s = files.read_csv(spark, sentiment, schemas.DAILY_SENTIMENT_OUT)
    bars = files.read_csv(spark, prices, schemas.MERGED_BARS)
    px = flows.sector_ohlc(bars).select(F.col("Date").alias("date"), F.lower("Category").alias("category"), "Open", "Close")
    out = flows.sentiment_with_prices(s, px, int(year)).orderBy("date")
    _write(out, output, fmt)
    return out


def sentiment_regression(spark: SparkSession, input: str, output: str, fmt: str = "csv") -> DataFrame:
    """The ``sentiment_price`` table -> 70/30 split -> linear regression -> actual and predicted."""
    df = files.read_csv(spark, input, schemas.REGRESSION_IN)
    s = cut_lineage(split.hash_split(df, F.concat_ws("|", *df.columns), 0.7))
    pred = models.linear(s.where("is_train"), s.where("NOT is_train"), ["avg_sentiment", "avg_subjectivity"], "open_close_diff")
    out = pred.select("date", "open_close_diff", "prediction")
    _write(out, output, fmt)
    return out


def three_way(spark: SparkSession, sentiment: str, tone_daily: str, index: str, output: str, fmt: str = "csv") -> DataFrame:
    """Daily sentiment x daily tone (both statistics normalised) x normalised sector index."""
    s = files.read_csv(spark, sentiment, schemas.DAILY_SENTIMENT_OUT)
    t = files.read_csv(spark, tone_daily, schemas.TONE_DAILY)
    i = files.read_csv(spark, index, schemas.SECTOR_INDEX_NORMALIZED)
    t = normalize.minmax_normalize(t, ["avg_tone", "std_tone", "median_tone"]).withColumnRenamed("Date", "date")
    i = i.select(F.col("Date").alias("date"), F.lower("Category").alias("category"), "Normalized_Sector_VWAP")
    out = s.join(t, "date").join(i, ["date", "category"]).orderBy("date", "category")
    _write(out, output, fmt)
    return out


def linear_probability(spark: SparkSession, input: str, output: str, fmt: str = "csv") -> DataFrame:
    """Buy/sell features -> chronological 80/20 split -> linear probability model -> r2 per category."""
    df = files.read_csv(spark, input, schemas.BUYSELL_IN).withColumnRenamed("BuySell", "buySell")
    s = cut_lineage(split.chrono_split_global(cut_lineage(df), "Date", ("Category",), 0.8))
    pred = models.linear_probability(s.where("is_train").drop("is_train"), s.where("NOT is_train").drop("is_train"))
    out = metrics.regression_metrics(pred, "buySell", "prediction", by="Category")
    _write(out, output, fmt)
    return out


def classifiers(spark: SparkSession, input: str, output: str, fmt: str = "csv") -> DataFrame:
    """Buy/sell features -> chronological 80/20 split -> logistic, forest, polynomial
    logistic -> exact test AUC per model."""
    df = files.read_csv(spark, input, schemas.BUYSELL_IN).withColumnRenamed("BuySell", "buySell")
    s = cut_lineage(split.chrono_split_global(df, "Date", ("Category",), 0.8))
    tr, te = s.where("is_train").drop("is_train"), s.where("NOT is_train").drop("is_train")
    outs = []
    for name, fit in (("logistic", models.logistic), ("random_forest", models.random_forest),
                      ("poly_logistic", models.poly_logistic)):
        pred = models.drop_null_scores(fit(tr, te)).withColumn("model", F.lit(name))
        outs.append(metrics.auc(pred, "buySell", "score", by="model"))
    out = outs[0].unionByName(outs[1]).unionByName(outs[2])
    _write(out, output, fmt)
    return out


JOBS = {
    "sector_index": sector_index,
    "moving_average": moving_average,
    "ranked_price": ranked_price,
    "buysell": buysell,
    "average_rank": average_rank,
    "sentiment": sentiment,
    "ingest_events": ingest_events,
    "daily_tone": daily_tone,
    "per_stock_regression": per_stock_regression,
    "lag_sweep": lag_sweep,
    "classifiers": classifiers,
    "stock_dump": stock_dump,
    "sentiment_price": sentiment_price,
    "sentiment_regression": sentiment_regression,
    "three_way": three_way,
    "linear_probability": linear_probability,
}


def main(argv=None):
    argv = list(sys.argv[1:] if argv is None else argv)
    if not argv or argv[0] not in JOBS:
        print("jobs: " + ", ".join(JOBS))
        return 2
    kwargs = dict(a.split("=", 1) for a in argv[1:])
    spark = SparkSession.builder.appName(f"tonetide-{argv[0]}").getOrCreate()
    JOBS[argv[0]](spark, **kwargs)
    clean_scratch(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
