"""Model, metric and split-evaluation queries (M6-M18, O4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import cut_lineage
from ..functions.calendar import iso_text
from ..operators import market, split
from ..sources import fixtures as fx
from . import flows, metrics, models, ols
from .catalog import query, rounded
from .ols_sql import ols_ctes
from .q_relational import BUYSELL_IN_SQL, SENT_PRICE_SQL, STOCK_FEATURES_SQL, THREE_WAY_SQL
from .sqlviews import BARS, r4, sig

STOCK_X = ["avg_articles_count", "avg_subjectivity", "Momentum"]
STOCK_Y = "Close-Open"
SENT_X = ["avg_sentiment", "avg_subjectivity"]
SENT_Y = "open_close_diff"


@query("regression_metrics", sql=f"""
WITH {BARS},
sec AS (SELECT Date, Category, avg(VWAP) AS v FROM bars GROUP BY 1, 2),
f AS (SELECT Category,
             avg(v) OVER (PARTITION BY Category ORDER BY Date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS p,
             lead(v) OVER (PARTITION BY Category ORDER BY Date) AS y
      FROM sec)
SELECT Category, count(*) AS n, {r4('avg((y - p) * (y - p))')} AS mse, {r4('sqrt(avg((y - p) * (y - p)))')} AS rmse,
       {r4('avg(abs(y - p))')} AS mae,
       {r4('1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} AS r2
FROM f WHERE y IS NOT NULL GROUP BY Category""")
def q_regression_metrics(spark, sf_dir):
    """How well the 6-row moving average forecasts the next day's sector VWAP."""
    sec = market.moving_avg(market.sector_vwap(fx.daily_vwap(spark, sf_dir)))
    w = Window.partitionBy("Category").orderBy("Date")
    f = sec.withColumn("next_vwap", F.lead("Sector_VWAP").over(w)).where(F.col("next_vwap").isNotNull())
    return rounded(metrics.regression_metrics(f, "next_vwap", "MovingAvg_VWAP", by="Category"))


@query("auc_rank", sql=f"""
WITH {BUYSELL_IN_SQL},
h AS (SELECT Category, avg_sentiment AS s, buySell AS y FROM bi WHERE buySell IS NOT NULL AND avg_sentiment IS NOT NULL),
r AS (SELECT Category, y, rank() OVER (PARTITION BY Category ORDER BY s)
                          + (count(*) OVER (PARTITION BY Category, s) - 1) / 2.0 AS rk FROM h),
g AS (SELECT Category, sum(CASE WHEN y = 1 THEN rk ELSE 0 END) AS rs,
             sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS n_pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS n_neg
      FROM r GROUP BY Category)
SELECT Category, {r4('(rs - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg)')} AS auc,
       CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg
FROM g""")
def q_auc_rank(spark, sf_dir):
    """Exact AUC of daily sentiment as a score for the next-day buy signal, per sector."""
    bi = flows.buysell_in(spark, sf_dir)
    return rounded(metrics.auc(bi, "buySell", "avg_sentiment", by="Category"))


def _sent_split(spark, sf_dir):
    sp = flows.sentiment_price(spark, sf_dir)
    return split.hash_split(sp, iso_text("date"), 0.7)


_SENT_OLS, _ = ols_ctes("s", SENT_X, SENT_Y, "is_train", [])


@query("lr_sentiment", sql=f"""
WITH {SENT_PRICE_SQL},
s AS (SELECT *, CAST(('0x' || substr(md5(strftime(date, '%Y-%m-%d')), 1, 6)) AS BIGINT) % 100 < 70 AS is_train FROM sp),
{_SENT_OLS}
SELECT date, {r4('open_close_diff')} AS open_close_diff, {r4('prediction')} AS prediction FROM ls WHERE NOT is_train""")
def q_lr_sentiment(spark, sf_dir):
    """Global linear regression of the daily price change on the two sentiment
    features (spark.ml LinearRegression); actual vs predicted on the test rows."""
    s = cut_lineage(_sent_split(spark, sf_dir))  # the fit and the scoring read it once each
    pred = models.linear(s.where("is_train"), s.where("NOT is_train"), SENT_X, SENT_Y)
    return rounded(pred.select("date", "open_close_diff", "prediction"))


# Models of news features are fitted and tested on the days from the first to the last news.
IN_NEWS_SPAN = "Date BETWEEN (SELECT min(CAST(date AS DATE)) FROM daily) AND (SELECT max(CAST(date AS DATE)) FROM daily)"
_STOCK_OLS, _ = ols_ctes("spl", STOCK_X, STOCK_Y, "(idx <= floor(n * 0.8))", ["Stock"])
LR_STOCK_SQL = f"""{STOCK_FEATURES_SQL},
clean AS (SELECT * FROM sf WHERE Momentum IS NOT NULL),
spl AS (SELECT *, row_number() OVER (PARTITION BY Stock ORDER BY Date) AS idx,
               count(*) OVER (PARTITION BY Stock) AS n FROM clean),
{_STOCK_OLS},
pr AS (SELECT Stock, CAST(floor(n * 0.8) AS BIGINT) AS n_train, "Close-Open" AS y, prediction AS p FROM ls WHERE idx > floor(n * 0.8)),
m AS (SELECT Stock, any_value(n_train) AS n_train, count(*) AS n_test,
             avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse,
             1.0 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0) AS r2
      FROM pr GROUP BY Stock)"""


def lr_per_stock_df(spark, sf_dir, news_days: bool = False):
    """Per-stock OLS of Close-Open on articles, subjectivity and momentum: closed
    form from grouped covariances on the first 80 % of each stock's days."""
    feats = flows.stock_features(spark, sf_dir)
    if news_days:
        feats = flows.in_news_span(feats, spark, sf_dir)
    feats = feats.na.drop("any", subset=STOCK_X + [STOCK_Y])
    s = split.chrono_split(feats, "Stock", "Date", 0.8)
    m = ols.fit_evaluate_closed_form(s, STOCK_X, STOCK_Y, "is_train", by="Stock")
    # stocks whose split leaves no test row have no metrics row, as in the join form
    return m.where(F.col("n_test") > 0).select("Stock", "n_train", "n_test", "mse", "rmse", "r2")


@query("lr_per_stock", sql=f"""
WITH {LR_STOCK_SQL}
SELECT Stock, n_train, n_test, {sig('mse')} AS mse, {sig('rmse')} AS rmse, {r4('r2')} AS r2 FROM m""")
def q_lr_per_stock(spark, sf_dir):
    return rounded(lr_per_stock_df(spark, sf_dir), significant=("mse", "rmse"))


LR_NEWS_SQL = LR_STOCK_SQL.replace("FROM sf WHERE Momentum IS NOT NULL", f"FROM sf WHERE Momentum IS NOT NULL AND {IN_NEWS_SPAN}")


@query("lr_per_stock_news_days", sql=f"""
WITH {LR_NEWS_SQL}
SELECT Stock, n_train, n_test, {sig('mse')} AS mse, {sig('rmse')} AS rmse, {r4('r2')} AS r2 FROM m""")
def q_lr_per_stock_news_days(spark, sf_dir):
    """The per-stock models on the days that have news, so that the news features vary in train and test rows."""
    return rounded(lr_per_stock_df(spark, sf_dir, news_days=True), significant=("mse", "rmse"))


@query("stock_metrics_top", sql=f"""
WITH {LR_STOCK_SQL}
SELECT Stock, {sig('mse')} AS mse, {sig('rmse')} AS rmse, {r4('r2')} AS r2
FROM m WHERE r2 IS NOT NULL ORDER BY r2 DESC, Stock LIMIT 10""")
def q_stock_metrics_top(spark, sf_dir):
    """Top 10 stocks by test r2 (the sorted metrics report)."""
    m = lr_per_stock_df(spark, sf_dir).where(F.col("r2").isNotNull())
    top = m.orderBy(F.col("r2").desc(), "Stock").limit(10).select("Stock", "mse", "rmse", "r2")
    return rounded(top, significant=("mse", "rmse"))


@query("lag_sweep")
def q_lag_sweep(spark, sf_dir):
    """Mean per-stock test mse/r2 for each lag count (1..30, 90, 120)."""
    feats = flows.stock_features(spark, sf_dir)
    per_stock = ols.lag_sweep_per_stock(feats, ["avg_articles_count", "Momentum", "avg_subjectivity"], STOCK_Y)
    return ols.lag_sweep_summary(per_stock)


def _lag_sql(lags: int) -> str:
    """Metrics per stock with Momentum and ``lags`` lags of the label."""
    cols = ", ".join(f'lag("{STOCK_Y}", {i}) OVER (PARTITION BY Stock ORDER BY Date) AS lag{i}' for i in range(1, lags + 1))
    names = ["Momentum", *[f"lag{i}" for i in range(1, lags + 1)]]
    ctes, last = ols_ctes(f"k{lags}", names, STOCK_Y, "(idx <= floor(n * 0.8))", ["Stock"], prefix=f"g{lags}")
    full = " AND ".join(f'"{c}" IS NOT NULL' for c in [*names, STOCK_Y])
    return f"""l{lags} AS (SELECT Stock, Date, "{STOCK_Y}", Momentum, {cols} FROM sf),
k{lags} AS (SELECT *, row_number() OVER (PARTITION BY Stock ORDER BY Date) AS idx, count(*) OVER (PARTITION BY Stock) AS n
            FROM l{lags} WHERE {full}),
{ctes},
t{lags} AS (SELECT Stock, {lags} AS lag, any_value(CAST(floor(n * 0.8) AS INTEGER)) AS n_train,
                   CAST(count(*) AS INTEGER) AS n_test, avg(("{STOCK_Y}" - prediction) * ("{STOCK_Y}" - prediction)) AS mse,
                   CASE WHEN count(*) >= 2 THEN 1.0 - sum(("{STOCK_Y}" - prediction) * ("{STOCK_Y}" - prediction))
                     / nullif(var_pop("{STOCK_Y}") * count(*), 0) END AS r2
            FROM {last} WHERE idx > floor(n * 0.8) GROUP BY Stock)"""


@query("lag_sweep_means", sql=f"""
WITH {STOCK_FEATURES_SQL},
{_lag_sql(1)},
{_lag_sql(2)},
{_lag_sql(3)},
t AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3)
SELECT lag, {sig('avg(mse)')} AS avg_mse, {r4('avg(r2)')} AS avg_r2, count(mse) AS n_stocks FROM t GROUP BY lag""")
def q_lag_sweep_means(spark, sf_dir):
    """The lag-vs-metric table (means over stocks) for lags 1 to 3 over one base feature."""
    feats = flows.stock_features(spark, sf_dir)
    per_stock = ols.lag_sweep_per_stock(feats, ["Momentum"], STOCK_Y, lags=[1, 2, 3])
    return rounded(ols.lag_sweep_summary(per_stock), significant=("avg_mse",))


@query("lag_sweep_pair", sql=f"""
WITH {STOCK_FEATURES_SQL},
{_lag_sql(1)},
{_lag_sql(2)}
SELECT Stock, lag, n_train, n_test, {sig('mse')} AS mse, {r4('r2')} AS r2
FROM (SELECT * FROM t1 UNION ALL SELECT * FROM t2)""")
def q_lag_sweep_pair(spark, sf_dir):
    """The sweep's per-stock metrics for lags 1 and 2 over one base feature."""
    feats = flows.stock_features(spark, sf_dir)
    per_stock = ols.lag_sweep_per_stock(feats, ["Momentum"], STOCK_Y, lags=[1, 2])
    return rounded(per_stock.where((F.col("n_train") > 0) & (F.col("n_test") > 0)), significant=("mse",))


def _buysell_split(spark, sf_dir, news_days: bool = True):
    """Chronological 80/20 split of the buy/sell features, materialised once in
    the shared checkpoint folder so iterative fits do not replay the lineage."""
    bi = flows.buysell_in(spark, sf_dir)
    if news_days:
        bi = flows.in_news_span(bi, spark, sf_dir)
    s = cut_lineage(split.chrono_split_global(bi, "Date", ("Category",), 0.8))
    return s.where("is_train").drop("is_train"), s.where("NOT is_train").drop("is_train")


BUYSELL_X = ["avg_sentiment", "avg_subjectivity", "avg_articles_count"]
# Category enters as dummies, that is as an intercept of its own for each category.
_LPM_OLS, _ = ols_ctes("bs", BUYSELL_X, "buySell", "is_train", [], ["Category"])
BUYSELL_SPLIT_SQL = f"""{BUYSELL_IN_SQL},
bn AS (SELECT * FROM bi WHERE {IN_NEWS_SPAN}),
bs AS (SELECT *, row_number() OVER (ORDER BY Date, Category) <= floor((SELECT count(*) FROM bn) * 0.8) AS is_train FROM bn)"""


@query("lpm_buysell", sql=f"""
WITH {BUYSELL_SPLIT_SQL},
{_LPM_OLS}
SELECT Date, Category, buySell, {r4('prediction')} AS prediction FROM ls WHERE NOT is_train""")
def q_lpm_buysell(spark, sf_dir):
    tr, te = _buysell_split(spark, sf_dir)
    return rounded(models.linear_probability(tr, te).select("Date", "Category", "buySell", "prediction"))


@query("r2_per_category", sql=f"""
WITH {BUYSELL_SPLIT_SQL},
{_LPM_OLS},
e AS (SELECT Category, buySell AS y, prediction AS p FROM ls WHERE NOT is_train AND buySell IS NOT NULL)
SELECT Category, count(*) AS n, {r4('avg((y - p) * (y - p))')} AS mse, {r4('sqrt(avg((y - p) * (y - p)))')} AS rmse,
       {r4('avg(abs(y - p))')} AS mae, {r4('1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} AS r2
FROM e GROUP BY Category""")
def q_r2_per_category(spark, sf_dir):
    tr, te = _buysell_split(spark, sf_dir)
    pred = models.linear_probability(tr, te)
    return rounded(metrics.regression_metrics(pred, "buySell", "prediction", by="Category"))


# All days of the buy/sell features, as in the reference.
BUYSELL_ALL_SQL = f"""{BUYSELL_IN_SQL},
bs AS (SELECT *, row_number() OVER (ORDER BY Date, Category) <= floor((SELECT count(*) FROM bi) * 0.8) AS is_train FROM bi)"""

# The reference's penalty zeroes every coefficient, so the score is the train rate of buys.
CONSTANT_SCORE_SQL = f"""
WITH {BUYSELL_ALL_SQL},
m AS (SELECT avg(buySell) AS p FROM bs WHERE is_train)
SELECT Date, Category, buySell, CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END AS prediction, {r4('p')} AS score FROM bs, m WHERE NOT is_train"""


@query("logit_buysell", sql=CONSTANT_SCORE_SQL)
def q_logit_buysell(spark, sf_dir):
    tr, te = _buysell_split(spark, sf_dir, news_days=False)
    return rounded(models.logistic(tr, te).select("Date", "Category", "buySell", "prediction", "score"))


@query("logit_weak_penalty")
def q_logit_weak_penalty(spark, sf_dir):
    """The logistic model with a penalty small enough to keep coefficients: scores that rank."""
    tr, te = _buysell_split(spark, sf_dir)
    return models.logistic(tr, te, max_iter=100, reg=1e-3, elastic=0.0).select("Date", "Category", "buySell", "prediction", "score")


# The features of the formula, long: the sector's dummies (the rarest, then last, has none) and the three features.
FORMULA_SQL = f"""{BUYSELL_SPLIT_SQL},
tr AS (SELECT * FROM bs WHERE is_train AND buySell IS NOT NULL),
k AS (SELECT Category, row_number() OVER (ORDER BY count(*) DESC, Category) AS k, count(*) OVER () AS of FROM tr GROUP BY Category),
x AS (SELECT 'Category_' || k.Category AS f, k, CASE WHEN tr.Category = k.Category THEN 1.0 ELSE 0.0 END AS x, buySell AS y FROM tr, k WHERE k < of
      UNION ALL SELECT 'avg_sentiment', 101, avg_sentiment, buySell FROM tr
      UNION ALL SELECT 'avg_subjectivity', 102, avg_subjectivity, buySell FROM tr
      UNION ALL SELECT 'avg_articles_count', 103, avg_articles_count, buySell FROM tr)"""


@query("logit_score_equations", sql=f"""
WITH {FORMULA_SQL}
SELECT f AS coefficient, count(*) AS n, {r4('sum(x)')} AS sum_x, CAST(0 AS DOUBLE) AS residual FROM x GROUP BY f
UNION ALL SELECT 'intercept', count(*), CAST(count(*) AS DOUBLE), CAST(0 AS DOUBLE) FROM tr""")
def q_logit_score_equations(spark, sf_dir):
    """The weakly penalised logistic model is at its optimum: nothing is left of any score equation."""
    tr, _ = _buysell_split(spark, sf_dir)
    return rounded(models.score_equations(tr).withColumn("residual", F.abs("residual")))


@query("rf_stump", sql=f"""
WITH {FORMULA_SQL},
v AS (SELECT f, k, x, count(*) AS c, sum(y) AS p FROM x GROUP BY f, k, x),
s AS (SELECT f, k, x, lead(x) OVER w AS after, sum(c) OVER w AS nl, sum(p) OVER w AS pl, sum(c) OVER (PARTITION BY f) AS n, sum(p) OVER (PARTITION BY f) AS p
      FROM v WINDOW w AS (PARTITION BY f ORDER BY x ROWS UNBOUNDED PRECEDING)),
g AS (SELECT f, k, (x + after) / 2 AS threshold, nl, pl, n, p,
             2 * (p / n) * (1 - p / n) - nl / n * 2 * (pl / nl) * (1 - pl / nl) - (n - nl) / n * 2 * ((p - pl) / (n - nl)) * (1 - (p - pl) / (n - nl)) AS gain
      FROM s WHERE after IS NOT NULL),
b AS (SELECT * FROM g ORDER BY gain DESC, k, threshold LIMIT 1)
SELECT f AS feature, {r4('threshold')} AS threshold, 'left' AS side, CAST(nl AS BIGINT) AS n, {r4('pl / nl')} AS rate FROM b
UNION ALL SELECT f, {r4('threshold')}, 'right', CAST(n - nl AS BIGINT), {r4('(p - pl) / (n - nl)')} FROM b""")
def q_rf_stump(spark, sf_dir):
    """The best single split of the buy/sell features, against an exhaustive search in SQL."""
    tr, _ = _buysell_split(spark, sf_dir)
    return rounded(models.stump(tr))


@query("rf_buysell")
def q_rf_buysell(spark, sf_dir):
    tr, te = _buysell_split(spark, sf_dir)
    return models.random_forest(tr, te).select("Date", "Category", "buySell", "prediction", "score")


@query("poly_logit", sql=CONSTANT_SCORE_SQL)
def q_poly_logit(spark, sf_dir):
    tr, te = _buysell_split(spark, sf_dir, news_days=False)
    return rounded(models.poly_logistic(tr, te).select("Date", "Category", "buySell", "prediction", "score"))


@query("classifier_auc")
def q_classifier_auc(spark, sf_dir):
    """Exact test AUC of the classifiers, one row per model."""
    tr, te = _buysell_split(spark, sf_dir)
    outs = []
    weak = lambda a, b: models.logistic(a, b, max_iter=100, reg=1e-3, elastic=0.0)
    for name, fit in (("logistic", models.logistic), ("logistic_weak_penalty", weak),
                      ("random_forest", models.random_forest), ("poly_logistic", models.poly_logistic)):
        pred = models.drop_null_scores(fit(tr, te))
        outs.append(metrics.auc(pred.withColumn("model", F.lit(name)), "buySell", "score", by="model"))
    res = outs[0]
    for o in outs[1:]:
        res = res.unionByName(o)
    return res


@query("ols_one_feature", sql=f"""
WITH {STOCK_FEATURES_SQL},
clean AS (SELECT * FROM sf WHERE Momentum IS NOT NULL)
SELECT Stock, count(*) AS n, {r4('regr_intercept("Close-Open", Momentum)')} AS b_0,
       {r4('regr_slope("Close-Open", Momentum)')} AS b_1, {r4('regr_r2("Close-Open", Momentum)')} AS r2
FROM clean GROUP BY Stock""")
def q_ols_one_feature(spark, sf_dir):
    """Per-stock simple regression of Close-Open on Momentum over all days: the
    closed form against the SQL engine's own regr_* aggregates."""
    feats = flows.stock_features(spark, sf_dir).na.drop("any", subset=["Momentum", STOCK_Y])
    # every row is a train row: r2 follows from the same moments as the coefficients
    both = feats.withColumn("side", F.explode(F.array(F.lit(True), F.lit(False))))
    m = ols.fit_evaluate_closed_form(both, ["Momentum"], STOCK_Y, "side", by="Stock")
    slope = F.when(F.col("flat"), None)
    flat = feats.groupBy("Stock").agg((F.min("Momentum") == F.max("Momentum")).alias("flat"))
    m = m.join(flat, "Stock")
    return rounded(m.select("Stock", F.col("n_train").alias("n"), *[slope.otherwise(F.col(c)).alias(c) for c in ("b_0", "b_1", "r2")]))


THREE_WAY_X = ["avg_sentiment", "avg_subjectivity", "normalized_avg_tone", "normalized_std_tone", "normalized_median_tone"]
THREE_WAY_Y = "Normalized_Sector_VWAP"
_THREE_OLS, _ = ols_ctes("ts", THREE_WAY_X, THREE_WAY_Y, "is_train", [])


@query("lr_three_way", sql=f"""
WITH {THREE_WAY_SQL},
ts AS (SELECT *, CAST(('0x' || substr(md5(strftime(date, '%Y-%m-%d') || '|' || category), 1, 6)) AS BIGINT) % 100 < 70 AS is_train FROM tw),
{_THREE_OLS}
SELECT date, category, {r4(THREE_WAY_Y)} AS "{THREE_WAY_Y}", {r4('prediction')} AS prediction FROM ls WHERE NOT is_train""")
def q_lr_three_way(spark, sf_dir):
    """Linear regression of the normalised sector index on sentiment and tone (the three-way frame)."""
    tw = flows.three_way(spark, sf_dir)
    s = cut_lineage(split.hash_split(tw, F.concat_ws("|", iso_text("date"), "category"), 0.7))
    pred = models.linear(s.where("is_train"), s.where("NOT is_train"), THREE_WAY_X, THREE_WAY_Y)
    return rounded(pred.select("date", "category", THREE_WAY_Y, "prediction"))
