"""Market queries: bars, sector index, moving average, signal, ranks."""

from __future__ import annotations


from ..operators import market, normalize, signal
from ..sources import fixtures as fx
from .catalog import query, rounded
from .sqlviews import BARS, TICKS, r4


def sector_signal_df(spark, sf_dir, preceding: int = 5):
    """Flagship: bars -> sector VWAP -> 6-row moving average -> next-day signal."""
    sec = market.sector_vwap(fx.daily_vwap(spark, sf_dir))
    sec = market.moving_avg(sec, "Sector_VWAP", "MovingAvg_VWAP", preceding)
    return signal.buysell_signal(sec, index_col="Sector_VWAP")


@query("sector_signal", sql=f"""
WITH {BARS},
sec AS (SELECT Date, Category, avg(VWAP) AS Sector_VWAP FROM bars GROUP BY 1, 2)
SELECT Date, Category, {r4('Sector_VWAP')} AS Sector_VWAP,
       {r4('avg(Sector_VWAP) OVER (PARTITION BY Category ORDER BY Date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)')} AS MovingAvg_VWAP,
       CAST(lead(Sector_VWAP) OVER (PARTITION BY Category ORDER BY Date) - Sector_VWAP > 0 AS INTEGER) AS BuySell
FROM sec""")
def q_sector_signal(spark, sf_dir):
    return rounded(sector_signal_df(spark, sf_dir))


@query("bars_source", sql=f"""
WITH {BARS}
SELECT Date, Stock, Category, {r4('Open')} AS Open, {r4('High')} AS High, {r4('Low')} AS Low,
       {r4('Close')} AS Close, {r4('Volume')} AS Volume, {r4('VWAP')} AS VWAP
FROM bars""")
def q_bars(spark, sf_dir):
    return rounded(fx.bars(spark, sf_dir))


@query("category_dim", sql="""
SELECT s.s_suppkey AS Stock, r.r_name AS Category
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_category_dim(spark, sf_dir):
    return fx.category_dim(spark, sf_dir)


@query("sector_vwap", sql=f"""
WITH {BARS}
SELECT Date, Category, {r4('avg(VWAP)')} AS Sector_VWAP FROM bars GROUP BY 1, 2""")
def q_sector_vwap(spark, sf_dir):
    return rounded(market.sector_vwap(fx.daily_vwap(spark, sf_dir)))


@query("moving_avg", sql=f"""
WITH {BARS},
sec AS (SELECT Date, Category, avg(VWAP) AS Sector_VWAP FROM bars GROUP BY 1, 2)
SELECT Date, Category,
       {r4('avg(Sector_VWAP) OVER (PARTITION BY Category ORDER BY Date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)')} AS MovingAvg_VWAP
FROM sec""")
def q_moving_avg(spark, sf_dir):
    sec = market.moving_avg(market.sector_vwap(fx.daily_vwap(spark, sf_dir)))
    return rounded(sec.select("Date", "Category", "MovingAvg_VWAP"))


@query("buysell_signal", sql=f"""
WITH {BARS},
idx AS (SELECT Date, Category, avg(VWAP) AS sectorIndex FROM bars GROUP BY 1, 2)
SELECT Date, Category, {r4('sectorIndex')} AS sectorIndex,
       CAST(lead(sectorIndex) OVER (PARTITION BY Category ORDER BY Date) - sectorIndex > 0 AS INTEGER) AS BuySell
FROM idx""")
def q_buysell(spark, sf_dir):
    idx = market.sector_index(fx.daily_vwap(spark, sf_dir), "VWAP", "sectorIndex")
    return rounded(signal.buysell_signal(idx, "sectorIndex"))


@query("round_bars", sql=f"""
WITH {BARS},
s AS (SELECT Date, Stock, Category,
             round_even(CAST(Open * 1.0 AS DOUBLE), 2) AS Open,
             round_even(CAST(High * 1.0 AS DOUBLE), 2) AS High,
             round_even(CAST(Low * 1.0 AS DOUBLE), 2) AS Low,
             round_even(CAST(Close * 1.0 AS DOUBLE), 2) AS Close,
             round_even(CAST(Volume * 0.0000001 AS DOUBLE), 2) AS Volume
      FROM bars)
SELECT Date, Stock, Category, {r4('Open')} AS Open, {r4('High')} AS High, {r4('Low')} AS Low,
       {r4('Close')} AS Close, {r4('Volume')} AS Volume
FROM s""")
def q_round_bars(spark, sf_dir):
    b = fx.bars(spark, sf_dir).drop("VWAP")
    out = market.scale_and_round_bars(b).drop("Custom_Metric")
    return rounded(out)


@query("custom_metric", sql=f"""
WITH {BARS},
s AS (SELECT Date, Stock, Category,
             round_even(Open, 2) AS Open, round_even(High, 2) AS High,
             round_even(Low, 2) AS Low, round_even(Close, 2) AS Close,
             round_even(Volume * 0.0000001, 2) AS Volume
      FROM bars)
SELECT Date, Stock, Category,
       {r4('round(CAST(Open + High + Low + Close + Volume AS DECIMAL(28,8)), 2)')} AS Custom_Metric
FROM s""")
def q_custom_metric(spark, sf_dir):
    b = market.scale_and_round_bars(fx.bars(spark, sf_dir).drop("VWAP"))
    return rounded(b.select("Date", "Stock", "Category", "Custom_Metric"))


@query("row_vwap", sql=f"""
WITH {BARS}
SELECT Date, Stock, Category, {r4('CASE WHEN Volume = 0 THEN NULL ELSE (Close * Volume) / Volume END')} AS VWAP
FROM bars""")
def q_row_vwap(spark, sf_dir):
    b = market.with_row_vwap(fx.bars(spark, sf_dir).drop("VWAP"))
    return rounded(b.select("Date", "Stock", "Category", "VWAP"))


@query("vwap_window", sql=f"""
WITH {TICKS}
SELECT Date, Stock, Category, l_orderkey, l_linenumber, {r4('Price')} AS Price,
       {r4('sum(Price * Quantity) OVER (PARTITION BY Date, Stock) / sum(Quantity) OVER (PARTITION BY Date, Stock)')} AS VWAP
FROM ticks""")
def q_vwap_window(spark, sf_dir):
    t = market.vwap_window(fx.ticks(spark, sf_dir))
    return rounded(t.select("Date", "Stock", "Category", "l_orderkey", "l_linenumber", "Price", "VWAP"))


@query("sector_avg_price", sql=f"""
WITH {BARS}
SELECT Date, Category, {r4('avg((Open + High + Low + Close) / 4.0)')} AS Sector_Average_Price
FROM bars GROUP BY 1, 2""")
def q_sector_avg_price(spark, sf_dir):
    return rounded(market.sector_avg_price(fx.bars(spark, sf_dir)))


@query("category_rank", sql=f"""
WITH {BARS},
s AS (SELECT Date, Category, avg((Open + High + Low + Close) / 4.0) AS Sector_Average_Price FROM bars GROUP BY 1, 2)
SELECT Date, Category, {r4('Sector_Average_Price')} AS Sector_Average_Price,
       CAST(rank() OVER (PARTITION BY Category ORDER BY Category) AS INTEGER) AS Category_Rank,
       CAST(rank() OVER (PARTITION BY Date ORDER BY Sector_Average_Price DESC) AS INTEGER) AS Category_Value_Rank
FROM s""")
def q_category_rank(spark, sf_dir):
    s = market.sector_avg_price(fx.bars(spark, sf_dir))
    s = market.category_rank_by_value(market.category_rank(s))
    return rounded(s)


@query("date_rank", sql=f"""
WITH {BARS},
s AS (SELECT Date, Category, avg((Open + High + Low + Close) / 4.0) AS Sector_Average_Price FROM bars GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY Category ORDER BY Date) AS Date_Rank FROM s)
SELECT Date, Category, {r4('Sector_Average_Price')} AS Sector_Average_Price,
       CAST(Date_Rank AS INTEGER) AS Date_Rank,
       {r4('(Date_Rank - (SELECT min(Date_Rank) FROM r)) / CAST((SELECT max(Date_Rank) FROM r) - (SELECT min(Date_Rank) FROM r) AS DOUBLE)')} AS Normalized_Date_Rank
FROM r""")
def q_date_rank(spark, sf_dir):
    s = market.date_rank(market.sector_avg_price(fx.bars(spark, sf_dir)))
    s = normalize.normalize_column(s, "Date_Rank", "Normalized_Date_Rank")
    return rounded(s)


@query("rank_rows", sql=f"""
WITH {BARS},
s AS (SELECT Date, Category, avg(VWAP) AS Sector_VWAP FROM bars GROUP BY 1, 2)
SELECT Date, Category, {r4('Sector_VWAP')} AS Sector_VWAP,
       CAST(row_number() OVER (PARTITION BY Category ORDER BY Date) AS INTEGER) AS Rank
FROM s""")
def q_rank_rows(spark, sf_dir):
    return rounded(market.row_rank(market.sector_vwap(fx.daily_vwap(spark, sf_dir))))


@query("minmax_normalize", sql=f"""
WITH {BARS},
s AS (SELECT Date, Category, avg(VWAP) AS Sector_VWAP FROM bars GROUP BY 1, 2)
SELECT Date, Category, {r4('Sector_VWAP')} AS Sector_VWAP,
       {r4('(Sector_VWAP - (SELECT min(Sector_VWAP) FROM s)) / ((SELECT max(Sector_VWAP) FROM s) - (SELECT min(Sector_VWAP) FROM s))')} AS Normalized_Sector_VWAP
FROM s""")
def q_minmax_normalize(spark, sf_dir):
    s = market.sector_vwap(fx.daily_vwap(spark, sf_dir))
    return rounded(normalize.normalize_column(s, "Sector_VWAP", "Normalized_Sector_VWAP"))
