"""Text and sentiment queries (S4, F1, F2, X2-X10, A1, A2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import ISO_DATE_PATTERN
from ..functions.text import (BLANKS, CONTRACTIONS, EDGE_BLANKS, KEEP_PATTERN, SENTIMENT_TOKEN_SPLIT, URL_PATTERN,
                              whitespace_tokens)
from ..operators import market, sentiment as st
from ..sources import fixtures as fx
from .catalog import query, rounded
from .sqlviews import NEWS, r4


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(var: str, table: dict) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table.items())
    return f"CASE {var} {whens} ELSE {var} END"


LEX_SQL = "lex AS (SELECT word, CAST(p AS DOUBLE) AS polarity, CAST(s AS DOUBLE) AS subjectivity FROM (VALUES " + ", ".join(
    f"({_q(w)}, {p}, {s})" for w, (p, s) in st.LEXICON.items()) + ") t(word, p, s))"


def clean_sql(x: str, lemmas: dict | None = None) -> str:
    t = f"regexp_replace({x}, {_q(URL_PATTERN)}, '', 'g')"
    t = f"regexp_replace({t}, {_q(EDGE_BLANKS)}, '', 'g')"
    t = (f"array_to_string(list_transform(list_filter(string_split_regex({t}, {_q(BLANKS)}), lambda w: w <> ''), "
         f"lambda w: {_case('w', CONTRACTIONS)}), ' ')")
    t = f"regexp_replace({t}, {_q(KEEP_PATTERN)}, '', 'g')"
    t = f"lower({t})"
    t = f"trim(regexp_replace({t}, {_q(BLANKS)}, ' ', 'g'))"
    if lemmas:
        t = f"array_to_string(list_transform(string_split({t}, ' '), lambda w: {_case('w', lemmas)}), ' ')"
    return t


VALID = f"regexp_matches(date, {_q(ISO_DATE_PATTERN)}) AND try_strptime(date, '%Y-%m-%d') IS NOT NULL"
BASE_SQL = f"""{NEWS},
base AS (SELECT *, concat_ws(' ', headline, short_description) AS hd FROM news WHERE {VALID}),
{LEX_SQL},
tok AS (SELECT doc_id, unnest(string_split_regex(lower(hd), '{SENTIMENT_TOKEN_SPLIT.replace("'", "''")}')) AS word FROM base),
hits AS (SELECT doc_id, avg(polarity) AS s, avg(subjectivity) AS j FROM tok JOIN lex USING (word) GROUP BY doc_id),
scored AS (SELECT b.*, coalesce(h.s, 0.0) AS sentiment, coalesce(h.j, 0.0) AS subjectivity
           FROM base b LEFT JOIN hits h USING (doc_id))"""

DAILY_SQL = f"""{BASE_SQL},
daily AS (SELECT date, lower(category) AS category, avg(sentiment) AS avg_sentiment,
                 avg(subjectivity) AS avg_subjectivity, count(*) AS articles_count
          FROM scored GROUP BY 1, 2)"""


def daily_df(spark, sf_dir):
    return st.daily_sentiment(st.news_scored(fx.news(spark, sf_dir)))


@query("news_source", sql=f"WITH {NEWS} SELECT * FROM news")
def q_news_source(spark, sf_dir):
    return fx.news(spark, sf_dir)


@query("filter_valid_date", sql=f"WITH {NEWS} SELECT doc_id, date, category FROM news WHERE {VALID}")
def q_filter_valid_date(spark, sf_dir):
    return st.valid_dates(fx.news(spark, sf_dir)).select("doc_id", "date", "category")


@query("clean_text", sql=f"""
WITH {NEWS}
SELECT doc_id, concat_ws(' ', headline, short_description) AS headline_description,
       {clean_sql("concat_ws(' ', headline, short_description)")} AS cleaned_text
FROM news""")
def q_clean_text(spark, sf_dir):
    df = st.with_clean_text(st.with_text(fx.news(spark, sf_dir)))
    return df.select("doc_id", "headline_description", "cleaned_text")


@query("lemmatize", sql=f"""
WITH {NEWS}
SELECT doc_id, {clean_sql("concat_ws(' ', headline, short_description)", st.LEMMAS)} AS cleaned_text
FROM news""")
def q_lemmatize(spark, sf_dir):
    df = st.with_clean_text(st.with_text(fx.news(spark, sf_dir)), lemmas=st.LEMMAS)
    return df.select("doc_id", "cleaned_text")


@query("lemmatize_join", sql=f"""
WITH {NEWS}
SELECT doc_id, {clean_sql("concat_ws(' ', headline, short_description)", st.LEMMAS)} AS cleaned_text
FROM news""")
def q_lemmatize_join(spark, sf_dir):
    """Lemma table joined to the position-exploded tokens, text rebuilt in order."""
    df = st.with_clean_text(st.with_text(fx.news(spark, sf_dir)))
    out = st.lemmatize_join(df.select("doc_id", "cleaned_text"), st.lemma_frame(spark), "cleaned_text")
    return out.select("doc_id", "cleaned_text")


@query("tokenize", sql=f"""
WITH {NEWS},
t AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(concat_ws(' ', headline, short_description),
                                                       {_q(EDGE_BLANKS)}, '', 'g'), {_q(BLANKS)}), lambda w: w <> '') AS toks FROM news)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, toks[i] AS token
FROM t, LATERAL (SELECT unnest(generate_series(1, len(toks))) AS i)""")
def q_tokenize(spark, sf_dir):
    df = st.with_text(fx.news(spark, sf_dir))
    return df.select("doc_id", F.posexplode(whitespace_tokens("headline_description")).alias("pos", "token"))


@query("lexicon_sentiment", sql=f"""
WITH {BASE_SQL}
SELECT doc_id, {r4('sentiment')} AS sentiment, {r4('subjectivity')} AS subjectivity FROM scored""")
def q_lexicon_sentiment(spark, sf_dir):
    return rounded(st.news_scored(fx.news(spark, sf_dir)).select("doc_id", "sentiment", "subjectivity"))


@query("lexicon_sentiment_join", sql=f"""
WITH {BASE_SQL}
SELECT doc_id, {r4('sentiment')} AS sentiment, {r4('subjectivity')} AS subjectivity FROM scored""")
def q_lexicon_sentiment_join(spark, sf_dir):
    """Lexicon supplied as a table (here: the fixture lexicon written as one)."""
    lex = st.lexicon_frame(spark)
    base = st.with_text(st.valid_dates(fx.news(spark, sf_dir)))
    out = st.score_text_join(base, lex)
    return rounded(out.select("doc_id", "sentiment", "subjectivity"))


@query("lexicon_sentiment_map", sql=f"""
WITH {BASE_SQL}
SELECT doc_id, {r4('sentiment')} AS sentiment, {r4('subjectivity')} AS subjectivity FROM scored""")
def q_lexicon_sentiment_map(spark, sf_dir):
    """Small fixed lexicon inlined as MAP literals: row-local, no join."""
    base = st.with_text(st.valid_dates(fx.news(spark, sf_dir)))
    return rounded(st.score_text(base).select("doc_id", "sentiment", "subjectivity"))


@query("daily_sentiment", sql=f"""
WITH {DAILY_SQL}
SELECT date, category, {r4('avg_sentiment')} AS avg_sentiment, {r4('avg_subjectivity')} AS avg_subjectivity,
       articles_count FROM daily""")
def q_daily_sentiment(spark, sf_dir):
    return rounded(daily_df(spark, sf_dir))


@query("filter_sector", sql=f"""
WITH {DAILY_SQL}
SELECT date, category, {r4('avg_sentiment')} AS avg_sentiment, {r4('avg_subjectivity')} AS avg_subjectivity,
       articles_count FROM daily WHERE category = 'asia'""")
def q_filter_sector(spark, sf_dir):
    return rounded(daily_df(spark, sf_dir).where(F.col("category") == "asia"))


@query("avg_of_avgs", sql=f"""
WITH {BASE_SQL},
per_source AS (SELECT CAST(date AS DATE) AS Date, upper(category) AS Category, source,
                      avg(sentiment) AS avg_sentiment, avg(subjectivity) AS avg_subjectivity,
                      count(*) AS articles_count
               FROM scored GROUP BY 1, 2, 3),
a AS (SELECT Date, Category, avg(avg_sentiment) AS avg_sentiment, avg(avg_subjectivity) AS avg_subjectivity,
             avg(articles_count) AS avg_articles_count FROM per_source GROUP BY 1, 2)
SELECT Date, Category, {r4('avg_sentiment')} AS avg_sentiment, {r4('avg_subjectivity')} AS avg_subjectivity,
       {r4('avg_articles_count')} AS avg_articles_count,
       CAST(row_number() OVER (PARTITION BY Category ORDER BY Date) AS INTEGER) AS Rank
FROM a""")
def q_avg_of_avgs(spark, sf_dir):
    scored = st.news_scored(fx.news(spark, sf_dir))
    per_source = scored.groupBy(
        F.to_date("date").alias("Date"), F.upper("category").alias("Category"), "source"
    ).agg(F.avg("sentiment").alias("avg_sentiment"), F.avg("subjectivity").alias("avg_subjectivity"),
          F.count(F.lit(1)).alias("articles_count"))
    out = market.row_rank(st.avg_of_avgs(per_source), "Category", "Date", "Rank")
    return rounded(out)
