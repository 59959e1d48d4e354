"""Headline sentiment.

The lexicon and lemma tables are inputs of this library (the reference used
a third-party library's built-in ones). Two forms:

* a small fixed dictionary -> MAP literal lookups inside the row (no join);
* a lexicon DataFrame -> tokens exploded next to the document's keys and
  left-joined to the lexicon (a table of known size, so Spark plans a broadcast
  while it is small), averaged per document with partial aggregation (shuffle
  volume ~ one row per document and map task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import valid_iso_date
from ..functions.text import (SENTIMENT_TOKEN_SPLIT, clean_text, headline_description, lexicon_mean,
                              sentiment_tokens)

# Fixed values (fixture lexicon, invented scores): word -> (polarity, subjectivity).
LEXICON = {
    "the": (0.1, 0.2),
    "of": (-0.05, 0.1),
    "and": (0.2, 0.3),
    "to": (0.05, 0.1),
    "in": (-0.1, 0.2),
    "is": (0.3, 0.5),
    "that": (-0.2, 0.6),
    "on": (0.15, 0.25),
    "for": (0.25, 0.35),
    "with": (0.4, 0.45),
    "was": (-0.3, 0.55),
    "be": (0.05, 0.65),
    "de": (0.12, 0.22),
    "la": (-0.25, 0.4),
    "le": (0.35, 0.5),
    "que": (-0.4, 0.7),
    "der": (0.22, 0.33),
    "die": (-0.6, 0.8),
    "und": (0.18, 0.28),
    "en": (-0.08, 0.15),
    "good": (0.7, 0.6),
    "bad": (-0.7, 0.67),
}

# Fixed values (fixture lemma table, invented pairs): form -> lemma.
LEMMAS = {
    "ones": "one",
    "thes": "the",
    "eres": "ere",
    "anes": "ane",
    "rees": "ree",
    "ores": "ore",
    "ates": "ate",
    "ines": "ine",
    "les": "le",
    "des": "de",
    "los": "lo",
    "las": "la",
}


def polarity_map(lexicon: dict | None = None) -> dict:
    return {w: float(p) for w, (p, _) in (lexicon or LEXICON).items()}


def subjectivity_map(lexicon: dict | None = None) -> dict:
    return {w: float(s) for w, (_, s) in (lexicon or LEXICON).items()}


def valid_dates(news: DataFrame, col="date") -> DataFrame:
    return news.where(valid_iso_date(col))


def with_text(news: DataFrame, out="headline_description") -> DataFrame:
    return news.withColumn(out, headline_description())


def with_clean_text(df: DataFrame, src="headline_description", out="cleaned_text",
                    lemmas: dict | None = None) -> DataFrame:
    return df.withColumn(out, clean_text(src, lemmas))


def _sql_text(v) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else f"{v}D"


def values_frame(spark, rows, columns: str) -> DataFrame:
    """A small fixed table as SQL VALUES, whose size the planner knows."""
    listed = ", ".join("(" + ", ".join(map(_sql_text, r)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS t({columns})")


def lemma_frame(spark, lemmas: dict | None = None) -> DataFrame:
    return values_frame(spark, (lemmas or LEMMAS).items(), "form, lemma")


def lemmatize_join(df: DataFrame, lemma_df: DataFrame, text_col: str, id_col: str = "doc_id",
                   out: str = "cleaned_text") -> DataFrame:
    """Lemmatise an already cleaned text with a (small) lemma *table* (form, lemma).

    The table becomes one map value (a scalar subquery), looked up inside each row: nothing is
    exploded or shuffled. Unmatched tokens are kept; of several lemmas of a form the smallest counts.
    """
    one = lemma_df.where(F.col("form").isNotNull()).groupBy("form").agg(F.min("lemma").alias("lemma"))
    table = one.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("form", "lemma")))).alias("m")).scalar()
    tokens = F.transform(F.split(F.col(text_col), " "), lambda t: F.coalesce(F.try_element_at(F.col("__lemmas"), t), t))
    return df.withColumn("__lemmas", table).withColumn(out, F.array_join(tokens, " ")).drop("__lemmas")


def score_text(df: DataFrame, text_col="headline_description", lexicon: dict | None = None) -> DataFrame:
    """Add ``sentiment`` and ``subjectivity``: means over lexicon hits (0.0 if none)."""
    toks = sentiment_tokens(text_col)
    return df.withColumns({
        "sentiment": lexicon_mean(toks, polarity_map(lexicon)),
        "subjectivity": lexicon_mean(toks, subjectivity_map(lexicon)),
    })


def lexicon_frame(spark, lexicon: dict | None = None) -> DataFrame:
    """The fixed lexicon as a small DataFrame (word, polarity, subjectivity)."""
    rows = [(w, float(p), float(s)) for w, (p, s) in (lexicon or LEXICON).items()]
    return values_frame(spark, rows, "word, polarity, subjectivity")


def score_docs(df: DataFrame, lexicon_df: DataFrame, keys=("doc_id",), text_col="headline_description",
               id_col: str = "doc_id") -> DataFrame:
    """Per-document ``sentiment`` / ``subjectivity`` with the lexicon as a table.

    One scan: the keys travel with the exploded tokens through one left join and
    one aggregate (partial first), so a document without any lexicon word stays
    and scores 0.0. The text itself is never shuffled.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if id_col not in keys:
        raise ValueError(f"{id_col!r} must be one of the keys {keys}")
    toks = df.select(*keys, F.explode_outer(F.split(F.lower(text_col), SENTIMENT_TOKEN_SPLIT)).alias("word"))
    lex = lexicon_df.select("word", "polarity", "subjectivity")
    means = toks.join(lex, "word", "left").groupBy(*keys).agg(
        F.avg("polarity").alias("sentiment"), F.avg("subjectivity").alias("subjectivity"))
    return means.select(*keys, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("sentiment", "subjectivity")])


def score_text_join(df: DataFrame, lexicon_df: DataFrame, key="doc_id", text_col="headline_description") -> DataFrame:
    """All columns of ``df`` except the text, plus the two scores."""
    keys = [c for c in df.columns if c not in (text_col, "headline", "short_description")]
    return score_docs(df, lexicon_df, keys, text_col, key)


def daily_sentiment(scored: DataFrame, date="date", category="category") -> DataFrame:
    """Mean sentiment/subjectivity and article count by (date, lower(category))."""
    return scored.groupBy(F.col(date).alias("date"), F.lower(category).alias("category")).agg(
        F.avg("sentiment").alias("avg_sentiment"),
        F.avg("subjectivity").alias("avg_subjectivity"),
        F.count(F.lit(1)).alias("articles_count"),
    )


def avg_of_avgs(per_source: DataFrame, date="Date", category="Category") -> DataFrame:
    """Unweighted mean of per-source daily means by (Date, Category)."""
    return per_source.groupBy(date, category).agg(
        F.avg("avg_sentiment").alias("avg_sentiment"),
        F.avg("avg_subjectivity").alias("avg_subjectivity"),
        F.avg("articles_count").alias("avg_articles_count"),
    )


def news_scored(news: DataFrame, lexicon: dict | None = None) -> DataFrame:
    """news -> valid dates -> headline_description -> per-document scores (one lazy plan).

    Output: doc_id, date, category, source, sentiment, subjectivity.
    """
    docs = with_text(valid_dates(news)).select("doc_id", "date", "category", "source", "headline_description")
    return score_docs(docs, lexicon_frame(news.sparkSession, lexicon), ("doc_id", "date", "category", "source"))
