"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

Every benchmark item is cut into windows of ``window`` consecutive words; a document is hit wherever one
of them occurs word for word. The tokens of a text are its two-word shingles (as 64-bit hashes; the
hash only finds candidates). A window must be contained whole, so its necessary prefix is one token
in the global order, and

1. the documents' counts of the benchmark's own shingles are taken (combined map-side, one row for
   each shingle of the benchmark) and give the order, rarest first;
2. each window keeps its rarest shingle and that shingle's offset;
3. document shingles are joined with those prefix tokens. A match puts the window at one place only
   (position - offset); the length bound drops it when it would start or end outside the text;
4. the words at that place are compared with the window's words, exactly.

Windows of one word (items of one word) take the word itself as their token, in a join of their own.

The windows of the benchmark are written to the shared folder and counted. Up to ``broadcast_rows`` of
them are broadcast (a window is at most ``window`` words), and a match is verified beside the document
it is in. Beyond that, narrow (document, position, token) rows are joined by sort and merge, and only
documents with candidates meet their words again. Both ways give the same rows.

Defined results:
* null text, or none but separators: no words; n_words 0, n_hit 0, not contaminated;
* items without words match nothing; repeated items each count; null item ids match but aren't listed;
* repeated documents (same id): they are counted one by one, as long as their texts differ they keep
  their own rows; equal rows get equal results;
* empty tables: no rows, or all rows clean; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..config import scratch_path

# Runs of these characters separate words: all of ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def row_name(id_col: str, text_col: str) -> Column:
    return F.struct(F.col(id_col).cast("string").alias("id"), F.xxhash64(text_col).alias("h"), F.octet_length(text_col).alias("n"))


def words_of(text: str | Column) -> Column:
    """Words in order, A-Z lower-cased and no other letter changed; null has none."""
    whole = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(whole) == F.length(whole)  # there lower() does the same and is faster
    plain = F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    return F.filter(F.split(plain, SEPARATORS), lambda w: w != "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a small build side to the shared folder and read it back, with its size known."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """(item_id, words) of each window: ``window`` consecutive words, or all of a shorter item."""
    n = F.size("w")
    starts = F.sequence(F.lit(1), F.greatest(n - F.lit(window) + 1, F.lit(1)))
    return (items.where(n > 0).select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.slice("w", F.col("s"), window).alias("words")))


def tokens_of(words: str, size: int) -> Column:
    """Hashes of the runs of ``size`` (1 or 2) words, in order."""
    w = F.col(words)
    if size == 1:
        return F.transform(w, lambda a: F.xxhash64(a))
    pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    return F.slice(pairs, 1, F.greatest(F.size(w) - 1, F.lit(0)))


def document_counts(docs: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """(token, n): how often the documents hold each token of the windows."""
    used = windows.select(F.explode(tokens_of("words", size)).alias("token")).distinct()
    return (docs.select(F.explode(tokens_of("w", size)).alias("token")).join(used, "token")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


def with_prefix(windows: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """(window_id, words, token, offset): the rarest token of each distinct window and its offset."""
    places = windows.select("window_id", "words").distinct().select(
        "window_id", "words", F.posexplode(tokens_of("words", size)).alias("at", "token"))
    ranked = places.join(counts, "token", "left").groupBy("window_id", "words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at")).alias("rarest"))
    return ranked.select("window_id", "words", F.col("rarest.token").alias("token"), F.col("rarest.at").alias("offset"))


def matches(docs: DataFrame, prefixes: DataFrame, size: int, broadcast: bool) -> DataFrame:
    """(_row, start, end, window_id) of each place in a document where a window occurs."""
    start, end = F.col("pos") - F.col("offset"), F.col("pos") - F.col("offset") + F.size("words")
    inside = (start >= 0) & (end <= F.col("n"))
    same = F.slice("w", start + 1, F.size("words")) == F.col("words")
    out = ["_row", start.alias("start"), end.alias("end"), "window_id"]
    n = F.size("w").alias("n")
    tokens = F.posexplode(tokens_of("w", size)).alias("pos", "token")
    if broadcast:
        return docs.select("_row", "w", n, tokens).join(F.broadcast(prefixes), "token").where(inside & same).select(*out)
    candidates = docs.select("_row", n, tokens).join(prefixes, "token").where(inside).drop("n")
    return candidates.join(docs, "_row").where(same).select(*out)


def covered(spans: DataFrame) -> DataFrame:
    """(_row, n_hit): words covered by the spans (start, end) of each document.

    Spans of one document meet in a window function; a document has at most as many as it has words.
    """
    earlier = Window.partitionBy("_row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("start"), F.coalesce(F.max("end").over(earlier), F.lit(0)))
    return (spans.withColumn("new", F.greatest(F.col("end") - fresh, F.lit(0)))
            .groupBy("_row").agg(F.sum("new").alias("n_hit")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", broadcast_rows: int = 200_000) -> DataFrame:
    """(doc_id, _row, n_words, n_hit, items) of every document.

    ``items`` are the ids of the items that occur, as sorted strings. ``_row`` names a document by its id
    and its text's checksums, so that equal ids with different texts keep their own rows.
    """
    name = row_name(id_col, text_col)
    rows = docs.select(name.alias("_row"), words_of(F.col(text_col)).alias("w"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), words_of(F.col(item_text)).alias("w"))
    windows = stored(windows_of(items, window).withColumn("window_id", F.xxhash64("words")), "benchmark-windows")

    found = None
    for size, own in ((2, windows.where(F.size("words") > 1)), (1, windows.where(F.size("words") == 1))):
        n_windows = own.count()  # of the benchmark alone
        if n_windows:
            counts = stored(document_counts(rows, own, size), "benchmark-token-counts")
            prefixes = stored(with_prefix(own, counts, size), "benchmark-prefixes")
            part = matches(rows, prefixes, size, n_windows <= broadcast_rows)
            found = part if found is None else found.union(part)
    n_words = F.size(F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), SEPARATORS), lambda w: w != "")).cast("long")
    counted = docs.select(F.col(id_col).alias("doc_id"), name.alias("_row"), n_words.alias("n_words"))
    if found is None:
        return counted.select("*", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    found = stored(found.distinct(), "benchmark-matches")
    listed = (found.select("_row", "window_id").distinct().join(windows.select("window_id", "item_id").distinct(), "window_id")
              .groupBy("_row").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    return (counted.join(covered(found), "_row", "left").join(listed, "_row", "left")
            .select("doc_id", "_row", "n_words", F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents that hold no window of any item, with their own columns."""
    hit = decontaminate(docs, benchmark, window).where("n_hit > 0").select("_row").distinct()
    marked = docs.withColumn("_row", row_name("doc_id", "text"))
    return marked.join(hit, "_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
