"""Small inputs with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import random

from pyspark.sql import functions as F

WORDS = [a + b for a in "ba de fi go ku la me ni po ru sa ti vo wu ye zé".split() for b in "ran lin tor mes kul dap vé".split()]


def words(seed, n):
    rnd = random.Random(seed)
    return [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n)]


def prose(seed, n):
    out = words(seed, n)
    return "".join(w + (".\n" if i % 11 == 10 else " ") for i, w in enumerate(out)).strip()


def edge_rows():
    """(doc_id, text, lang, source)"""
    base = words(1, 120)
    near = base[:]
    near[60] = "changed"
    half = base[:60] + words(2, 60)
    passage = " ".join(words(3, 60))
    rows = [
        (10, " ".join(base), "en", "a"),
        (11, " ".join(near), "en", "a"),
        (12, " ".join(half), "en", "b"),
        (13, " ".join(base), "en", "b"),  # exact copy
        (14, " ".join(base).upper(), "en", None),  # copy but for case
        (14, " ".join(base).upper(), "en", None),  # repeated row
        (15, "", "en", "a"),
        (16, None, "en", "a"),
        (17, " \n\t ", None, "a"),
        (18, "one two", "en", "a"),
        (19, "one  two", "en", "a"),  # the same words
        (20, "lone", "en", "a"),
        (21, prose(4, 300) + " " + passage, "fr", "c"),
        (22, passage + " " + prose(5, 200), "fr", "c"),
        (23, prose(6, 80) + " " + passage + " " + prose(7, 90), "fr", "c"),
        (24, "ab " * 400, "en", "a"),
        (25, "ÄÖÜ é漢字 😀 don't can't x1y22 <|endoftext|> — “q” ΣΑΣ İ", "de", "d"),
        (26, prose(8, 6000), "de", "d"),  # long
        (27, "same line\nsame line\nsame line\n\n\nother", "de", "d"),
        (None, prose(9, 60), "en", "a"),
        (30, "x" * 250, "en", "a"),
        (31, "\x00nul \x1c fs\x0bvt\x0cff", "en", "a"),
    ]
    for k in range(12):  # a group of near copies of one base, each with changes of its own
        own = words(50, 150)
        own[10 + 9 * k] = f"mutant{k}"
        rows.append((100 + k, " ".join(own), "en", "hot"))
    rows += [(200 + k, prose(300 + k, 70 + k), "en", "hot") for k in range(20)]
    return rows


def documents(spark, rows=None):
    rows = edge_rows() if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    # Names that operators use inside, and the table's own count.
    return df.select("*", F.length("text").cast("long").alias("n_chars"), F.lit(7).alias("n"), F.lit("x").alias("id"),
                     F.lit(1).alias("size"), F.lit(2).alias("start"), F.lit("t").alias("token"), F.lit(3).alias("kept"))


def empty(spark):
    return documents(spark, [])
