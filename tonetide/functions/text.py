"""Text expressions, all native Spark SQL functions.

The reference ran three row-at-a-time Python UDFs (clean, polarity,
subjectivity). Here cleaning is a chain of regexp/array expressions and the
word-level lookups (contractions, lemmas, lexicon) are map lookups inside
``transform``/``filter``/``aggregate``: no Python worker, no shuffle, whole
texts processed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col_

# Fixed values of the cleaning chain: whole-token contraction expansions (matched
# before lower-casing), the URL pattern removed first, the characters kept.
CONTRACTIONS = {"can't": "cannot", "won't": "will not"}
# Blanks are Unicode's, as in the reference's patterns; the escapes mean the same in Java and RE2.
BLANK = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANKS = f"[{BLANK}]+"
EDGE_BLANKS = f"^{BLANKS}|{BLANKS}$"
URL_PATTERN = f"http[^{BLANK}]+"
KEEP_PATTERN = r"[^a-zA-Z' ]"

# This library's tokeniser for lexicon scoring: runs of letters (of any script) and apostrophes.
SENTIMENT_TOKEN_SPLIT = r"[^\p{L}']+"


def map_literal(d: dict) -> Column:
    """A MAP literal built from a small fixed dictionary."""
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def lookup_or_keep(tokens: Column, table: dict) -> Column:
    m = map_literal(table)
    return F.transform(tokens, lambda t: F.coalesce(F.try_element_at(m, t), t))


def headline_description(headline="headline", description="short_description") -> Column:
    """``concat_ws(' ', headline, short_description)``: nulls skipped, empty kept."""
    return F.concat_ws(" ", col_(headline), col_(description))


def whitespace_tokens(c) -> Column:
    """Python ``str.split()``: split on whitespace runs, no empty edge tokens."""
    stripped = F.regexp_replace(col_(c), EDGE_BLANKS, "")
    return F.filter(F.split(stripped, BLANKS), lambda t: t != F.lit(""))


def clean_text(c, lemmas: dict | None = None, contractions: dict | None = None) -> Column:
    """URL strip -> contraction expansion -> keep letters/'/space -> lower ->
    collapse whitespace -> (optional) lemma lookup per token."""
    contractions = CONTRACTIONS if contractions is None else contractions
    t = F.regexp_replace(col_(c), URL_PATTERN, "")
    t = F.array_join(lookup_or_keep(whitespace_tokens(t), contractions), " ")
    t = F.regexp_replace(t, KEEP_PATTERN, "")
    t = F.lower(t)
    t = F.trim(F.regexp_replace(t, BLANKS, " "))
    if lemmas:
        t = F.array_join(lookup_or_keep(F.split(t, " "), lemmas), " ")
    return t


def sentiment_tokens(c) -> Column:
    """Lower-cased word tokens of the raw text (empty tokens removed)."""
    toks = F.split(F.lower(col_(c)), SENTIMENT_TOKEN_SPLIT)
    return F.filter(toks, lambda t: t != F.lit(""))


def lexicon_mean(tokens: Column, scores: dict) -> Column:
    """Mean score over tokens found in ``scores``; 0.0 when none matches."""
    m = map_literal(scores)
    hits = F.filter(F.transform(tokens, lambda t: F.try_element_at(m, t)), lambda x: x.isNotNull())
    total = F.aggregate(hits, F.lit(0.0), lambda acc, x: acc + x)
    return F.coalesce(F.try_divide(total, F.size(hits).cast("double")), F.lit(0.0))
