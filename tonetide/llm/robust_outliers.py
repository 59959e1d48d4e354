"""Quality rules by robust multivariate outliers of text statistics, per language and source.

Each document gets a vector of transformed statistics (log length, log word length, square roots of
the shares of symbols, repeated lines, repeated windows, capitals and punctuation). For each cell of
language and source the minimum-covariance-determinant estimate of centre and scatter is found by
concentration steps: take the ``h`` share of rows that are nearest by the present estimate, estimate
again from them, repeat until all estimates stand still; then re-weight once. Documents beyond a chi-square quantile of the squared
Mahalanobis distance are rejected.

No cell is ever gathered: a step reads all rows, gives each a distance bin, and sums counts, vectors
and products for each (cell, bin) with map-side combining. A cell then has at most a few hundred
bins, from which the nearest ``h`` share (rounded up to a whole bin) is summed. A source that holds a
third of all rows costs no more per task than any other.

Defined results:
* null text, no words: all statistics 0, base rule failed, not kept;
* null language or source: a cell of its own, like any other value;
* cells under ``min_rows`` fitted rows are pooled by language, small languages into one pool; a pool
  that is still too small to fit keeps all rows that pass the base rules;
* scatter is never below ``FLOORS`` in any direction (larger scatter is left as it is), so a cell of copies or of constant statistics doesn't reject
  rows that differ from them by a trifle;
* repeated rows count as often as they occur; an empty table gives an empty result; columns of the
  input that share a name with a statistic are not read.
"""

from __future__ import annotations

import math
import statistics

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import cut_lineage
from .sizes import counted_side
from .spans import word_windows

SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
PUNCTUATION = b"!\"'(),-./:;?@[\\]^_`{}~"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_punctuation"]

# Least standard deviation of each transformed statistic, in the order of ``vector()``. Repeats vary
# most in short texts, where one line that occurs twice is no sign of junk; mostly repeated lines still reach the limit.
FLOORS = [0.5, 0.05, 0.05, 0.18, 0.18, 0.05, 0.1]
DIM = len(FLOORS)
BINS_PER_OCTAVE = 16
SETTLED = 0.025  # the nearest share is rounded to whole bins, which moves an estimate by up to 2 % to and fro


# ---- statistics of one text -----------------------------------------------------------------

def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of ``size`` words that occurs twice or more in the text."""
    windows = word_windows(words, size)
    if not len(windows):
        return 0
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(counts[which] > 1)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def text_stats(text: str | None) -> tuple[int, ...]:
    """Values of ``STATS``. bytes.split() and strip() know just the six ASCII blanks."""
    raw = (text or "").encode()
    words = raw.split()
    blanks = len(raw) - sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    without = [len(raw) - len(raw.translate(None, c)) for c in (SYMBOLS, CAPITALS, PUNCTUATION)]
    return (len(words), len(text or "") - blanks, without[0], len(lines) - len(set(lines)), repeated_words(words),
            len(lines), without[1], without[2])


def with_stats(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of each document and its statistics (names starting with ``_q_``)."""
    keep = docs.columns if keep is None else keep
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(f"_q_{s}", T.LongType()) for s in STATS])
    rows = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text_col}`"].alias("_q_text"))

    def add(batches):
        for batch in batches:
            found = [text_stats(t) for t in batch.column(len(keep)).to_pylist()]
            stats = [pa.array([f[k] for f in found], pa.int64()) for k in range(len(STATS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *stats], schema.names)

    return rows.mapInArrow(add, schema)


# ---- rules and vectors as columns -----------------------------------------------------------

def stat(name: str) -> Column:
    return F.col(f"_q_{name}")


def base_failed(min_words: int = 50, repeat_percent: int = 50) -> Column:
    return (stat("n_words") < min_words) | (100 * stat("n_repeat_words") > repeat_percent * stat("n_words"))


def vector() -> list[Column]:
    words = F.greatest(stat("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(stat("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(stat("n_lines"), F.lit(1)).cast("double")
    return [F.log(words), F.log(chars / words), F.sqrt(stat("n_symbols") / words), F.sqrt(stat("n_dup_lines") / lines),
            F.sqrt(stat("n_repeat_words") / words), F.sqrt(stat("n_capitals") / chars), F.sqrt(stat("n_punctuation") / words)]


def squared_distance(x: list[Column]) -> Column:
    """|L (x - m)|^2 with ``_m`` and the rows of the lower triangle ``_l`` as array columns."""
    diff = [c - F.col("_m")[i] for i, c in enumerate(x)]
    total, at = F.lit(0.0), 0
    for i in range(DIM):
        z = sum((F.col("_l")[at + j] * diff[j] for j in range(1, i + 1)), F.col("_l")[at] * diff[0])
        total, at = total + z * z, at + i + 1
    return total


# ---- estimates ------------------------------------------------------------------------------

def chi_square_quantile(q: float, dim: int = DIM) -> float:
    """Wilson and Hilferty's approximation."""
    return dim * (1 - 2 / (9 * dim) + statistics.NormalDist().inv_cdf(q) * math.sqrt(2 / (9 * dim))) ** 3


EST = T.StructType([T.StructField("_cell", T.StringType()), T.StructField("_m", T.ArrayType(T.DoubleType())),
                    T.StructField("_l", T.ArrayType(T.DoubleType()))])
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]


def estimate_row(cell, mean: np.ndarray, cov: np.ndarray) -> pd.DataFrame:
    """Centre and the whitening triangle. In units of the floors, eigenvalues below 1 are raised to 1."""
    unit = np.asarray(FLOORS)
    values, axes = np.linalg.eigh(cov / np.outer(unit, unit))  # rounding can leave tiny negative values
    cov = (axes * np.maximum(values, 1.0)) @ axes.T * np.outer(unit, unit)
    white = np.linalg.inv(np.linalg.cholesky(cov))
    return pd.DataFrame({"_cell": [cell], "_m": [mean.tolist()], "_l": [[white[i, j] for i, j in PAIRS]]})


def start_of(cells: pd.DataFrame) -> pd.DataFrame:
    """From the histograms of a cell's statistics: medians and quartile ranges, no correlations."""
    mean, sd = np.zeros(DIM), np.zeros(DIM)
    for k, own in cells.sort_values("bin").groupby("k"):
        upto = own["n"].cumsum().to_numpy() / own["n"].sum()
        q1, q2, q3 = (own["bin"].to_numpy()[np.searchsorted(upto, q)] * HISTOGRAM_STEP for q in (0.25, 0.5, 0.75))
        mean[k], sd[k] = q2, (q3 - q1) / 1.349
    return estimate_row(cells["_cell"].iloc[0], mean, np.diag(sd ** 2))


HISTOGRAM_STEP = 0.01
BROADCAST_CELLS = 20_000  # estimates are some 400 bytes each


def start(rows: DataFrame) -> DataFrame:
    values = rows.select("_cell", F.posexplode(F.col("_x")).alias("k", "v"))
    bins = values.groupBy("_cell", "k", F.floor(F.col("v") / HISTOGRAM_STEP).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return bins.groupBy("_cell").applyInPandas(start_of, EST)


def next_estimate(rows: DataFrame, est: DataFrame, share: float | None) -> DataFrame:
    """One concentration step over the nearest ``share`` of each cell; None: the re-weighting step."""
    x = [F.col("_x")[i] for i in range(DIM)]
    d2 = squared_distance(x)
    binned = rows.join(counted_side(est, BROADCAST_CELLS), "_cell").select(
        "_cell", "_x", F.floor(F.log2(F.greatest(d2, F.lit(1e-6))) * BINS_PER_OCTAVE).alias("bin"))
    sums = binned.groupBy("_cell", "bin").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(DIM)],
        *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in PAIRS])
    median = chi_square_quantile(0.5)
    near = chi_square_quantile(0.975)

    def step(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("bin")
        upto = cells["n"].cumsum().to_numpy()
        if share is None:  # all rows near by the present estimate, scaled to the median distance
            half = 2 ** ((cells["bin"].to_numpy()[np.searchsorted(upto, upto[-1] / 2)] + 0.5) / BINS_PER_OCTAVE)
            used = 2 ** (cells["bin"].to_numpy() / BINS_PER_OCTAVE) <= near * max(half / median, 1e-9)
            used[: np.searchsorted(upto, upto[-1] / 2) + 1] = True
        else:
            used = np.arange(len(cells)) <= np.searchsorted(upto, share * upto[-1])
        total = cells[used].sum(numeric_only=True)
        mean = np.array([total[f"s{i}"] for i in range(DIM)]) / total["n"]
        cov = np.zeros((DIM, DIM))
        for i, j in PAIRS:
            cov[i, j] = cov[j, i] = total[f"p{i}_{j}"] / total["n"] - mean[i] * mean[j]
        return estimate_row(cells["_cell"].iloc[0], mean, cov)

    return sums.groupBy("_cell").applyInPandas(step, EST)


def settled(before: DataFrame, after: DataFrame) -> bool:
    """No cell's centre or whitening moved by more than ``SETTLED`` of its spread."""
    old, new = before.toDF("_cell", "_m0", "_l0"), after.select("_cell", "_m", "_l")
    white = [F.col("_l0")[k] for k in range(len(PAIRS))]
    shift = [F.abs(sum((white[k] * (F.col("_m")[j] - F.col("_m0")[j]) for k, (r, j) in enumerate(PAIRS) if r == i), F.lit(0.0)))
             for i in range(DIM)]
    turn = [F.abs(F.col("_l")[k] - white[k]) / F.greatest(F.abs(white[PAIRS.index((i, i))]), F.lit(1e-9)) for k, (i, _) in enumerate(PAIRS)]
    moved = old.join(counted_side(new, BROADCAST_CELLS), "_cell").agg(F.max(F.greatest(*shift, *turn)).alias("d")).collect()[0].d
    return moved is None or moved < SETTLED


def cell_names(lang: str, source: str) -> tuple[Column, Column]:
    """Names of a row's language and of its language and source; null is a value of its own."""
    one, other = (F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in (lang, source))
    return one, F.concat(one, F.lit("\x1f"), other)


def cells_of(fitted: DataFrame, min_rows: int) -> DataFrame:
    """(_fine, _cell): the cell of each language and source; small ones share a pool.

    One row for each pair of language and source.
    """
    counts = fitted.groupBy("_coarse", "_fine").agg(F.count(F.lit(1)).alias("n"))
    small = counts.where(F.col("n") < min_rows)
    pools = small.groupBy("_coarse").agg(F.sum("n").alias("pool"))
    return counts.join(pools, "_coarse", "left").select(
        "_fine", F.when(F.col("n") >= min_rows, F.col("_fine")).when(F.col("pool") >= min_rows, F.col("_coarse"))
        .otherwise(F.lit("*")).alias("_cell"))


def fit(stats: DataFrame, lang: str = "lang", source: str = "source", share: float = 0.75, steps: int = 20,
        min_rows: int = 300) -> DataFrame:
    """(_fine, _m, _l): the estimate that holds for each language and source."""
    coarse, fine = cell_names(lang, source)
    fitted = cut_lineage(stats.where(~base_failed()).select(
        coarse.alias("_coarse"), fine.alias("_fine"), F.array(*vector()).alias("_x")))
    cells = cut_lineage(cells_of(fitted, min_rows))
    rows = fitted.join(counted_side(cells, BROADCAST_CELLS), "_fine").select("_cell", "_x")
    est = cut_lineage(start(rows))
    for _ in range(steps):
        before, est = est, cut_lineage(next_estimate(rows, est, share))
        if settled(before, est):
            break
    est = cut_lineage(next_estimate(rows, est, None))
    sizes = rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 5 * DIM)
    return cut_lineage(cells.join(est, "_cell").join(sizes, "_cell").select("_fine", "_m", "_l"))


def judged(stats: DataFrame, est: DataFrame, lang: str = "lang", source: str = "source", quantile: float = 0.999999) -> DataFrame:
    """``stats`` with ``_q_failed``, ``_q_distance`` (null where nothing could be fitted) and ``_q_kept``."""
    _, fine = cell_names(lang, source)
    far = squared_distance([F.col("_x")[i] for i in range(DIM)])
    return (stats.withColumns({"_fine": fine, "_x": F.array(*vector())})
            .join(counted_side(est, BROADCAST_CELLS), "_fine", "left")
            .withColumn("_q_failed", base_failed())
            .withColumn("_q_distance", far)
            .withColumn("_q_kept", ~F.col("_q_failed") & F.coalesce(
                F.col("_q_distance") <= chi_square_quantile(quantile), F.lit(True)))
            .drop("_fine", "_x", "_m", "_l"))


def quality_report(docs: DataFrame, id_col: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """Statistics and verdict of every document."""
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), "text")
    stats = cut_lineage(with_stats(ids, keep=["doc_id", "lang", "source"]))
    verdict = judged(stats, fit(stats))
    return verdict.select("doc_id", *[stat(s).alias(s) for s in STATS], F.col("_q_failed").alias("base_failed"),
                          F.col("_q_distance").alias("distance"), F.col("_q_kept").alias("kept"))


def keep_good(docs: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that are kept, with their own columns.

    The texts are read twice (statistics, then verdicts) rather than shuffled or stored.
    """
    est = fit(with_stats(docs, keep=[lang, source]), lang, source)
    return judged(with_stats(docs), est, lang, source).where("_q_kept").select(*[F.col(f"`{c}`") for c in docs.columns])
