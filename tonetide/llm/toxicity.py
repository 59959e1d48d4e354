"""Toxicity by multiple-instance learning: labels are on documents, evidence is in sentences.

A text is a bag of sentences (they end at ``.``, ``!``, ``?`` or a line end; longer ones are cut every
``MAX_WORDS`` words). A sentence's probability is logistic in the evidence of its distinct words, and a
document's is the noisy-or of its sentences: 1 - prod(1 - p). Only document labels are fitted; the
sentence probabilities that come out of it locate the offending sentences.

Features of a word (a run of letters; A-Z and Latin-1 capitals lower-cased) are hashes of the word, of
its first 3 to 8 and of its last 3 to 6 bytes. A sentence without a feature of the model has probability 0.

``fit`` learns from at most ``train_rows`` labelled documents, those of the smallest hashes of their
ids, so its cost doesn't grow with the corpus. Tasks cut their texts into features; Spark counts each
feature's documents of either label; the ``max_features`` with the largest likelihood ratio (positive
association) are the model's. What reaches the driver is these features' numbers for the sample. ``score``
reads every text whole, in slices of ``SLICE`` words, so memory doesn't follow a text's length.

Results: a null, empty or wordless text scores 0 and has no sentences. Null ids are scored and never
trained on. Several labels of one id: the largest counts, nulls none. Repeated rows are scored each;
in training one text of an id counts (the smallest). Without labels of both kinds there is no model and every
score is 0. An empty table gives an empty result; other columns than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WORDS = 64
SLICE = 200_000  # words whose features are held at a time
PREFIXES = range(3, 9)
SUFFIXES = range(3, 7)
TOP = np.uint64(64 - 20)  # shift that leaves a hash's top bits
STEPS = 300
REPORT = 0.5  # sentences of at least this probability are located


# ---- texts to features (numpy, in tasks) ----------------------------------------------------

def mixed(x: np.ndarray, tag: int) -> np.ndarray:
    """The public splitmix64 finaliser over x, with a tag for the kind of feature."""
    x = x + np.uint64((tag * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).copy()
    raw[(raw >= 65) & (raw <= 90)] += 32
    latin = np.flatnonzero(raw[:-1] == 0xC3) + 1
    latin = latin[(raw[latin] >= 0x80) & (raw[latin] <= 0x9E) & (raw[latin] != 0x97)]
    raw[latin] += 32
    return raw


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, sentence number) of each word; sentence numbers count up, with gaps."""
    letter = np.zeros(len(raw) + 2, np.int8)
    letter[1:-1] = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    turn = np.diff(letter)
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    stops = np.flatnonzero(np.isin(raw, np.frombuffer(b".!?\n", np.uint8)))
    sentence = np.searchsorted(stops, starts)
    if len(starts):
        first = np.concatenate(([True], sentence[1:] != sentence[:-1]))
        begin = np.flatnonzero(first)
        place = np.arange(len(starts)) - np.repeat(begin, np.diff(np.append(begin, len(starts))))
        sentence = np.cumsum(first | (place % MAX_WORDS == 0)) - 1
    return starts, ends, sentence


def word_features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes (one row for each word): the word, its prefixes, its suffixes; 0 where the word is too short."""
    padded = np.concatenate((np.zeros(8, np.uint8), raw, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    size = ends - starts
    head = np.ascontiguousarray(eight[starts + 8]).view("<u8")[:, 0]  # first byte lowest
    tail = np.ascontiguousarray(eight[ends]).view("<u8")[:, 0]  # last byte highest
    out = np.zeros((len(starts), 1 + len(PREFIXES) + len(SUFFIXES)), np.uint64)
    short = np.minimum(size, 8).astype(np.uint64) * np.uint64(8)
    whole = mixed(np.where(size >= 8, head, head & ((np.uint64(1) << np.minimum(short, np.uint64(63))) - np.uint64(1))), 1)
    for k in range(8, int(size.max(initial=0)), 8):  # longer words: eight bytes at a time, the last ones aligned to the end
        more = size > k
        at = np.minimum(starts + k, ends - 8)[more] + 8
        whole[more] = mixed(whole[more] ^ np.ascontiguousarray(eight[at]).view("<u8")[:, 0], 2)
        if k >= 64:
            break  # the length and the first and last bytes tell longer runs apart well enough
    out[:, 0] = mixed(whole + size.astype(np.uint64), 3)
    for j, n in enumerate(PREFIXES):
        fits = size > n
        part = head if n == 8 else head & np.uint64((1 << 8 * n) - 1)
        out[fits, 1 + j] = mixed(part[fits], 100 + n)
    for j, n in enumerate(SUFFIXES):
        fits = size > n
        out[fits, 1 + len(PREFIXES) + j] = mixed(tail[fits] >> np.uint64(64 - 8 * n), 200 + n)
    return out


def top_bits(features: np.ndarray) -> np.ndarray:
    """Which values of the top bits any of the features has."""
    out = np.zeros(1 << 64 - int(TOP), bool)
    out[features >> TOP] = True
    return out


def known_words(raw: np.ndarray, features: np.ndarray, filled: np.ndarray | None = None):
    """Arrays (sentence, place in ``features``), a pair for each known feature of each distinct word of a sentence.

    Sorted by sentence; with them the (start, end, sentence) of all words.
    """
    starts, ends, sentence = words_of(raw)
    found = []
    if filled is None:
        filled = top_bits(features)
    for lo in range(0, len(starts) if len(features) else 0, SLICE):
        hashes = word_features(raw, starts[lo:lo + SLICE], ends[lo:lo + SLICE])
        word = np.flatnonzero(filled[hashes >> TOP].any(axis=1))  # most words stop here
        hashes = hashes[word]
        at = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
        hit = (features[at] == hashes) & (hashes != 0)
        found.append((sentence[lo + word], hashes[:, 0], at, hit))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), (starts, ends, sentence)
    of, word, at, hit = (np.concatenate([f[i] for f in found]) for i in range(4))
    some = hit.any(axis=1)
    of, word, at, hit = of[some], word[some], at[some], hit[some]
    order = np.lexsort((word, of))
    of, word, at, hit = of[order], word[order], at[order], hit[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (word[1:] != word[:-1])
    of, at, hit = of[new], at[new], hit[new]
    return np.repeat(of, hit.sum(axis=1)), at[hit], (starts, ends, sentence)


# ---- the model ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def sentences(self, data: bytes, filled: np.ndarray | None = None) -> list[tuple[int, int, float]]:
        """(start byte, end byte, probability) of the sentences with evidence."""
        of, at, (starts, ends, sentence) = known_words(lowered(data), self.features, filled)
        if not len(of):
            return []
        ids, first = np.unique(of, return_index=True)
        z = np.add.reduceat(self.weights[at], first) + self.bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        lo = starts[np.searchsorted(sentence, ids)]
        hi = ends[np.searchsorted(sentence, ids, side="right") - 1]
        return list(zip(lo.tolist(), hi.tolist(), p.tolist()))


def noisy_or(p) -> float:
    return float(-np.expm1(np.log1p(-np.asarray(p, float)).sum()))


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], size: int, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias from bags (label, sentence of each pair, feature of each pair) by full-batch Adam steps.

    With s = sum over sentences of log(1 - p), a clean document's loss is -s and a toxic one's -log(1 - exp(s)).
    """
    bags = [b for b in bags if len(b[1])]  # bags without a known feature have a fixed score
    if not bags:
        return np.zeros(size), -4.0
    label = np.array([b[0] for b in bags], float)
    feature = np.concatenate([b[2] for b in bags])
    key = np.concatenate([b[1].astype(np.int64) + (i << 32) for i, b in enumerate(bags)])
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    of = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(key))))  # sentence of each pair
    bag = key[cut] >> 32
    first = np.flatnonzero(np.concatenate(([True], bag[1:] != bag[:-1])))
    w = np.zeros(size + 1)
    w[-1] = -4.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = np.clip(np.add.reduceat(w[feature], cut) + w[-1], -30, 30)
        p = 1 / (1 + np.exp(-z))
        s = np.minimum(np.add.reduceat(np.log1p(-p), first), -1e-9)
        pull = np.where(label == 1, -1 / np.expm1(-s), 1.0)  # -d loss / d s of each bag; d s / d z = -p
        dz = pull[bag] * p
        grad = np.append(np.bincount(feature, dz[of], size), dz.sum()) / len(bags) + l2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w = w - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def label_of(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
            .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y")))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, max_features: int = 8192, least: float = 15.0,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Model of the labelled documents: at most ``train_rows``, those whose ids have the smallest hashes."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = label_of(labels, id_col, label_col).join(texts.select("doc_id").distinct(), "doc_id")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    # At most train_rows narrow rows by construction.
    bags = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def count(batches):
        for batch in batches:
            for y, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = lowered((text.as_py() or "").encode())
                starts, ends, _ = words_of(raw)
                parts = [np.unique(word_features(raw, starts[i:i + SLICE], ends[i:i + SLICE])) for i in range(0, len(starts), SLICE)]
                own = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
                own = own[own != 0]
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(np.full(len(own), y, np.int32))], ["feature", "y"])

    totals = bags.groupBy().agg(F.sum("y").alias("n1"), F.count(F.lit(1)).alias("n")).collect()[0]
    n1, n = totals.n1 or 0, totals.n
    none = Model(np.zeros(0, np.uint64), np.zeros(0), -4.0)
    if n1 == 0 or n1 == n:
        return none
    rows = bags.mapInArrow(count, "feature long, y int").groupBy("feature").agg(
        F.sum("y").alias("c1"), F.count(F.lit(1)).alias("c"))

    def term(k: Column, total: Column) -> Column:  # k log(k / expected), 0 for k = 0
        return F.when(k > 0, k * F.log(k / total)).otherwise(0.0)

    c1, c0 = F.col("c1"), F.col("c") - F.col("c1")
    ratio = 2 * (term(c1, F.col("c") * n1 / n) + term(c0, F.col("c") * (n - n1) / n)
                 + term(n1 - c1, (n - F.col("c")) * n1 / n) + term(n - n1 - c0, (n - F.col("c")) * (n - n1) / n))
    best = (rows.where(c1 >= 3).where(c1 * n > F.col("c") * n1).withColumn("ratio", F.round(ratio, 6)).where(F.col("ratio") >= least)
            .orderBy(F.desc("ratio"), "feature").limit(max_features).select("feature").collect())
    features = np.sort(np.array([r.feature for r in best], np.int64).view(np.uint64))
    if not len(features):
        return none

    def examples(batches):
        filled = top_bits(features)
        for batch in batches:
            for doc_id, y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                of, at, _ = known_words(lowered((text.as_py() or "").encode()), features, filled)
                if len(of):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id], pa.int64()), pa.array([y], pa.int32()),
                         pa.array([of.astype("<i4").tobytes()], pa.binary()), pa.array([at.astype("<i4").tobytes()], pa.binary())],
                        ["doc_id", "y", "sentence", "feature"])

    got = sorted(bags.mapInArrow(examples, "doc_id long, y int, sentence binary, feature binary").collect(), key=lambda r: r.doc_id)
    weights, bias = train([(r.y, np.frombuffer(r.sentence, "<i4"), np.frombuffer(r.feature, "<i4")) for r in got], len(features))
    return Model(features, weights, bias)


def score(docs: DataFrame, model: Model, report: float = REPORT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, score, sentences): each row's noisy-or and its sentences of at least ``report``.

    A sentence is its first word's first byte, its last word's end (UTF-8 bytes) and its probability.
    """
    schema = "doc_id long, score double, sentences array<struct<start: long, end: long, score: double>>"
    sent = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def read(batches):
        filled = top_bits(model.features)
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1):
                found = model.sentences((text.as_py() or "").encode(), filled)
                scores.append(noisy_or([p for *_, p in found]) if found else 0.0)
                spans.append([{"start": a, "end": b, "score": p} for a, b, p in found if p >= report])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, sent)],
                                             ["doc_id", "score", "sentences"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(read, schema)
