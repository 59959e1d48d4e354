"""Codes of vectors by codebooks of their parts, with memoised grid cells (product quantisation in integers).

A vector's components become integers floor(2**bits * x); it is cut into ``parts`` equal consecutive parts.
Each part position has a codebook of up to ``entries`` entries: first that part of the vectors of the smallest
ids, then, ``rounds`` times, the componentwise floor of the mean of the parts nearest to each entry
(squared Euclidean distance, ties to the lower index; an unused entry stays).

Nearest entries come through a grid: a part's coarse cell is its components divided by a power of two,
rounded down. For a new cell, the least and greatest distance from its box to each entry are taken; an
entry whose least distance is above another's greatest can be nearest nowhere in the box. The others are
cached under the cell, and only they are evaluated exactly. A cache is a task's own and at most
``CACHE`` cells; a full one starts anew, which changes no result.

Codebooks are bounded by the parameters (parts x entries x part length integers) and go through the driver. A
task sends one row of sums for each entry and component and one count, whatever the number of its rows.

Results: vectors that are null or hold a null or non-finite component are dropped. Ids: null ids are coded but
start no entry; of several vectors of one id the least (component by component) starts the entry. Fewer vectors
than ``entries`` give a smaller codebook. Vectors of another length than that of the smallest id are listed with
null code and error (none of such a length can be cut like the rest). Integers are exact at any size:
components beyond 2**24 are summed and measured as Python integers; an error beyond a long is the largest
long. An empty table gives an empty result; other columns than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 1 << 16
WIDE = 1 << 24  # integers of at most this size keep their squared distances in 64 bits
LIMB = 60
LONG_MAX = 2**63 - 1


def integers(values: np.ndarray, bits: int) -> np.ndarray:
    """floor(2**bits * x) as int64, or as Python integers if one is beyond ``WIDE``."""
    scaled = np.floor(np.ldexp(values.astype(np.float64), bits))
    if not scaled.size or np.abs(scaled).max() <= WIDE:
        return scaled.astype(np.int64)
    exact = [int(s) if np.isfinite(s) else int(x) << bits for s, x in zip(scaled.ravel(), values.astype(np.float64).ravel(), strict=True)]
    return np.array(exact, object).reshape(values.shape)


class CellIndex:
    """Nearest entries of one part position's codebook, with the candidates of each grid cell kept."""

    def __init__(self, book: np.ndarray):
        self.book = book  # entries x components
        spread = max(int(c.max() - c.min()) for c in book.T) if book.size else 0
        self.side = 1 << max(0, (spread // 8).bit_length())  # some eight cells along the codebook
        self.cells: dict[bytes, np.ndarray] = {}

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """Entries that are nearest somewhere in each cell's box (no other entry is)."""
        low = cells[:, None, :] * self.side
        high = low + (self.side - 1)
        book = self.book[None, :, :]
        zero = np.zeros((), cells.dtype)
        near = np.maximum(np.maximum(low - book, book - high), zero)
        far = np.maximum(np.abs(book - low), np.abs(high - book))
        least, greatest = (near * near).sum(axis=2), (far * far).sum(axis=2)
        return [np.flatnonzero(keep) for keep in least <= greatest.min(axis=1)[:, None]]

    def nearest(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for each row of ``part``."""
        if self.book.dtype == object:
            part = part.astype(object)
        cells = part // self.side
        if cells.dtype == object:
            keys = [repr(tuple(c)).encode() for c in cells]
            distinct = {k: i for i, k in enumerate(keys)}
            first = np.array(list(distinct.values()))
            place = {k: i for i, k in enumerate(distinct)}
            inverse = np.array([place[k] for k in keys])
            names = list(distinct)
        else:
            flat = np.ascontiguousarray(cells).view(f"V{8 * cells.shape[1]}").ravel()
            names, first, inverse = np.unique(flat, return_index=True, return_inverse=True)
            names = [n.tobytes() for n in names]
        missing = [i for i, name in enumerate(names) if name not in self.cells]
        if len(self.cells) + len(missing) > CACHE:
            self.cells.clear()
            missing = list(range(len(names)))
        for lo in range(0, len(missing), 1024):
            some = missing[lo:lo + 1024]
            for i, own in zip(some, self.candidates(cells[first[some]]), strict=True):
                self.cells[names[i]] = own
        lists = [self.cells[n] for n in names]
        sizes = np.array([len(c) for c in lists])[inverse]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        bounds = np.cumsum([0, *map(len, lists)])
        entry = np.concatenate(lists)[np.arange(sizes.sum()) - np.repeat(starts - bounds[:-1][inverse], sizes)]
        gap = part[np.repeat(np.arange(len(part)), sizes)] - self.book[entry]
        dist = (gap * gap).sum(axis=1)
        best = np.minimum.reduceat(dist, starts)
        hit = np.flatnonzero(dist == np.repeat(best, sizes))  # candidates ascend: the first hit is the lowest index
        _, at = np.unique(np.repeat(np.arange(len(part)), sizes)[hit], return_index=True)
        return entry[hit[at]], best


@dataclass(frozen=True)
class Codebooks:
    books: list[np.ndarray]  # one for each part position: entries x components
    length: int  # of the vectors
    bits: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for b in self.books for x in b.ravel()).encode()).hexdigest()

    def index(self) -> list[CellIndex]:
        return [CellIndex(b) for b in self.books]


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """(vec_id, v, label) of the vectors without a null or non-finite component."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    return vectors.where(v.isNotNull() & ~F.coalesce(bad, F.lit(False))).select(F.col(id_col).alias("vec_id"), v.alias("v"), label.alias("label"))


def rows_of(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the vectors of this length, their components)."""
    sizes = np.diff(column.offsets.to_numpy())
    at = np.flatnonzero(sizes == length)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    begin = (column.offsets.to_numpy()[:-1] - column.offsets[0].as_py())[at]
    return at, flat[begin[:, None] + np.arange(length)] if length else np.zeros((len(at), 0))


def start_books(kept: DataFrame, parts: int, entries: int, bits: int) -> Codebooks | None:
    seeds = (kept.where("vec_id is not null and size(v) > 0").groupBy("vec_id").agg(F.min("v").alias("v"))
             .orderBy("vec_id").limit(entries).collect())
    if not seeds:
        return None
    length = len(seeds[0].v)
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    rows = integers(np.array([r.v for r in seeds if len(r.v) == length], np.float64), bits)
    return Codebooks(np.split(rows, parts, axis=1), length, bits)


def refined(kept: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks after one round: entries become the floors of their parts' means."""
    step = books.length // len(books.books)

    def sums(batches: Iterator[pa.RecordBatch]):
        index = books.index()
        totals: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            _, values = rows_of(batch.column(0), books.length)
            if not len(values):
                continue
            whole = integers(values, books.bits)
            for p, cells in enumerate(index):
                part = whole[:, p * step:(p + 1) * step]
                entry, _ = cells.nearest(part)
                order = np.argsort(entry, kind="stable")
                own, first = np.unique(entry[order], return_index=True)
                added = np.add.reduceat(part[order], first, axis=0)
                counts = np.diff(np.append(first, len(entry)))
                for e, row, c in zip(own.tolist(), added.tolist(), counts.tolist(), strict=True):
                    for place, x in enumerate((*row, c)):
                        totals[p, e, place] = totals.get((p, e, place), 0) + x
        # A total of any size leaves as limbs of 60 bits, the highest signed, so that Spark's sums are exact.
        out = []
        for (p, e, place), total in totals.items():
            limb = 0
            while True:
                rest = total >> LIMB
                last = rest in (0, -1) and abs(total) < 1 << LIMB
                out.append((p, e, place, limb, Decimal(total if last else total & ((1 << LIMB) - 1))))
                if last:
                    break
                total, limb = rest, limb + 1
        cols = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in cols[:4]), pa.array(cols[4], pa.decimal128(20, 0))],
            ["part", "entry", "place", "limb", "total"])

    rows = (kept.select("v").mapInArrow(sums, "part int, entry int, place int, limb int, total decimal(20,0)")
            .groupBy("part", "entry", "place", "limb").agg(F.sum("total").alias("total")).collect())
    totals: dict[tuple[int, int, int], int] = {}
    for r in rows:
        key = (r.part, r.entry, r.place)
        totals[key] = totals.get(key, 0) + (int(r.total) << LIMB * r.limb)
    fresh = []
    for p, book in enumerate(books.books):
        exact = [[totals[p, e, d] // totals[p, e, step] if (p, e, step) in totals else int(book[e, d]) for d in range(step)]
                 for e in range(len(book))]
        big = any(abs(x) > WIDE for row in exact for x in row)
        fresh.append(np.array(exact, object if big else np.int64).reshape(len(book), step))
    return Codebooks(fresh, books.length, books.bits)


def fit_codebooks(kept: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, bits: int = 8) -> Codebooks | None:
    books = start_books(kept, parts, entries, bits)
    for _ in range(rounds if books else 0):
        books = refined(kept, books)
    return books


def encode(kept: DataFrame, books: Codebooks | None) -> DataFrame:
    """Rows (vec_id, label, codes, error): the entry of each part and the summed squared distances."""
    fields = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    schema = f"vec_id {fields['vec_id']}, label {fields['label']}, codes array<int>, error long"

    def read(batches: Iterator[pa.RecordBatch]):
        index = books.index() if books else []
        step = books.length // len(index) if books else 0
        for batch in batches:
            codes: list = [None] * batch.num_rows
            errors: list = [None] * batch.num_rows
            at, values = rows_of(batch.column(1), books.length) if books else (np.zeros(0, int), np.zeros((0, 0)))
            if len(at):
                whole = integers(values, books.bits)
                found = [cells.nearest(whole[:, p * step:(p + 1) * step]) for p, cells in enumerate(index)]
                own = np.stack([entry for entry, _ in found], axis=1).tolist()
                total = sum(dist.astype(object) for _, dist in found)
                for i, code, err in zip(at.tolist(), own, total.tolist(), strict=True):
                    codes[i], errors[i] = code, min(int(err), LONG_MAX)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(codes, pa.list_(pa.int32())), pa.array(errors, pa.int64())],
                ["vec_id", "label", "codes", "error"])

    return kept.select("vec_id", "v", "label").mapInArrow(read, schema)
