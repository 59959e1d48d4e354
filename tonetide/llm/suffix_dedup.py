"""Exact removal of repeated byte strings with shard suffix arrays.

A byte goes when it lies in a string of ``length`` bytes that also starts earlier (in a smaller document,
or further left in the same one). Strings are judged on the input.

Texts are first staged in files of up to STAGE_BYTES each, so later steps find a document by (file, number)
and only small rows are shuffled. Equal texts are grouped by digest: all but the first lose every byte
(if they are as long as ``length``) and take no further part.

Sharding. Among the 24-byte substrings of a string the one of the smallest hash (leftmost on ties) is its
anchor, so equal strings have equal anchors at equal places. Strings with the same anchor at the
same position follow each other; their stretch of text is a segment. Segments whose anchor occurs
once in the corpus can't repeat and leave. The others are dealt to shards by their anchor, so all
copies of a string meet in one shard. Before that a batch collapses its equal segments, and a shard
those of its batches: the first stays, the others are known to be covered. Anchors that occur more
than HOT_ANCHOR times are dealt string by string (by anchor and string), so that even a passage that
a third of all documents hold, each in other surroundings, spreads over all shards.

A shard takes its segments in parts of some PART_BYTES, again by their anchors, so the memory of sorting
doesn't follow the shard. A part's segments are joined in document order with a separator that no text
holds. Their suffixes are sorted by induced sorting (``suffix_array``), the permuted common prefixes
computed, and the order split where the common prefix is shorter than ``length``: each stretch is one
repeated string, and all its places but the first are covered. Strings of hot anchors only equal whole
strings and need no sorting. Covered runs go back to the files, where they are joined and cut out.

Memory. What a task holds at a time is bounded by bytes: texts by STAGE_BYTES, packed segments by SLICE_BYTES,
what a file's segments are collapsed with by SEEN_BYTES, rows on their way to Spark by BATCH_BYTES.

Defined results:
* null text: no bytes; texts shorter than ``length``: kept whole;
* order: by id, null first; equal ids by digest, then by place in the staged files;
* repeated rows: the first is the original, the others are its copies;
* an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import cut_lineage, scratch_path
from . import files
from .sizes import counted_side
from .spans import mix, span_hashes
from .suffix_array import common_prefixes, suffix_array

LENGTH = 100
ANCHOR = 24
HOT_ANCHOR = 8192
BROADCAST_GROUPS = 200_000  # groups of equal texts, some 150 bytes each
STAGE_BYTES = 1 << 24  # of text in a staged file, or one document
PIECE = 1 << 19  # longer texts are searched for anchors in overlapping pieces
PLACE_BITS = 24


# ---- staged texts ---------------------------------------------------------------------------

def stage(docs: DataFrame, folder: str) -> DataFrame:
    """Write the texts, each file in (id, digest) order; returns (file, at, id, n_bytes, digest)."""
    def pieces(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < len(ends):
                hi = int(np.searchsorted(ends, STAGE_BYTES + (ends[lo - 1] if lo else 0))) + 1
                yield ids[lo:hi].to_pylist(), [t or b"" for t in texts[lo:hi].to_pylist()]
                lo = hi

    def write(batches):
        for ids, texts in pieces(batches):
            digests = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
            order = sorted(range(len(texts)), key=lambda i: (ids[i] is not None, ids[i] or 0, digests[i]))
            cols = [pa.array([ids[i] for i in order], pa.int64()), pa.array([digests[i] for i in order], pa.binary()),
                    pa.array([texts[i] for i in order], pa.large_binary())]
            path, stream = files.open_output(folder, "texts", ".arrow")
            table = pa.table(dict(zip(("id", "digest", "text"), cols, strict=True)))
            with pa.ipc.new_file(stream, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(order)), pa.array(range(len(order)), pa.int64()), cols[0],
                 pa.array([len(texts[i]) for i in order], pa.int64()), cols[1]], ["file", "at", "id", "n_bytes", "digest"])

    rows = docs.mapInArrow(write, "file string, at long, id long, n_bytes long, digest binary")
    path = scratch_path(docs.sparkSession, "staged-texts")
    rows.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def read_stage(uri: str) -> tuple[list, list[bytes], list[bytes]]:
    with files.open_input(uri) as f:
        table = pa.ipc.open_file(f).read_all()
    return tuple(table.column(c).to_pylist() for c in ("id", "digest", "text"))


def headers(rows: DataFrame, length: int) -> DataFrame:
    """(file, skip): the numbers of documents whose text occurs before."""
    place = F.struct("id", "file", "at")
    groups = cut_lineage(rows.where(F.col("n_bytes") >= length).groupBy("digest")
                         .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    copies = (rows.join(counted_side(groups, BROADCAST_GROUPS), "digest").where(~place.eqNullSafe(F.col("first")))
              .groupBy("file").agg(F.collect_list("at").alias("skip")))
    return rows.select("file").distinct().join(copies, "file", "left").select(
        "file", F.coalesce("skip", F.array().cast("array<long>")).alias("skip"))


# ---- anchors --------------------------------------------------------------------------------

def text_anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start + 1, anchor hash) of each segment of a text."""
    if len(text) > PIECE:
        parts = []
        for lo in range(0, len(text) - length + 1, PIECE - length + 1):
            a, b, h = text_anchors(text[lo: lo + PIECE], length)
            parts.append((a + lo, b + lo, h))
        return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))
    n = len(text) - ANCHOR + 1
    if n + ANCHOR - 1 < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places = np.arange(n)
    hashes = span_hashes(text, places, places + ANCHOR)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (hashes & ~low) | places.astype(np.uint64)
    wide, span = length - ANCHOR + 1, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span:])
    chosen = (least & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    return first, np.append(first[1:], len(chosen)), hashes[chosen[first]]


def batch_anchors(texts: list[bytes], skip: set[int], length: int):
    """(document, first start, last start + 1, anchor) of the segments of a batch, in order."""
    found = [(i, *text_anchors(t, length)) for i, t in enumerate(texts) if len(t) >= length and i not in skip]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    return (np.repeat([f[0] for f in found], [len(f[1]) for f in found]), *(np.concatenate([f[k] for f in found]) for k in (1, 2, 3)))


def by_bucket(values: np.ndarray, buckets: int) -> list[np.ndarray]:
    to = (values % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    return np.split(order, np.searchsorted(to[order], np.arange(1, buckets)))


def count_anchors(heads: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, file, data): the distinct anchors of each file and how often they occur in it."""
    def read(batches):
        for batch in batches:
            for uri, skip in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                anchors, counts = np.unique(batch_anchors(read_stage(uri)[2], set(skip), length)[3], return_counts=True)
                rows = [(b, uri, anchors[own].tobytes() + counts[own].astype("<u4").tobytes())
                        for b, own in enumerate(by_bucket(anchors, buckets)) if len(own)]
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1]), pa.array(cols[2], pa.binary())],
                                                     ["bucket", "file", "data"])

    return heads.mapInArrow(read, "bucket int, file string, data binary")


def judge_anchors(hot: int):
    """For each file: 0 for its anchors that occur once in the corpus, 1 for others, 2 for those of more than ``hot`` places."""
    def judge(table: pa.Table) -> pa.Table:
        data = table.column("data").to_pylist()
        sizes = [len(d) // 12 for d in data]
        anchors = np.concatenate([np.frombuffer(d, "<u8", n) for d, n in zip(data, sizes, strict=True)])
        counts = np.concatenate([np.frombuffer(d, "<u4", n, 8 * n) for d, n in zip(data, sizes, strict=True)])
        _, which = np.unique(anchors, return_inverse=True)
        total = np.bincount(which, weights=counts)[which]
        status = (total > 1).astype(np.uint8) + (total > hot)
        parts = np.split(status.astype(np.uint8), np.cumsum(sizes)[:-1])
        return pa.table({"file": table.column("file"), "bucket": table.column("bucket"),
                         "data": pa.array([p.tobytes() for p in parts], pa.binary())})

    return judge


# ---- segments -------------------------------------------------------------------------------

SEGMENT = np.dtype([("id", "<i8"), ("tie", "<u8"), ("part", "<u4"), ("doc", "<u4"), ("start", "<u4"), ("size", "<u4")])
BUCKET_BYTES = 64 << 20  # of the corpus, for each bucket of anchors
SHARD_BYTES = 4 << 20  # of the corpus, for each shard of segments that may repeat
PART_BYTES = 1 << 19  # of segments that a shard sorts at a time; that takes some 125 times as much
SLICE_BYTES = 32 << 20  # of segments that a file's task packs at a time
SEEN_BYTES = 64 << 20  # of distinct segments that a file's task knows
BATCH_BYTES = 8 << 20  # of packed rows in one Arrow batch
COVER = np.dtype([("doc", "<u4"), ("start", "<u4"), ("end", "<u4")])
SEGMENTS, COVERED, HOT_STRINGS = range(3)  # kinds of rows for the shards


def record_batches(rows, schema: pa.Schema):
    """``rows``, whose last column is binary, in batches of some BATCH_BYTES; at least one batch."""
    held, size, n = [], 0, 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types, strict=True)], schema=schema)
            held, size, n = [], 0, n + 1
    if held or not n:
        cols = list(zip(*held)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)


def pack_segments(found: array, shards: int, texts: list[bytes], ids: np.ndarray, ties: np.ndarray):
    """(shard, packed segments) of the ``found`` document, start, end and key of each segment, in their order."""
    if not found:
        return
    rows = np.array(found, np.uint64).reshape(-1, 4)
    rows = rows[np.argsort(rows[:, 3] % np.uint64(shards), kind="stable")]
    shard = (rows[:, 3] % np.uint64(shards)).astype(np.int64)
    doc, start, end = rows[:, :3].astype(np.int64).T
    head = np.empty(len(rows), SEGMENT)
    head["id"], head["tie"], head["part"] = ids[doc], ties[doc], mix(rows[:, 3]) >> np.uint64(32)
    head["doc"], head["start"], head["size"] = doc, start, end - start
    cuts = (np.flatnonzero(np.diff(shard)) + 1).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(rows)]):
        body = [texts[d][a:b] for d, a, b in zip(doc[lo:hi].tolist(), start[lo:hi].tolist(), end[lo:hi].tolist())]
        yield int(shard[lo]), b"".join([(hi - lo).to_bytes(4, "little"), head[lo:hi].tobytes(), *body])


def segments_of(length: int, buckets: int, shards: int, slice_bytes: int, seen_bytes: int):
    """From the judged anchors of one file: its distinct segments for the shards, and runs covered already."""
    schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("file", pa.string()), ("data", pa.binary())])

    def rows(judged: pa.Table):
        uri = judged.column("file")[0].as_py()
        data = dict(zip(judged.column("bucket").to_pylist(), judged.column("data").to_pylist(), strict=True))
        skip = set(np.frombuffer(data.pop(-1), "<i8").tolist())
        ids, digests, texts = read_stage(uri)
        # Null ids come first; a tie with the least id goes by digest.
        id_of = np.array([-(1 << 63) if i is None else i for i in ids], np.int64)
        tie_of = np.array([int.from_bytes(d[:8], "big") for d in digests], np.uint64)
        own_shard = int.from_bytes(digests[0][:4], "little") % shards
        doc, first, last, anchor = batch_anchors(texts, skip, length)
        distinct, which = np.unique(anchor, return_inverse=True)
        status = np.zeros(len(distinct), np.uint8)
        for b, own in enumerate(by_bucket(distinct, buckets)):
            if len(own):
                status[own] = np.frombuffer(data[b], np.uint8)
        status = status[which]
        # Segments, and strings of hot segments: a later one is covered at once. One that is forgotten meets its copy in a shard.
        seen, known = set(), 0
        kept, held = {SEGMENTS: array("Q"), HOT_STRINGS: array("Q")}, 0  # document, start, end, key
        covered = array("I")  # document, start, end

        def cover(d: int, a: int, b: int):
            if covered and covered[-3] == d and covered[-2] <= a <= covered[-1]:
                covered[-1] = max(covered[-1], b)
            else:
                covered.extend((d, a, b))

        def packed():
            if covered:
                yield own_shard, COVERED, uri, covered.tobytes()
            for kind, found in kept.items():
                for shard, segments in pack_segments(found, shards, texts, id_of, tie_of):
                    yield shard, kind, uri, segments

        for k in np.flatnonzero(status):
            if held + 4 * len(covered) >= slice_bytes:
                yield from packed()
                kept, held, covered = {kind: array("Q") for kind in kept}, 0, array("I")
            if known >= seen_bytes:
                seen, known = set(), 0
            d, a, b, key = int(doc[k]), int(first[k]), int(last[k]) + length - 1, int(anchor[k])
            whole = texts[d][a:b]
            if whole in seen:
                cover(d, a, b)
                continue
            seen.add(whole)
            known += b - a
            if status[k] == 1:
                kept[SEGMENTS].extend((d, a, b, key))
                held += b - a
                continue
            strings = span_hashes(whole, np.arange(b - a - length + 1), np.arange(length, b - a + 1))
            for i, h in enumerate(strings.tolist()):
                own = whole[i:i + length]
                if own in seen and b - a > length:
                    cover(d, a + i, a + i + length)
                else:
                    seen.add(own)
                    known += length
                    kept[HOT_STRINGS].extend((d, a + i, a + i + length, key ^ h))
                    held += length
        yield from packed()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from record_batches(rows(pa.Table.from_batches(list(batches))), schema)

    return emit


def repeated_places(text: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """Starts (among ``valid``) of strings of ``length`` that also start further left in the joined text."""
    order = suffix_array(text, length)
    order = order[valid[order]]
    if not len(order):
        return order
    prefixes = common_prefixes(text, order, length)
    new = prefixes[order] < length
    new[0] = True
    group = np.cumsum(new) - 1
    earliest = np.minimum.reduceat(order, np.flatnonzero(new))
    return np.sort(order[order != earliest[group]])


def part_repeats(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of a text, start, end) of the runs of strings that also start in an earlier one of ``texts``."""
    # UTF-8 ends at byte 0xF4, so one can be added; 0 separates segments.
    joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    valid = np.zeros(len(joined) + 1, np.int32)
    valid[begins] += 1
    np.add.at(valid, begins + sizes - length + 1, -1)
    places = repeated_places(joined, np.cumsum(valid[:-1]) > 0, length)
    segment = np.searchsorted(begins, places, side="right") - 1
    start = places - begins[segment]
    # Neighbouring starts of one segment become one covered run.
    cuts = np.flatnonzero(np.concatenate(([True], (np.diff(segment) != 0) | (np.diff(start) != 1)))[: len(places)])
    stops = np.append(cuts[1:], len(places))[: len(cuts)] - 1
    return segment[cuts], start[cuts], start[stops] + length


def search_shard(length: int, part_bytes: int):
    """From a shard's segments: the covered runs of each file."""
    schema = pa.schema([("file", pa.string()), ("data", pa.binary())])

    def rows(batches):
        packed = []
        for batch in batches:
            for kind, uri, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "file", "data")), strict=True):
                if kind == COVERED:
                    yield uri, data
                else:
                    packed.append((kind, uri, data))
        if not packed:
            return
        names = sorted({uri for _, uri, _ in packed})
        number = {u: i for i, u in enumerate(names)}
        heads = [np.frombuffer(data, SEGMENT, int.from_bytes(data[:4], "little"), 4) for *_, data in packed]
        counts = [len(h) for h in heads]
        at = np.concatenate([4 + h.nbytes + np.cumsum(h["size"].astype(np.int64)) - h["size"] for h in heads])
        row = np.repeat(np.arange(len(packed)), counts)
        of = np.repeat([number[uri] for _, uri, _ in packed], counts)
        head = np.concatenate(heads)
        # Equal strings have equal keys, so they are in one part.
        part = head["part"] % np.uint32(int(head["size"].sum(dtype=np.int64)) // part_bytes + 1)
        order = np.lexsort((head["start"], head["doc"], of, head["tie"], head["id"], part))
        found = []  # file, document, start, end
        for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            seen, texts, kept, again = set(), [], [], []
            for k, r, lo, size in zip(own.tolist(), row[own].tolist(), at[own].tolist(), head["size"][own].tolist()):
                segment = packed[r][2][lo:lo + size]
                if segment in seen:
                    again.append(k)
                    continue
                seen.add(segment)
                if packed[r][0] == SEGMENTS:
                    texts.append(segment)
                    kept.append(k)
            start = head["start"][again].astype(np.int64)
            found.append(np.stack([of[again], head["doc"][again], start, start + head["size"][again]], axis=1))
            if len(texts) > 1:
                which, lo, hi = part_repeats(texts, length)
                which = np.array(kept)[which]
                start = head["start"][which].astype(np.int64)
                found.append(np.stack([of[which], head["doc"][which], start + lo, start + hi], axis=1))
        found = np.concatenate(found)
        found = found[np.argsort(found[:, 0], kind="stable")]
        for own in np.split(found, np.flatnonzero(np.diff(found[:, 0])) + 1):
            if len(own):
                yield names[own[0, 0]], own[:, 1:].astype("<u4").tobytes()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from record_batches(rows(batches), schema)

    return search


# ---- what is left ---------------------------------------------------------------------------

def runs_of(covered: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of (start, end) pairs."""
    out = []
    for a, b in sorted(zip(covered["start"].tolist(), covered["end"].tolist())):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_texts(length: int, with_text: bool):
    def cut(table: pa.Table) -> pa.Table:
        uri = table.column("file")[0].as_py()
        skip, parts = set(), []
        for kind, d in zip(table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True):
            if kind == -1:
                skip = set(np.frombuffer(d, "<i8").tolist())
            else:
                parts.append(np.frombuffer(d, COVER))
        covered = np.concatenate(parts) if parts else np.zeros(0, COVER)
        covered = covered[np.argsort(covered["doc"], kind="stable")]
        ids, digests, texts = read_stage(uri)
        bounds = np.searchsorted(covered["doc"], np.arange(len(texts) + 1))
        rows = []
        for i, text in enumerate(texts):
            runs = [(0, len(text))] if i in skip else runs_of(covered[bounds[i]:bounds[i + 1]])
            left, at = [], 0
            for a, b in runs:
                left.append(text[at:a])
                at = b
            kept = b"".join([*left, text[at:]])
            rows.append((ids[i], len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if with_text else None,
                         [{"start": a, "end": b} for a, b in runs]))
        cols = list(zip(*rows))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), span]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, cols, types, strict=True)})

    return cut


RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
          "spans array<struct<start: long, end: long>>")


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans) of every document.

    ``spans`` are the maximal removed runs; ``kept`` holds the bytes left over if ``with_text``.
    """
    if not ANCHOR <= length <= 60_000:
        raise ValueError(f"length must be from {ANCHOR} to 60000")
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stage(narrow, scratch_path(spark, "texts"))
    heads = cut_lineage(headers(rows, length))
    # Much work stands behind the few bytes of a file's row: as many partitions as files.
    n_files = max(1, heads.count())
    heads = heads.repartition(n_files, "file")
    size = rows.agg(F.sum("n_bytes").alias("b")).collect()[0].b or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, shards = max(least, size // BUCKET_BYTES + 1), max(4 * least, size // SHARD_BYTES + 1)
    judged = count_anchors(heads, length, buckets).groupBy("bucket").applyInArrow(judge_anchors(HOT_ANCHOR), "file string, bucket int, data binary")
    marks = heads.mapInArrow(skip_lists, "file string, bucket int, data binary")
    found = judged.union(marks).repartition(n_files, "file").groupBy("file").applyInArrow(
        segments_of(length, buckets, shards, SLICE_BYTES, SEEN_BYTES), "shard int, kind int, file string, data binary")
    covered = found.groupBy("shard").applyInArrow(search_shard(length, PART_BYTES), "file string, data binary")
    per_file = covered.select("file", F.lit(0).alias("kind"), "data").union(marks.select("file", F.col("bucket").alias("kind"), "data"))
    return per_file.repartition(n_files, "file").groupBy("file").applyInArrow(cut_texts(length, with_text), RESULT)


def skip_lists(batches):
    """(file, -1, packed numbers) of each file's copies."""
    for batch in batches:
        data = [np.array(s, "<i8").tobytes() for s in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([-1] * len(data), pa.int32()), pa.array(data, pa.binary())],
                                         ["file", "bucket", "data"])
