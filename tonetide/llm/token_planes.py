"""Token ids in bit- or byte-plane files with a chunk index.

Documents are range-partitioned by id and sorted, so that the files, taken in order, hold all ids in
ascending document order. A task encodes its documents and writes one file:

    magic  b"TTPLANES"
    chunks of CHUNK_IDS ids: the ids as little-endian unsigned 32-bit integers, transposed into
           4 byte planes (or 32 bit planes), each plane compressed with zstandard on its own
    index  zstandard of JSON {"mode", "chunks": [[file offset, ids, [plane sizes]]],
           "docs": [[document id, ids]]}
    tail   length of the index (8 bytes, little-endian) and the magic again

Planes that are all zero (the upper bytes of a small vocabulary) shrink to a few bytes. A chunk can be
read alone through the index. Memory of a task: one Arrow batch, one chunk, the file's index and a
bounded cache of encoded words.

Encoding goes through the tokenizers library word by word. It is exact for vocabularies whose
pre-tokeniser never joins text over white space (``word_local=True``, true of word_bpe_49k.json);
for others pass ``word_local=False``, and whole texts are encoded. Letters and closing marks of a
word are encoded once each and kept, so a word costs a lookup wherever it recurs.

Defined results:
* null or empty text: the end id alone; null id: before all other ids;
* repeated ids or rows: each row is written on its own, ties by text;
* an empty table: no files, an empty result; extra columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from itertools import batched, chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..config import cut_lineage, scratch_path
from . import files

MAGIC = b"TTPLANES"
CHUNK_IDS = 1 << 17
CACHE_WORDS = 1_500_000  # words that a worker keeps encoded; beyond that it starts a new cache
OTHER_SEPARATORS = "\x1c\x1d\x1e\x1f"  # str.split() takes these as white space, tokenisers do not


# ---- encoding -------------------------------------------------------------------------------

def byte_symbols() -> dict[int, str]:
    """The printable character that byte-level BPE vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


# A run of lower-case Latin-1 letters, then a run of ASCII marks other than the apostrophe.
PLAIN_WORD = re.compile(r"([a-zß-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


class WordCodes(dict):
    """word -> code; a missing word is encoded and gets the next code. ``ids_of`` expands codes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.flat, self.start, self.length = array("I"), array("q"), array("q")

    def encode(self, word: str) -> list[int]:
        parts = PLAIN_WORD.fullmatch(word)
        if not parts:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        letters, marks = parts.groups()
        if letters and marks:  # two pre-tokens: each is encoded once
            return [*self.known(letters), *self.known(marks)]
        if letters:  # one pre-token, which normalisation leaves as it is
            return [t.id for t in self.model.tokenize("".join(map(self.symbols.__getitem__, word.encode())))]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def known(self, word: str) -> array:
        code = self[word]
        return self.flat[self.start[code]: self.start[code] + self.length[code]]

    def __missing__(self, word: str) -> int:
        ids = self.encode(word)  # may add codes of the word's parts
        code = len(self.start)
        self.start.append(len(self.flat))
        self.length.append(len(ids))
        self.flat.extend(ids)
        self[word] = code
        return code

    def ids_of(self, codes: np.ndarray) -> np.ndarray:
        length = np.frombuffer(self.length, np.int64)[codes]
        ends = np.cumsum(length)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(
            np.frombuffer(self.start, np.int64)[codes] - ends + length, length)
        return np.frombuffer(self.flat, np.uint32)[at]


_CODES: dict[str, WordCodes] = {}  # of this Python worker, kept between its tasks


def codes_for(path: str) -> WordCodes:
    kept = _CODES.get(path)
    if kept is None or len(kept) > CACHE_WORDS:
        kept = _CODES[path] = WordCodes(path)
    return kept


def words_of(text: str) -> list[str]:
    """White-space separated words whose encodings, joined, are the text's encoding."""
    if any(c in text for c in OTHER_SEPARATORS):
        return [text]
    if "<|" not in text:  # special tokens are case-sensitive
        try:
            text.encode("latin-1")
            return text.lower().split()  # one to one within Latin-1; the tokeniser lowers anyway
        except UnicodeEncodeError:
            pass
    return text.split()


def encode_texts(texts: list[str], path: str, word_local: bool = True) -> tuple[np.ndarray, list[int]]:
    """Ids of all texts in a row, and the number of ids of each text."""
    codes = codes_for(path)
    if not word_local:
        each = [codes.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        return np.array([i for x in each for i in x], np.uint32), [len(x) for x in each]
    words = [words_of(t) for t in texts]
    n = sum(map(len, words))
    got = np.fromiter(map(codes.__getitem__, chain.from_iterable(words)), np.int64, n)
    upto = np.concatenate(([0], np.cumsum(np.frombuffer(codes.length, np.int64)[got]))) if n else np.zeros(1, np.int64)
    ends = upto[np.cumsum([0] + [len(w) for w in words])]
    return codes.ids_of(got), np.diff(ends).tolist()


# ---- planes ---------------------------------------------------------------------------------

def to_planes(ids: np.ndarray, mode: str) -> list[bytes]:
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if mode == "byte":
        return [raw[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k]).tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, mode: str) -> np.ndarray:
    if mode == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


FILE_DOCS = 200_000  # of a file at most: its index has an entry for each
FILE_IDS = 1 << 28  # of a file, about: its index has an entry for each chunk


class PlaneWriter:
    def __init__(self, stream, mode: str = "byte", level: int = 3):
        self.stream, self.mode, self.pack = stream, mode, zstandard.ZstdCompressor(level=level)
        self.chunks, self.docs, self.held, self.n_held, self.at = [], [], [], 0, len(MAGIC)
        stream.write(MAGIC)

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= CHUNK_IDS:
            rest = np.concatenate(self.held)
            while len(rest) >= CHUNK_IDS:
                self._chunk(rest[:CHUNK_IDS])
                rest = rest[CHUNK_IDS:]
            self.held, self.n_held = [rest.copy()], len(rest)

    def _chunk(self, ids: np.ndarray) -> None:
        packed = [self.pack.compress(p) for p in to_planes(ids, self.mode)]
        self.chunks.append((self.at, len(ids), [len(p) for p in packed]))
        for p in packed:
            self.stream.write(p)
            self.at += len(p)

    def close(self) -> int:
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        index = self.pack.compress(json.dumps({"mode": self.mode, "chunks": self.chunks, "docs": self.docs}).encode())
        self.stream.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.stream.close()
        return sum(c[1] for c in self.chunks)


def read_index(f) -> dict:
    size = f.size()
    f.seek(size - 16)
    tail = f.read(16)
    if tail[8:] != MAGIC:
        raise ValueError("not a whole plane file")
    n = int.from_bytes(tail[:8], "little")
    f.seek(size - 16 - n)
    return json.loads(zstandard.ZstdDecompressor().decompress(f.read(n)))


def read_chunk(f, index: dict, k: int) -> np.ndarray:
    at, n, sizes = index["chunks"][k]
    f.seek(at)
    unpack = zstandard.ZstdDecompressor()
    return from_planes([unpack.decompress(f.read(s)) for s in sizes], n, index["mode"])


def read_documents(f):
    """(document id, start in the file, parts of its ids) of each document, one chunk in memory."""
    index = read_index(f)
    k, chunk, start = -1, np.zeros(0, np.uint32), 0
    for doc_id, n in index["docs"]:
        parts, left = [], n
        while left:
            if not len(chunk):
                k += 1
                chunk = read_chunk(f, index, k)
            parts.append(chunk[:left])
            chunk, left = chunk[left:], left - len(parts[-1])
        yield doc_id, start, parts
        start += n


# ---- Spark ----------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, vocabulary: str, end_id: int | None = 2, folder: str | None = None, mode: str = "byte",
                 word_local: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents; returns one row for each file: file, first_id, nth, n_docs, n_ids.

    A task starts a new file after ``FILE_DOCS`` documents or ``FILE_IDS`` ids, so a file's index is bounded whatever
    a partition holds; ``nth`` numbers its files, and a document is never cut.
    """
    folder = folder or scratch_path(docs.sparkSession, "token-planes")

    def write(batches):
        path = stream = writer = first = None
        nth = 0

        def finished():
            n_docs = len(writer.docs)
            return pa.RecordBatch.from_pydict({"file": [path], "first_id": pa.array([first], pa.int64()), "nth": [nth],
                                               "n_docs": [n_docs], "n_ids": [writer.close()]})

        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, counts = encode_texts(texts, vocabulary, word_local)
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                counts = [n + 1 for n in counts]
            at = 0
            for doc_id, n in zip(batch.column(0).to_pylist(), counts, strict=True):
                if writer is None:
                    path, stream = files.open_output(folder, "tokens", ".planes")
                    writer, first = PlaneWriter(stream, mode), doc_id
                writer.add(doc_id, ids[at:at + n])
                at += n
                if len(writer.docs) >= FILE_DOCS or len(writer.chunks) * CHUNK_IDS >= FILE_IDS:
                    yield finished()
                    writer, nth = None, nth + 1
        if writer is not None:
            yield finished()

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = F.col("id").asc_nulls_first()
    dealt = narrow.repartitionByRange(order).sortWithinPartitions(order, "text")
    return cut_lineage(dealt.mapInArrow(write, "file string, first_id long, nth long, n_docs long, n_ids long"))


def file_starts(written: DataFrame) -> DataFrame:
    """(file, start): ids in the files before each file, from per-file totals (a row for each file)."""
    # Equal ids lie in one partition, so files of one first id are in the order of their task.
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "nth").rowsBetween(Window.unboundedPreceding, -1)
    return written.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))


def read_token_digests(written: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files.

    ``written`` keeps the partitions of the task that wrote each file, so files are read side by side.
    """
    names = ["file", "doc_id", "_at", "n_tokens", "ids_crc32"]
    types = [pa.string()] + [pa.int64()] * 4

    def digests(uri):
        with files.open_input(uri) as f:
            for doc_id, start, parts in read_documents(f):
                crc = 0
                for p in parts:
                    crc = zlib.crc32(p.astype("<u4").tobytes(), crc)
                yield uri, doc_id, start, sum(map(len, parts)), crc

    def read(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                for rows in batched(digests(uri), 20_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    each = written.select("file").mapInArrow(
        read, "file string, doc_id long, _at long, n_tokens long, ids_crc32 long")
    return each.join(file_starts(written), "file").select(
        "doc_id", (F.col("start") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32")
