"""WARC archives of single Zstandard frames, compressed with a dictionary that the file carries.

A file is a skippable frame that holds the dictionary (magic 0x184D2A5D, the public ``.warc.zst``
layout), then one Zstandard frame for each record, compressed on its own, so any record can be
read alone. The dictionary is built from the file's first records (at most ``SAMPLE_BYTES`` of them);
all records are archived, those included. Records of equal payload are written whole once, as
``response`` of the smallest page id; the others are ``revisit`` records that refer to it.

Only digests and page ids are grouped. The group of equal payloads is aggregated before it is
joined back, so a payload that a third of the pages share is one row on its side of the join.

Defined results:
* null html: an empty payload; null url: the target is ``urn:page:<id>``;
* repeated rows (same page id and payload): each is a record, a response if its id is the smallest;
* null page ids are never the smallest unless all are null; then all are responses;
* an empty table: no files, an empty result; extra columns are not read;
* too few records to train on: their first bytes serve as a plain dictionary.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import cut_lineage, scratch_path
from . import files
from .sizes import counted_side

# Fixed values of the public formats.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLE_BYTES = 4_000_000
DICTIONARY_BYTES = 64 * 1024
BROADCAST_GROUPS = 200_000  # groups of equal payloads, some 60 bytes each
RECORD_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public URL namespace


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<{uuid.uuid5(RECORD_IDS, f'page/{page_id}').urn}>"


def header_value(text: str) -> str:
    """A header must stay on its line: control characters and spaces are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def make_record(page_id, url: str | None, payload: bytes, first, date: str) -> bytes:
    """One WARC record; ``first`` is the page that a revisit refers to, None for a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", header_value(url or "") or f"urn:page:{page_id}"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
    ]
    if first is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(first)), ("X-Refers-To-Page-Id", str(first))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:  # too few records to train on
        plain = b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b"\n")
        return zstandard.ZstdCompressionDict(plain, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class WarcWriter:
    """Holds the first records until the dictionary is built, then writes record by record."""

    def __init__(self, stream, level: int = 3):
        self.stream, self.level = stream, level
        self.held, self.held_bytes, self.pack, self.records = [], 0, None, 0

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.pack is not None:
            self.stream.write(self.pack.compress(record))
            return
        self.held.append(record)
        self.held_bytes += len(record)
        if self.held_bytes >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        words = build_dictionary(self.held)
        raw = words.as_bytes()
        self.stream.write(DICTIONARY_FRAME.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw)
        self.pack = zstandard.ZstdCompressor(level=self.level, dict_data=words)
        for r in self.held:
            self.stream.write(self.pack.compress(r))
        self.held = []

    def close(self) -> None:
        if self.pack is None and self.held:
            self._start()
        self.stream.close()


def read_records(f):
    """(header fields, block) of each record of a file."""
    head = f.read(8)
    if int.from_bytes(head[:4], "little") != DICTIONARY_FRAME:
        raise ValueError("the archive does not start with a dictionary frame")
    words = zstandard.ZstdCompressionDict(f.read(int.from_bytes(head[4:], "little")))
    unpack = zstandard.ZstdDecompressor(dict_data=words)
    with io.BufferedReader(unpack.stream_reader(f, read_across_frames=True), 1 << 16) as lines:
        while version := lines.readline():
            if version != b"WARC/1.1\r\n":
                raise ValueError(f"not a record: {version[:40]!r}")
            fields = {}
            while (line := lines.readline()) not in (b"\r\n", b""):
                k, _, v = line.decode().rstrip("\r\n").partition(": ")
                fields[k] = v
            block = lines.read(int(fields["Content-Length"]))
            if lines.read(4) != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            yield fields, block


def with_first_of_equals(pages: DataFrame, id_col: str, html_col: str, url_col: str) -> DataFrame:
    """(id, url, html, first): ``first`` is the smallest id of the pages of equal payload."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    digest = F.sha1(F.col("html").cast("binary"))
    groups = cut_lineage(rows.select("id", digest.alias("digest")).groupBy("digest")
                         .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return rows.withColumn("digest", digest).join(counted_side(groups, BROADCAST_GROUPS), "digest", "left").drop("digest")


def write_warc(pages: DataFrame, folder: str | None = None, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archive all pages; returns one row for each file: file, n_records."""
    folder = folder or scratch_path(pages.sparkSession, "warc")

    def write(batches):
        path = writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                path, stream = files.open_output(folder, "pages", ".warc.zst")
                writer = WarcWriter(stream)
            for page_id, url, html, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                writer.add(make_record(page_id, url, html.encode(), None if first == page_id else first, date))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"file": [path], "n_records": [writer.records]})

    rows = with_first_of_equals(pages, id_col, html_col, url_col).select("id", "url", "html", "first")
    return cut_lineage(rows.mapInArrow(write, "file string, n_records long"))


def read_warc(written: DataFrame) -> DataFrame:
    """What the archives hold of each page. The digest of a response is taken from its payload again."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def number(text):
        return int(text) if text else None

    def facts(uri):
        with files.open_input(uri) as f:
            for fields, block in read_records(f):
                http, _, payload = block.partition(b"\r\n\r\n")
                said = int(http.rpartition(b"Content-Length: ")[2])
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and (len(payload) != said or payload_digest(payload) != digest):
                    raise ValueError(f"{uri}: the payload of {fields['WARC-Record-ID']} is damaged")
                yield (number(fields["X-Page-Id"]), fields["WARC-Target-URI"], said, digest, fields["WARC-Type"],
                       number(fields.get("X-Refers-To-Page-Id")))

    def read(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows = list(facts(uri))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    return written.select("file").mapInArrow(read, schema)
