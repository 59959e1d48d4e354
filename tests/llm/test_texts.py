"""Operators on texts against brute force: repeats, tokens, shards, decontamination, licences."""

import hashlib
import os
import re
import textwrap
import tracemalloc
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tonetide.config import scratch_path
from tonetide.llm import byte_shards, decontaminate, files, license_lookup, suffix_array, suffix_dedup, token_planes

from .cases import documents, edge_rows, empty, prose, words


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# ---- repeated strings -----------------------------------------------------------------------

def cut_by_hand(rows, length):
    """(id, bytes, removed, spans, sha256) in the order of the documents."""
    seen, out = set(), []
    keyed = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.blake2b((r[1] or "").encode(), digest_size=16).digest()))
    for doc_id, text, *_ in keyed:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("length", [40, 100])
def test_repeats_match_brute_force(spark, length):
    got = suffix_dedup.remove_repeats(documents(spark).repartition(5), length)
    assert rows_of(got, *COLUMNS) == cut_by_hand(edge_rows(), length)


def test_hot_anchors_are_dealt_string_by_string(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_ANCHOR", 2)
    got = suffix_dedup.remove_repeats(documents(spark).repartition(5), 100)
    assert rows_of(got, *COLUMNS) == cut_by_hand(edge_rows(), 100)


@pytest.mark.parametrize("hot", [2, 8192])
def test_repeats_are_found_in_small_slices_and_parts(spark, monkeypatch, hot):
    for name, value in (("HOT_ANCHOR", hot), ("PART_BYTES", 300), ("SLICE_BYTES", 700), ("SEEN_BYTES", 500)):
        monkeypatch.setattr(suffix_dedup, name, value)
    passages = [prose(900 + k, 30) for k in range(4)]
    rows = [(100 + k, f"{prose(1000 + k, 20)} {passages[k % 4]} {prose(2000 + k, 20)} {passages[k * k % 4]}", "en", "a") for k in range(30)]
    got = suffix_dedup.remove_repeats(documents(spark, [*edge_rows(), *rows]).repartition(3), 100)
    assert rows_of(got, *COLUMNS) == cut_by_hand([*edge_rows(), *rows], 100)


def test_memory_of_a_shard_follows_its_parts():
    rnd = np.random.default_rng(5)
    n = 40_000
    bodies = rnd.integers(97, 123, (n, 138)).astype(np.uint8)
    bodies[1::2, 10:128] = bodies[::2, 5:123]
    bodies[1::2, [9, 128]] = ord("A")
    found = array("Q")
    for d, key in enumerate(rnd.integers(0, 1 << 62, n // 2).repeat(2).tolist()):
        found.extend((d, 0, 138, key))
    [(shard, data)] = suffix_dedup.pack_segments(found, 1, [b.tobytes() for b in bodies], np.arange(n), np.zeros(n, np.uint64))
    batch = pa.RecordBatch.from_pydict({"kind": [suffix_dedup.SEGMENTS], "file": ["f"], "data": [data]})
    tracemalloc.start()
    out = list(suffix_dedup.search_shard(100, suffix_dedup.PART_BYTES)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    covered = np.concatenate([np.frombuffer(d, suffix_dedup.COVER) for b in out for d in b.column("data").to_pylist()])
    assert shard == 0 and sorted(covered.tolist()) == [(d, 10, 128) for d in range(1, n, 2)]
    assert peak < 150e6, peak


def test_pieces_of_long_texts(monkeypatch):
    text = (prose(1, 400) + "aaaa" * 60).encode()
    whole = suffix_dedup.text_anchors(text, 100)
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    parts = suffix_dedup.text_anchors(text, 100)
    cover = lambda found: sorted((s, int(h)) for a, b, h in zip(*found) for s in range(a, b))
    assert cover(whole) == cover(parts)
    assert [s for s, _ in cover(parts)] == list(range(len(text) - 99))


def test_kept_texts_and_spans(spark):
    one = suffix_dedup.remove_repeats(documents(spark), 100, with_text=True).where("doc_id = 22").first()
    text = next(t for i, t, *_ in edge_rows() if i == 22).encode()
    left = b"".join(text[a:b] for a, b in zip([0, *[s["end"] for s in one["spans"]]], [*[s["start"] for s in one["spans"]], len(text)]))
    assert one["kept"] == left and one["n_spans"] == len(one["spans"]) == 1


def test_repeats_of_nothing(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_suffix_arrays_and_prefixes_match_sorting():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        s = bytes(rnd.integers(1, 1 + rnd.integers(1, 5), rnd.integers(1, 60)).tolist()) * int(rnd.integers(1, 3))
        t = np.frombuffer(s, np.uint8)
        order = sorted(range(len(s)), key=lambda i: s[i:])
        assert suffix_array.suffix_array(t, len(s)).tolist() == order
        found = suffix_array.common_prefixes(t, np.array(order, np.int32), 24)
        for a, b in zip(order, order[1:]):
            assert found[b] == min(24, len(os.path.commonprefix([s[a:], s[b:]])))


# ---- tokens ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_cached_words_encode_like_whole_texts(vocabulary):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary)
    texts = [r[1] or "" for r in edge_rows()] + ["A.b,c!! x&&& it's 'll ß ÷ × µm ªº  nb \u0085 é K Å", "...", "<|STARTOFTEXT|> Q"]
    for local in (True, False):
        ids, counts = token_planes.encode_texts(texts, vocabulary, local)
        each = [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert counts == [len(e) for e in each]
        assert ids.tolist() == [i for e in each for i in e]


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_plane_files_round_trip(tmp_path, mode, monkeypatch):
    monkeypatch.setattr(token_planes, "CHUNK_IDS", 100)
    docs = [(i, np.random.default_rng(i).integers(0, 2**32, n).astype(np.uint32)) for i, n in enumerate([0, 5, 350, 1, 99, 100])]
    path, stream = files.open_output(str(tmp_path), "t", ".planes")
    w = token_planes.PlaneWriter(stream, mode)
    for d in docs:
        w.add(*d)
    assert w.close() == sum(len(d[1]) for d in docs)
    with files.open_input(path) as f:
        got = [(i, s, np.concatenate([*p, np.zeros(0, np.uint32)])) for i, s, p in token_planes.read_documents(f)]
        index = token_planes.read_index(f)
        assert np.array_equal(token_planes.read_chunk(f, index, 2), np.concatenate([d[1] for d in docs])[200:300])
    at = 0
    for (i, ids), (j, start, back) in zip(docs, got, strict=True):
        assert (i, at) == (j, start) and np.array_equal(ids, back)
        at += len(ids)


def test_token_digests(spark, vocabulary):
    from tokenizers import Tokenizer

    t, at, want = Tokenizer.from_file(vocabulary), 0, []
    for i, text, *_ in sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    written = token_planes.write_tokens(documents(spark).repartition(4), vocabulary)
    assert rows_of(token_planes.read_token_digests(written), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_no_documents_no_token_files(spark, vocabulary):
    written = token_planes.write_tokens(empty(spark), vocabulary)
    assert written.count() == 0 and token_planes.read_token_digests(written).count() == 0


# ---- shards ---------------------------------------------------------------------------------

def test_shards_are_contiguous_and_near_equal(spark):
    got = byte_shards.byte_shards(documents(spark).repartition(6), shards=5).orderBy("row").collect()
    rows = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    total, at, slots = sum(r[1] for r in rows), 0, {}
    for k, ((i, size, crc), g) in enumerate(zip(rows, got, strict=True)):
        shard = min(4, (2 * at + size) * 5 // (2 * total))
        assert (g["doc_id"], g["size"], g["text_crc32"], g["start"], g["row"], g["shard"]) == (i, size, crc, at, k, shard)
        assert g["slot"] == slots.get(shard, 0)
        slots[shard] = g["slot"] + 1
        at += size


def test_shards_of_nothing(spark):
    assert byte_shards.byte_shards(empty(spark)).count() == 0


def test_shards_follow_the_written_order(spark):
    path = scratch_path(spark, "order")
    spark.range(100).select((99 - F.col("id")).alias("doc_id"), F.lit("text").alias("text")).repartition(3).sortWithinPartitions("doc_id").write.parquet(path)
    docs = spark.read.parquet(path)
    got = byte_shards.byte_shards(docs, 4, order=byte_shards.written_order(docs)).orderBy("row").collect()
    want = docs.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()
    assert [g["doc_id"] for g in got] == [w["doc_id"] for w in want]


# ---- decontamination ------------------------------------------------------------------------

def ascii_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def hits_by_hand(rows, items, window):
    out = []
    for i, text, *_ in rows:
        w, hit, found = ascii_words(text), set(), set()
        for item, t in items:
            v = ascii_words(t)
            for s in range(max(1, len(v) - window + 1) if v else 0):
                run = v[s:s + window]
                for p in range(len(w) - len(run) + 1):
                    if w[p:p + len(run)] == run:
                        hit.update(range(p, p + len(run)))
                        found.add(item)
        out.append((i, len(w), len(hit), tuple(sorted(str(f) for f in found if f is not None))))
    return sorted(out, key=repr)


ITEMS = [(1, " ".join(words(3, 60))), (2, "Same LINE\nsame line"), (3, "lone"), (4, None), (5, " - "), (6, " ".join(words(1, 120)[50:64])),
         (6, "one, TWO"), (None, "one two"), (7, "ab " * 12), (8, prose(4, 300)[:90])]


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_decontamination_matches_brute_force(spark, broadcast_rows):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.decontaminate(documents(spark), bench, window=10, broadcast_rows=broadcast_rows)
    found = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()), key=repr)
    assert found == hits_by_hand(edge_rows(), ITEMS, 10)


def test_decontamination_of_and_by_nothing(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.decontaminate(empty(spark), bench).count() == 0
    got = decontaminate.decontaminate(documents(spark), bench.limit(0)).collect()
    assert len(got) == len(edge_rows()) and all(r.n_hit == 0 and r["items"] == [] for r in got)


def test_clean_documents_keep_their_columns(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark)
    clean = decontaminate.clean_documents(docs, bench)
    want = [r[0] for r in hits_by_hand(edge_rows(), ITEMS, 10) if r[2] == 0]
    assert clean.columns == docs.columns
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted(want, key=repr)


# ---- licences -------------------------------------------------------------------------------

def test_licences_of_whole_texts_and_lines(spark):
    full = "The LICENCE grants, whilst it lasts,\nall rights to the programme."
    known = license_lookup.known_notices(spark).union(spark.createDataFrame([("Full-1", full), ("None", "Copyright only")], "license_id string, text string"))
    rows = [(1, "(c) 2020 Some One\nthe license grants while it lasts all rights  to the program", None, None),
            (2, "intro\nReleased under the MIT licence!\nLicensed under CC BY-NC 4.0", None, None),
            (3, None, None, None), (4, "", None, None), (5, "Copyright 2021 X", None, None), (6, "ALL RIGHTS RESERVED", None, None),
            (6, "ALL RIGHTS RESERVED", None, None), (7, "not a licence", None, None), (None, "Released under the MIT License.", None, None)]
    got = license_lookup.license_scan(documents(spark, rows), known)
    found = sorted(((r.doc_id, r.whole, r.notices, r.n_notices) for r in got.collect()), key=repr)
    reserved = (6, ["LicenseRef-all-rights-reserved"], ["LicenseRef-all-rights-reserved"], 1)
    # Row 1 is one line without its copyright line, so that line is the whole text too.
    assert found == sorted([(1, ["Full-1"], ["Full-1"], 1), (2, [], ["CC-BY-NC-4.0", "MIT"], 2), (3, [], [], 0), (4, [], [], 0), (5, [], [], 0),
                            reserved, reserved, (7, [], [], 0), (None, ["MIT"], ["MIT"], 1)], key=repr)


def test_whole_licences_wrapped_embedded_and_headers_are_found(spark):
    known = license_lookup.known_texts(spark)
    texts = {p.stem: p.read_text() for p in license_lookup.TEXTS.glob("*.txt")}
    ids = sorted(set(texts) - {"BSD-3-Clause.regents"})
    assert {"MIT", "Apache-2.0", "GPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "CC0-1.0", "MPL-2.0", "LGPL-3.0", "EPL-2.0"} <= set(ids)
    rows = [(k, texts[i], None, None) for k, i in enumerate(ids)]
    rows += [(100 + k, f"{prose(k, 40)}\nCopyright 2020 Some One\n" + textwrap.fill(" ".join(texts[i].split()), 33) + " " + prose(k, 30), None, None)
             for k, i in enumerate(("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause"))]
    headers = {200: ("MIT", "We say: released under\n  the MIT licence, as before."),
               201: ("Apache-2.0", '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not'),
               202: ("MPL-2.0", " * This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy"),
               203: ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public "
                                 "License as\npublished by the Free Software Foundation, either version 3 of the\nLicense, or (at your option) any later version."),
               204: ("EPL-2.0", "are made available under the terms of the\nEclipse Public License 2.0 which"), 205: ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 X\n\n" + texts["MIT"]),
               206: ("LGPL-2.1", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as "
                                 "published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.")}
    rows += [(k, text, None, None) for k, (_, text) in headers.items()]
    got = {r.doc_id: r for r in license_lookup.license_scan(documents(spark, rows), known).collect()}
    for k, i in enumerate(ids):
        assert got[k].whole == [i] and i in got[k].notices, i
    for k, i in enumerate(("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause")):
        assert got[100 + k].whole == [] and i in got[100 + k].notices, i
    for k, (i, _) in headers.items():
        assert got[k].notices == [i], (k, i)
    assert got[205].whole == ["MIT"] and got[200].n_notices == 1
    assert got[ids.index("GPL-3.0")].n_notices == 1  # its closing example of a header is inside it


def test_licences_of_nothing(spark):
    assert license_lookup.license_scan(empty(spark), license_lookup.known_notices(spark)).count() == 0
