"""Toxicity, conversation repair, vector codes, and hard inputs of earlier operators, against brute force and planted cases."""

import hashlib
import heapq
import itertools
import math
import random
import re
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tonetide.llm import cell_codes, ngram_join, robust_outliers, spans, suffix_array, suffix_dedup, token_planes, toxicity, turn_repair, url_tree

from .cases import documents, edge_rows, empty, prose

# ---- toxicity -------------------------------------------------------------------------------

INSULTS = ["zubbel", "krontz"]


def toxic_rows(n=400):
    """Every fifth text holds a sentence with an insult; stems also occur with endings."""
    rows, labels, rnd = [], [], random.Random(5)
    for k in range(n):
        text = prose(1000 + k, 30 + k % 90)
        if k % 5 == 0:
            text = text + " You " + rnd.choice(INSULTS) + rnd.choice(["", "", "er", "ig"]) + ", go.\n" + prose(5000 + k, 30)
        rows.append((k, text, "en", "a"))
        labels.append((k, int(k % 5 == 0)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = toxic_rows()
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), (9999, 1)], "doc_id long, toxic int").withColumn("text", F.lit("zubbel"))
    return toxicity.fit(documents(spark, rows), lab.where("doc_id is null or doc_id < 300"))


def test_held_out_documents_and_their_sentences(spark, learned):
    rows, labels = toxic_rows()
    got = {r.doc_id: r for r in toxicity.score(documents(spark, rows), learned).where("doc_id >= 300").collect()}
    for doc_id, y in labels[300:]:
        assert (got[doc_id].score >= 0.3) == bool(y), got[doc_id]
        if y:
            data = rows[doc_id][1].encode()
            [span] = got[doc_id].sentences
            assert any(w in data[span.start:span.end].decode() for w in INSULTS) and b"." not in data[span.start:span.end]


def test_noisy_or_of_sentences(learned):
    text = "Nice day. You zubbel! A krontzig one?\nFine"
    found = learned.sentences(text.encode())
    assert [text[a:b] for a, b, _ in found] == ["You zubbel", "A krontzig one"]
    assert toxicity.noisy_or([p for *_, p in found]) == pytest.approx(1 - math.prod(1 - p for *_, p in found))
    # a word counts once in a sentence, and case does not matter
    assert learned.sentences(b"zubbel ZUBBEL Zubbel")[0][2] == learned.sentences(b"zubbel")[0][2]


def test_slices_do_not_change_features(learned, monkeypatch):
    text = (prose(3, 700) + " zubbel " + "x" * 3000 + " krontzer.").encode()
    want = learned.sentences(text)
    monkeypatch.setattr(toxicity, "SLICE", 7)
    assert learned.sentences(text) == want and want


def test_toxicity_edges(spark, learned):
    got = toxicity.score(documents(spark), learned).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 and r.sentences == [] for r in got if r.doc_id in (15, 16, 17))
    assert toxicity.score(empty(spark), learned).count() == 0
    none = toxicity.fit(documents(spark), spark.createDataFrame([(10, 1), (11, 1)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(documents(spark), none).collect()} == {0.0}
    assert len(toxicity.fit(empty(spark), spark.createDataFrame([], "doc_id long, toxic int")).features) == 0


# ---- conversation repair --------------------------------------------------------------------

FORM = re.compile("(s?(ua)+)?")


def cheapest(symbols):
    """(cost, audit) by best-first search over (cost, audit so far)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        key = (i, roles[-1:], "s" in roles)
        if key in done:
            continue
        done.add(key)
        if i == len(symbols) and FORM.fullmatch(roles):
            return cost, audit
        moves = [(5, "I", i, "u"), (5, "I", i, "a")]
        if i < len(symbols):
            moves.append((2, "D", i + 1, ""))
            if symbols[i]:
                own, more = "sua?"[(symbols[i] - 1) // 2], 5 * ((symbols[i] - 1) % 2)
                moves += [(more, "K", i + 1, own), (1 + more, "R", i + 1, "u"), (1 + more, "R", i + 1, "a")]
        for c, letter, j, role in moves:
            if re.fullmatch("s?(ua)*u?", roles + role):
                heapq.heappush(heap, (cost + c, audit + letter, j, roles + role))


def test_tables_match_search():
    tables, rnd = turn_repair.Tables(), random.Random(2)
    cases = [c for n in range(4) for c in itertools.product(range(9), repeat=n)]
    cases += [tuple(rnd.randrange(9) for _ in range(rnd.randrange(4, 14))) for _ in range(800)]
    for case in cases:
        assert tables.repair(bytes(case)) == cheapest(case), case


def by_hand(rows, damaged):
    """{conv: result} of rows (conv, turn, role, text)."""
    def spaced(x):
        return " " if x is None else str(x)

    chats = {}
    for conv, turn, role, text in rows:
        own = chats.setdefault(conv, [])
        role, text = spaced(role), spaced(text)
        k = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20 if damaged else -1
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        if k:
            own += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = {}
    for conv, own in chats.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        symbols, seen, stats = [], set(), [0, 0, 0]
        for _, role, text in own:
            last = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                stats[fault] += 1
            symbols.append(0 if fault in (0, 1) else 1 + 2 * ("sua".find(role[0]) if role[:1] in tuple("sua") else 3) + (fault == 2))
        turns = [t for t, *_ in own if t is not None]
        cost, audit = cheapest(symbols)
        left, made, need = list(own), [], "user"
        for letter in audit:
            row = None if letter == "I" else left.pop(0)
            if letter == "D":
                continue
            if letter == "K" and row[1][0] == "s":
                made.append((row[1], row[2]))
                continue
            made.append((row[1] if letter == "K" else need, "" if letter == "I" else row[2]))
            need = "assistant" if need == "user" else "user"
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *stats,
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


def chat_rows():
    rnd, rows = random.Random(11), []
    texts = ["Yes.", "No!", "why?", "cut off", "", " \n\t", "Ça va.", "e.g. this", None, "odd ", "two\nlines.", "\x1c"]
    for conv in range(60):
        for turn in range(rnd.randrange(1, 9)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]) if conv % 3 else ("user", "assistant")[turn % 2]
            rows.append((conv, rnd.choice([turn, turn, turn + 3, None]), role, rnd.choice(texts)))
    rows += [(None, t, r, "Fine.") for t, r in ((1, "user"), (2, "assistant"), (None, "user"), (9, "assistant"))]
    rows += rows[20:26]  # repeated rows
    rows += [(7000, t // 2, ("user", "assistant")[t % 2], f"t{t % 40}" + ".?x"[t % 3]) for t in range(150)]  # long, with copies
    rows += [(7001, None, "user", f"n{t}.") for t in range(40)]  # all turns null
    return rows


@pytest.mark.parametrize("damaged", [False, True])
@pytest.mark.parametrize("long_rows, piece", [(4096, 1 << 16), (6, 4)])
def test_repair_matches_brute_force(spark, monkeypatch, damaged, long_rows, piece):
    monkeypatch.setattr(turn_repair, "LONG", long_rows)
    monkeypatch.setattr(turn_repair, "PIECE", piece)
    rows = chat_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit("x")).withColumn("part", F.lit(1))
    got = turn_repair.repair(df, damaged=damaged)
    assert got.columns == ["conv", *turn_repair.FIELDS]
    assert {r.conv: tuple(r)[1:] for r in got.collect()} == by_hand(rows, damaged)


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.repair(df, damaged=True).count() == 0
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "All of it.")], df.schema)
    assert [tuple(r) for r in turn_repair.repair(df, damaged=True).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


# ---- vector codes ---------------------------------------------------------------------------

def codes_by_hand(rows, parts, entries, rounds):
    """({id: (codes, error)}, codebooks) in Python integers; rows (id, vector), one row for each id."""
    kept = sorted((i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v))
    whole = {i: [math.floor(Fraction(x) * 256) for x in v] for i, v in kept}
    size = len(kept[0][1])
    whole = {i: w for i, w in whole.items() if len(w) == size}
    step = size // parts
    cut = {i: [w[p * step:(p + 1) * step] for p in range(parts)] for i, w in whole.items()}
    books = [[cut[i][p] for i in list(cut)[:entries]] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = {}
            for w in cut.values():
                own.setdefault(nearest(book, w[p])[1], []).append(w[p])
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else old for e, old in enumerate(book)]
    got = {i: [nearest(book, w[p]) for p, book in enumerate(books)] for i, w in cut.items()}
    return {i: ([e for _, e in c], sum(d for d, _ in c)) for i, c in got.items()}, books


def vector_rows(seed, wide=False):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([rnd.gauss(0, .2), rnd.gauss(0, 3), 0.0, -1 / 256]) for _ in range(12)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(150)]  # equal vectors
    rows += [(900, None), (901, [0.0] * 11 + [None]), (902, [math.nan] * 12), (903, [math.inf] * 12)]
    if wide:
        rows += [(3, [1e9 * x for x in rows[3][1]])] + [(950 + i, [rnd.gauss(0, 1) * 10 ** (4 * i) for _ in range(12)]) for i in range(8)]
        rows = list(dict(rows).items())
    return rows


@pytest.mark.parametrize("wide, cache", [(False, 1 << 16), (False, 40), (True, 1 << 16)])
def test_codes_match_brute_force(spark, monkeypatch, wide, cache):
    monkeypatch.setattr(cell_codes, "CACHE", cache)
    rows = vector_rows(4, wide)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(None).cast("int")).withColumn("v", F.lit(1))
    kept = cell_codes.kept_vectors(df.repartition(3), "vec_id", "embedding", "label")
    books = cell_codes.fit_codebooks(kept, parts=4, entries=20, rounds=2)
    want, plain = codes_by_hand(rows, 4, 20, 2)
    assert [b.tolist() for b in books.books] == plain
    assert books.sha256() == hashlib.sha256(",".join(str(x) for b in plain for c in b for x in c).encode()).hexdigest()
    got = {r.vec_id: (r.codes, r.error) for r in cell_codes.encode(kept, books).collect()}
    assert got == {i: (c, min(e, cell_codes.LONG_MAX)) for i, (c, e) in want.items()}


def test_a_cell_keeps_every_entry_that_is_nearest_in_its_box():
    rng = np.random.default_rng(1)
    index = cell_codes.CellIndex(rng.integers(-40, 40, (30, 3)))
    index.side = 8
    cells = rng.integers(-7, 7, (50, 3))
    points = np.array(list(itertools.product(range(8), repeat=3)))
    some = 0
    for cell, own in zip(cells, index.candidates(cells), strict=True):
        inside = cell * 8 + points
        dist = ((inside[:, None] - index.book) ** 2).sum(axis=2)
        winners = {int(e) for e in np.flatnonzero((dist == dist.min(axis=1)[:, None]).any(axis=0))}
        assert winners <= set(own.tolist())
        some += len(own) < 30
    assert some > 40  # most cells drop most entries


def test_code_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    none = cell_codes.kept_vectors(spark.createDataFrame([], schema), "vec_id", "embedding", "label")
    assert cell_codes.fit_codebooks(none) is None and cell_codes.encode(none, None).count() == 0
    rows = [(1, [0.5] * 4, 1), (None, [0.25] * 4, None), (2, [0.5] * 3, 1), (3, [], 1), (1, [0.25] * 4, 2)]
    kept = cell_codes.kept_vectors(spark.createDataFrame(rows, schema), "vec_id", "embedding", "label")
    books = cell_codes.fit_codebooks(kept, parts=2, entries=4, rounds=1)
    assert len(books.books[0]) == 1  # the only id of this length
    got = sorted(((r.vec_id, r.codes, r.error) for r in cell_codes.encode(kept, books).collect()), key=repr)
    assert [g[1] for g in got] == [[0, 0], [0, 0], None, None, [0, 0]]
    with pytest.raises(ValueError):
        cell_codes.fit_codebooks(kept, parts=3)


# ---- hashes of spans, and near copies under hard inputs -------------------------------------

def thue_morse(n, a="a", b="b"):
    return "".join(a if bin(k).count("1") % 2 == 0 else b for k in range(n))


def test_regular_strings_get_different_hashes(spark):
    x, y = thue_morse(4096), thue_morse(4096, "b", "a")
    data = np.frombuffer((x + y + y + "b").encode(), np.uint8)
    assert suffix_array.differ(data, np.array([0, 4096, 8192]), np.array([4096, 8192, 12288])).tolist() == [True, False]
    assert suffix_array.differ(data, np.array([4096, 8192, 8192]), np.array([8192, 12288, 12289])).tolist() == [False, True]
    assert robust_outliers.text_stats(f"p q {x} p q {y}")[4] == 0
    assert robust_outliers.text_stats(f"p q {x} p q {x}")[4] == 6
    rows = [(1, f"a b c d {x}", "en", "a"), (2, f"a b c d {y}", "en", "a"), (3, f"A B c d {x}", "en", "a")]
    got, _ = ngram_join.near_duplicates(documents(spark, rows))
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 2, 3: 1}
    cut = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(
        documents(spark, [(1, x, "en", "a"), (2, y, "en", "a"), (3, "zz" + x, "en", "a")]), length=4096).collect()}
    assert cut == {1: 0, 2: 0, 3: 4096}


def test_word_hashes_of_pieces():
    text = prose(1, 5000).encode()
    whole = spans.word_hashes(text)
    assert len(whole) == 5000 and (spans.word_hashes(text, 100) == whole).all()
    assert len(spans.word_hashes(b"")) == len(spans.word_hashes(b" \n")) == 0
    assert (spans.windows_of(whole, 5)[7:9] == spans.windows_of(whole[7:13], 5)).all()


def test_longest_repeats(spark):
    """The largest length that is allowed."""
    rnd = random.Random(3)
    body = "".join(rnd.choice("abcdefgh") for _ in range(130_000))
    rows = [(1, body, "en", "a"), (2, "x" + body[1000:100_000] + "y", "en", "a"), (3, body[:59_999], "en", "a")]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(documents(spark, rows), length=60_000).collect()}
    assert got == {1: (0, 0), 2: (99_000, 1), 3: (0, 0)}


def test_a_hot_passage_is_cut_from_all_but_the_first(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_ANCHOR", 5)
    passage = prose(77, 40)
    rows = [(k, prose(100 + k, 40) + " | " + passage + " | " + prose(300 + k, 40), "en", "a") for k in range(40)]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(documents(spark, rows).repartition(3), length=100).collect()}
    seen = set()
    for k, text, *_ in rows:
        data = text.encode()
        strings = [data[i:i + 100] for i in range(len(data) - 99)]
        hit = {i + j for i, x in enumerate(strings) if x in seen for j in range(100)}
        seen |= set(strings)
        assert got[k] == len(hit) and (k == 0 or got[k] >= len(passage.encode()))


def test_sets_of_one_id_hand_on_their_links(spark):
    def like(seed):
        return prose(seed, 120), prose(seed, 120).replace(" ", " extra ", 1)

    (a, a2), (b, b2) = like(1), like(2)
    rows = [(1, a, "en", "a"), (1, b, "en", "a"), (2, a2, "en", "a"), (3, b2, "en", "a"), (9, prose(3, 80), "en", "a"),
            (8, prose(3, 80), "en", "a"), (9, prose(4, 80), "en", "a"), (10, prose(4, 80), "en", "a"), (11, None, "en", "a")]
    for parts in (1, 5):
        got, _ = ngram_join.near_duplicates(documents(spark, rows).repartition(parts))
        assert {(r.doc_id, r.component_id) for r in got.collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8), (10, 8), (11, 11)}


def test_boilerplate_makes_no_pairs(spark):
    """Texts that share 80 % boilerplate have a similarity of two thirds: none of their pairs is formed."""
    shared = prose(5, 400)
    rows = [(k, prose(10_000 + k, 104) + " " + shared, "en", "a") for k in range(600)]
    docs = documents(spark, rows).select("doc_id", "text")
    facts = ngram_join.facts(docs, 5)
    ids = facts.where("token is null").groupBy("name").agg(F.min("doc_id").alias("id"))
    nodes = ngram_join.partnered_sets(docs, facts, 5, 75).join(ids, "name").drop("name")
    none = spark.createDataFrame([], "vertex long, label long")
    assert nodes.count() == 600 and ngram_join.open_pairs(nodes, none, 75).count() == 0
    got, _ = ngram_join.near_duplicates(docs)
    assert got.where("component_id <> doc_id").count() == 0


@pytest.mark.parametrize("rows_n", [40, 160])
def test_memory_does_not_follow_the_rows_of_a_batch(rows_n):
    text = prose(1, 20_000)
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows_n), pa.int64()), pa.array([f"w{k} " + text for k in range(rows_n)])], ["doc_id", "text"])
    for read in (ngram_join.read_facts(5), ngram_join.read_buckets(5, np.zeros(0, np.uint64), 16)):
        tracemalloc.start()
        for out in read([batch]):
            assert out.num_rows
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 80 << 20


def test_one_row_of_each_group_stays(spark):
    """Null ids, repeated rows and one id with two texts: the pipeline's stage keeps one row of a class."""
    base, other = prose(1, 120), prose(2, 120)
    near = base.replace(" ", " extra ", 1)
    rows = [(5, base, "en", "a"), (5, base, "en", "a"), (None, near, "en", "a"), (None, base, "en", "a"), (7, near, "en", "a"),
            (None, other, "en", "b"), (None, other, "en", "b"), (9, prose(3, 90), "en", "b"), (9, prose(4, 90), "en", "b"), (11, "", "en", "a")]
    docs = documents(spark, rows)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(5, base), (None, other), (9, min(prose(3, 90), prose(4, 90))), (11, "")], key=repr)


# ---- deep paths and many files --------------------------------------------------------------

def test_deep_paths_take_rounds_only_where_they_branch(spark, monkeypatch):
    """Two pages of 60 levels that differ at each of them, a chain of 80, and one deep family."""
    rounds = []
    plain = url_tree.cut_lineage
    monkeypatch.setattr(url_tree, "cut_lineage", lambda df: rounds.append(1) or plain(df))
    rows = [(1, "http://a.org/" + "/".join("abcdefgh"[k % 8] + "x" for k in range(60))), (2, "http://a.org/" + "/".join("abcdefgh"[k % 8] + "y" for k in range(60))),
            (3, "http://b.org/" + "/".join(f"s{chr(97 + k % 26)}" for k in range(80)))]
    deep = "http://c.org/" + "/".join("abcdefgh"[k % 8] for k in range(40))
    rows += [(10 + k, f"{deep}/{'uvw'[k % 3]}/end") for k in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(10 + k, int(k % 3 == 0)) for k in range(30)], "page_id long, bad int")
    got = {r.page_id: r for r in url_tree.url_filter(pages, labels, []).collect()}
    assert len(rounds) <= 5 and len(got) == 33
    assert {got[k].verdict for k in (1, 2, 3)} == {"allow"} and len({got[k].template for k in (1, 2, 3)}) == 3
    by = {s: {got[10 + k].verdict for k in range(30) if "uvw"[k % 3] == s} for s in "uvw"}
    assert by == {"u": {"block"}, "v": {"allow"}, "w": {"allow"}}


def test_token_files_are_bounded(spark, monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = documents(spark, [*edge_rows(), *[(7, prose(k, 9), "en", "a") for k in range(40)]])
    want = sorted(map(tuple, token_planes.read_token_digests(token_planes.write_tokens(docs.coalesce(1), vocabulary)).collect()), key=repr)
    monkeypatch.setattr(token_planes, "FILE_DOCS", 3)
    written = token_planes.write_tokens(docs.coalesce(1), vocabulary)
    assert max(r.n_docs for r in written.collect()) == 3
    got = token_planes.read_token_digests(written).collect()
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted((w[2], w[3]) for w in want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):  # no gap between documents, ids in order
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
