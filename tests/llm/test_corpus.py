"""Operators on corpora against brute force: outliers, near copies, mixing, archives, urls, the pipeline."""

import base64
import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tonetide.config import scratch_path
from tonetide.llm import components, files, ngram_join, pfair_mix, robust_outliers, url_tree, warc_writer

from .cases import documents, edge_rows, empty, prose, words


# ---- quality rules --------------------------------------------------------------------------

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def stats_by_hand(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_statistics_match_brute_force(spark):
    rows = [*edge_rows(), (900, "a b c a b c d # $ | x|y\n \n a b c", "en", "a")]
    for _, text, *_ in rows:
        assert robust_outliers.text_stats(text)[:5] == stats_by_hand(text)
    got = {(r.doc_id, r.n_words, r.base_failed) for r in robust_outliers.quality_report(documents(spark, rows)).collect()}
    want = set()
    for i, text, *_ in rows:
        n, _, _, _, repeated = stats_by_hand(text)
        want.add((i, n, n < 50 or 100 * repeated > 50 * n))
    assert got == want


def corpus_with_junk(copies=0):
    rows = [(k, prose(k, 60 + k % 200), "en", f"s{k % 2}") for k in range(900)]
    rows += [(5000 + k, prose(1, 200), "en", "s0") for k in range(copies)]
    junk = [(1000 + k, " ".join(f"{w}{'#$%&'[i % 4] * 3}" for i, w in enumerate(words(k, 120))), "en", f"s{k % 2}") for k in range(60)]
    shout = [(2000 + k, " ".join(w.upper() + "!!" for w in words(k, 120)), "en", f"s{k % 2}") for k in range(60)]
    return rows, junk + shout


@pytest.mark.parametrize("copies", [0, 500])
def test_outliers_go_and_clean_documents_stay(spark, copies):
    clean, junk = corpus_with_junk(copies)
    kept = {r.doc_id for r in robust_outliers.quality_report(documents(spark, clean + junk)).where("kept").collect()}
    assert kept == {r[0] for r in clean}


def test_small_pools_keep_what_passes_the_base_rules(spark):
    docs = documents(spark)
    kept = robust_outliers.keep_good(docs)
    assert kept.columns == docs.columns
    report = robust_outliers.quality_report(docs)
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, (r.doc_id for r in report.where("kept").collect())))
    assert {r.doc_id for r in report.where("not base_failed").collect()} >= {10, 11, 26}


def test_quality_of_nothing(spark):
    assert robust_outliers.quality_report(empty(spark)).count() == 0
    assert robust_outliers.keep_good(empty(spark)).count() == 0


# ---- near copies ----------------------------------------------------------------------------

def sets_by_hand(rows):
    out = {}
    for i, text, *_ in rows:
        w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def classes_by_hand(rows):
    sets = sets_by_hand(rows)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sets if i is not None and sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), None if i is None else find(i)) for i in sets}


def near_copies(seed):
    """Chains (a like b, b like c, a unlike c), a base with many copies, and a passage in many documents."""
    rnd, rows = random.Random(seed), []
    base = words(seed, 90)
    for k in range(30):
        own = base[:]
        for _ in range(rnd.randint(0, 6)):
            own[rnd.randrange(90)] = f"x{rnd.randrange(10**6)}"
        rows.append((k, " ".join(own), "en", "a"))
    passage = words(seed + 1, 40)
    for k in range(30):
        own = words(seed + 2 + k, rnd.randint(2, 20))
        rows.append((100 + k, " ".join(own + passage if k % 2 else passage + own), "en", "a"))
    chain = words(seed + 99, 100)
    for k in range(8):
        rows.append((200 + k, " ".join(chain[6 * k:] + words(seed + 500, 60)[:6 * k]), "en", "b"))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [edge_rows(), near_copies(5), near_copies(77)], ids=["edges", "near", "more"])
@pytest.mark.parametrize("hot", [64, 3])
def test_classes_match_brute_force(spark, rows, hot, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_LEAST", hot)
    got, pairs = ngram_join.near_duplicates(documents(spark, rows).repartition(4))
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == classes_by_hand(rows)
    assert got.count() == len(rows)
    sets = sets_by_hand(rows)
    for a, b in pairs.collect():
        assert 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])


def test_links_span_the_classes(spark):
    rows = near_copies(5)
    _, pairs = ngram_join.near_duplicates(documents(spark, rows).repartition(4))
    first = {}  # smallest id of each set
    for i, tokens in sorted(sets_by_hand(rows).items()):
        first.setdefault(frozenset(tokens), i)
    label = {r.vertex: r.label for r in components.components(pairs).collect()}
    want = {i: c for i, _, c in classes_by_hand(rows)}
    assert {i: label.get(i, i) for i in first.values()} == {i: want[i] for i in first.values()}


def test_near_copies_of_nothing(spark):
    got, pairs = ngram_join.near_duplicates(empty(spark))
    assert got.count() == 0 and pairs.count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(300, 299), (7, 7), (299, 300)]
    got = {r.vertex: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {299: 299, 300: 299}
    assert got == want


# ---- mixing ---------------------------------------------------------------------------------

def test_every_block_is_in_its_window_and_less_than_one_block_off():
    weights = pfair_mix.whole_weights({"a": 5.0, "b": 1.0, "c": 0.01, "d": 2.5, "e": 0.0})
    total, done = sum(weights.values()), Counter()
    assert total == pfair_mix.RESOLUTION and "e" not in weights
    for source, j, slot in pfair_mix.cycle(weights):
        w = weights[source]
        assert j == done[source] and j * total // w <= slot < -(-(j + 1) * total // w)
        done[source] += 1
        assert all(abs(done[s] * total - (slot + 1) * weights[s]) < total for s in weights)
    assert done == weights


@pytest.mark.parametrize("n", [5, 10, 50, 200])
def test_no_source_drifts_from_its_exact_target(n):
    targets = {"a": 0.5, "tiny": 0.0002} | {k: 0.4998 / (n - 2) for k in map(str, range(n - 2))}
    total = sum(map(Fraction, targets.values()))
    exact = {s: Fraction(v) / total for s, v in targets.items()}
    length = 20_000
    weights = pfair_mix.whole_weights(targets, pfair_mix.EXACT)
    done, placed = Counter(), pfair_mix.slots(weights, dict.fromkeys(targets, length))
    for at, (source, block, slot) in zip(range(length), placed):
        assert slot == at and block == done[source]
        done[source] += 1
        assert abs(done[source] - (slot + 1) * exact[source]) < 1
        if at % 997 == 0 or at == length - 1:
            assert all(abs(done[s] - (slot + 1) * exact[s]) < 1 for s in targets)


def test_weights_are_the_targets_and_small_ones_end_soon():
    assert pfair_mix.whole_weights({"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.04, "e": 0.01}) == {"a": 500, "b": 300, "c": 150, "d": 40, "e": 10}
    weights = pfair_mix.whole_weights({"a": 1.0, "b": 1e-9, "c": 1e-9}, pfair_mix.EXACT)
    total, placed = sum(weights.values()), list(pfair_mix.slots(weights, {"a": 5, "b": 300, "c": 300}))
    assert len(placed) == 605 and len({slot for _, _, slot in placed}) == 605
    assert all(k * total // weights[s] <= slot < -(-(k + 1) * total // weights[s]) for s, k, slot in placed)


@pytest.mark.parametrize("length", [1, 2, 5, 23])
def test_segments_keep_every_block_in_its_window(length):
    rnd = random.Random(length)
    for _ in range(300):
        weights = {str(s): rnd.randint(1, rnd.choice([5, 40, 1000])) ** rnd.choice([1, 3]) for s in range(rnd.randint(1, 9))}
        total = sum(weights.values())
        blocks = {s: rnd.choice([rnd.randint(0, 60), w * 200 // total + 1]) for s, w in weights.items()}
        placed = list(pfair_mix.slots(weights, blocks, length))
        assert Counter(s for s, _, _ in placed) == Counter({s: n for s, n in blocks.items() if n})
        assert len({at for _, _, at in placed}) == len(placed)
        assert all(k * total // weights[s] <= at < -(-(k + 1) * total // weights[s]) for s, k, at in placed)


def test_less_than_one_block_off_over_many_segments():
    weights = pfair_mix.whole_weights({str(s): (s + 1) ** 2.5 for s in range(40)} | {"tiny": 0.01}, pfair_mix.EXACT)
    total, done, length = sum(weights.values()), Counter(), 20_000
    for at, (source, _, slot) in zip(range(length), pfair_mix.slots(weights, dict.fromkeys(weights, length), 97)):
        assert slot == at  # full load: no slot is empty, over 206 segments
        done[source] += 1
        assert abs(done[source] * total - (slot + 1) * weights[source]) < total
        if at % 501 == 0:
            assert all(abs(done[s] * total - (slot + 1) * w) < total for s, w in weights.items())


def test_segments_side_by_side_give_the_schedule(spark):
    rows = [(f"={k}", 1000 * (k + 1) ** 2, 20 + 60 * k) for k in range(8)]
    sources = spark.createDataFrame(rows, "_source string, bytes long, blocks long")
    got = pfair_mix.schedule(sources, 0.5, None, pfair_mix.EXACT, segment=50).collect()
    weights = pfair_mix.whole_weights({s: float(size) ** 0.5 for s, size, _ in rows}, pfair_mix.EXACT)
    assert sorted(map(tuple, got)) == sorted(pfair_mix.slots(weights, {s: n for s, _, n in rows}, 50))


def test_equal_rows_are_all_mixed(spark):
    rows = [(None, "same", "en", "a")] * 500 + [(1, "same", "en", "a")] * 300 + [(2, "other", "en", "b")]
    docs = documents(spark, rows)
    assert sorted(map(repr, pfair_mix.mixed(docs).collect())) == sorted(map(repr, docs.collect()))
    path = scratch_path(spark, "mixed-rows")
    docs.write.parquet(path)
    read = spark.read.parquet(path)
    by_row = pfair_mix.mixed(read, row=[F.col("_metadata.file_name"), F.col("_metadata.row_index")])
    assert by_row.columns == docs.columns and sorted(map(repr, by_row.collect())) == sorted(map(repr, docs.collect()))


def test_mixed_slots_keep_the_exact_targets(spark):
    rows = [(k, "x" * 84, "en", "a" if k < 1500 else f"s{k % 50}") for k in range(3000)]
    targets = {"a": 0.5} | {f"s{k}": 0.01 for k in range(50)}
    got = pfair_mix.mix_positions(documents(spark, rows), targets=targets, block_bytes=100).collect()
    assert len(got) == 3000
    for r in got:  # one document for each block: 1 of 2 slots is of a, 1 of 100 of each other source
        every = 2 if r._source == "=a" else 100
        assert r.block * every <= r.slot < (r.block + 1) * every


def test_positions_follow_the_schedule(spark):
    rows = [(k, prose(k, 30 + k % 50), "en", None if k % 17 == 0 else "abcd"[min(3, k % 7)]) for k in range(400)]
    targets = {"a": 0.5, "b": 0.3, "d": 0.1, None: 0.1}
    got = pfair_mix.mix_positions(documents(spark, rows).repartition(5), targets=targets, block_bytes=2000).orderBy("position").collect()
    weights = pfair_mix.whole_weights({"null" if s is None else f"={s}": v for s, v in targets.items()})
    slot = {(s, j): at for s, j, at in pfair_mix.cycle(weights)}
    assert [r.position for r in got] == list(range(400)) and sorted(r.id for r in got) == list(range(400))
    want = []
    for source in {r._source for r in got}:
        at = 0
        for i, text, _, s in sorted(r for r in rows if ("null" if r[3] is None else f"={r[3]}") == source):
            block = at // 2000
            w = weights.get(source)
            want.append(((block // w) * sum(weights.values()) + slot[source, block % w] if w else 1 << 62, source, i))
            at += len(text.encode()) + 16
    assert [r.id for r in got] == [i for _, _, i in sorted(want)]
    assert [r.id for r in got][-sum(r[3] == "c" for r in rows):] == sorted(r[0] for r in rows if r[3] == "c")  # no weight: last


def test_mixed_documents_are_all_there_in_order(spark):
    docs = documents(spark)
    mixed = pfair_mix.mixed(docs)
    assert mixed.columns == docs.columns
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, docs.collect()))
    at = {r.id: r.position for r in pfair_mix.mix_positions(docs).collect()}
    order = [at[r.doc_id] for r in mixed.collect() if r.doc_id not in (None, 14)]
    assert order == sorted(order)
    assert pfair_mix.mixed(empty(spark)).count() == 0


# ---- archives -------------------------------------------------------------------------------

PAGES = [(5, "http://a.example/x", "<p>same</p>"), (3, "http://b.example/y z\r\nX: 1", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://c.example", None),
         (2, "http://c.example/2", ""), (4, "http://ü.example/é", "<p>ünïcode\r\n\r\nWARC/1.1 漢字</p>"), (6, "u", "x" * 300_000), (None, "n", "<p>no id</p>"), (7, "u", "<p>no id</p>"),
         (8, "r", "<p>again</p>"), (8, "r", "<p>again</p>")]


def archived_by_hand(rows):
    out = []
    for i, _, html in rows:
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(ids, default=None)
        b = (html or "").encode()
        own = i == first or first is None
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if own else "revisit", None if own else first))
    return sorted(out, key=repr)


@pytest.mark.parametrize("copies", [1, 40])
def test_archives_read_back(spark, copies):
    rows = PAGES + [(100 + k, f"http://h.example/{k}", f"<html><head><title>Page {k}</title></head><p>{prose(k, 80)}</p></html>") for k in range(20 * copies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit("x")).withColumn("digest", F.lit(1))
    written = warc_writer.write_warc(pages.repartition(3))
    got = warc_writer.read_warc(written)
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == archived_by_hand(rows)
    assert got.where("page_id = 3").first()["url"] == "http://b.example/y%20z%0D%0AX:%201"
    for r in written.collect():
        with files.open_input(r.file) as f:
            assert f.read(4) == (0x184D2A5D).to_bytes(4, "little")


def test_no_pages_no_archives(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    written = warc_writer.write_warc(pages)
    assert written.count() == 0 and warc_writer.read_warc(written).count() == 0


# ---- urls -----------------------------------------------------------------------------------

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def rule_by_hand(host, path):
    best = None
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best


def parts_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


URLS = ["http://WWW.Example.ORG/es/1?x#y", "https://example.org/en/12", "https://example.org/en/2", "http://a.com/fr/1", "http://a.com/de/2/", "http://xcom/de/2",
        "http://com/de/", "no scheme", None, "", "http://", "http://É.org?q=/es/", "x://h#f", "http://a.net/p\nq", "http://u:p@a.com:80/fr/", "a://b://c/d"]


def test_hosts_paths_and_rules(spark):
    rows = [(k, u, "x") for k, u in enumerate(URLS)] + [(0, URLS[0], "x"), (None, URLS[1], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, template string").withColumn("bad", F.lit(9)).withColumn("host", F.lit("q"))
    labels = spark.createDataFrame([(0, 1), (0, 0), (99, 1)], "page_id long, bad int")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_tree.url_filter(pages, labels, RULES).collect()), key=repr)
    want = []
    for i, u, _ in rows:
        host, path = parts_by_hand(u)
        fits = rule_by_hand(host, path)
        want.append((i, host, path, fits and fits[1], fits[0] if fits else "allow"))
    assert got == sorted(want, key=repr)


def test_bad_templates_go_and_like_branches_merge(spark):
    rows, labels = [], []
    for k in range(600):
        section = ("news", "sport", "spam")[k % 3]
        rows.append((k, f"http://h.net/{section}/{k}.html"))
        labels.append((k, int(section == "spam" or k % 50 == 0)))
    rows += [(1000 + k, f"http://h.net/user/name-{words(k, 1)[0]}{'abcdefghij'[k % 10]}{k}/page") for k in range(200)]
    rows += [(2000 + k, f"http://other.net/spam/{k}.html") for k in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in url_tree.url_filter(pages, spark.createDataFrame(labels, "page_id long, bad int"), []).collect()}
    assert all((got[k].verdict == "block") == (k % 3 == 2) for k in range(600))
    assert got[0].template == got[1].template == "/*/*.html" and got[2].template == "/spam/*.html"
    assert len({got[1000 + k].template for k in range(200)}) == 1 and got[1000].verdict == "allow"
    assert all(got[2000 + k].verdict == "allow" for k in range(30))  # another host without labels


def filtered(spark, rows):
    """Results by page of (url, bad or None) rows without rules."""
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(k, b) for k, (_, b) in enumerate(rows) if b is not None], "page_id long, bad int")
    return {r.page_id: r for r in url_tree.url_filter(pages, labels, []).collect()}


def names(n):
    return [f"{a}{b}" for a in "abcdefgh" for b in "klmnopqr"][:n]


@pytest.mark.parametrize("depth", [0, 11])
def test_a_heavy_bad_branch_among_many_rare_ones_goes(spark, depth):
    """60 bad pages in one branch, 90 clean ones in 29 small branches; also below the former eight levels."""
    below = "".join(f"/{d}" for d in "abcdefghijk"[:depth])
    rows = [(f"http://h.net{below}/spam/{k}", 1) for k in range(60)]
    rows += [(f"http://h.net{below}/{names(29)[k % 29]}/{k}", 0) for k in range(90)]
    got = filtered(spark, rows)
    assert {got[k].verdict for k in range(60)} == {"block"} and {got[k].template for k in range(60)} == {f"{below}/spam/*"}
    assert {got[k].verdict for k in range(60, 150)} == {"allow"} and {got[k].template for k in range(60, 150)} == {f"{below}/*~0/*"}


def test_a_very_deep_path_is_one_template(spark):
    deep = "http://h.net" + "/x" * 500
    got = filtered(spark, [(deep, 0)] + [(f"http://h.net{'/y' * 12}/{name}", 0) for name in names(40)])
    assert got[0].template == "/x" * 500 and {got[k].template for k in range(1, 41)} == {"/y" * 12 + "/*~0"}


def test_a_heavy_bad_branch_of_numbers_is_not_mixed_with_rare_ones(spark):
    rows = [(f"http://h.net/{k}/x", 1) for k in range(60)] + [(f"http://h.net/{names(29)[k % 29]}/x", 0) for k in range(90)]
    got = filtered(spark, rows)
    assert {got[k].verdict for k in range(60)} == {"block"} and {got[k].verdict for k in range(60, 150)} == {"allow"}


def test_small_siblings_dont_bridge_unlike_large_ones(spark):
    """Bad of labelled: 50/1000, 1/4, 1/2, 900/1000."""
    rows = [(f"http://h.net/{s}/{k}", int(k < bad)) for s, bad, n in (("a", 50, 1000), ("b", 1, 4), ("c", 1, 2), ("d", 900, 1000)) for k in range(n)]
    got = filtered(spark, rows)
    by = {s: {(r.template, r.verdict) for k, r in got.items() if f"h.net/{s}/" in rows[k][0]} for s in "abcd"}
    assert by["a"] == by["b"] == {("/*/*", "allow")} and by["c"] == by["d"] == {("/*~2/*", "block")}


def test_a_class_takes_no_name_of_a_sibling(spark):
    """Numbers are bad, two words are clean: the class of the words is not the branch of the numbers."""
    rows = [(f"http://h.net/{k}/x", 1) for k in range(200)] + [(f"http://h.net/{'ab'[k % 2]}/x", 0) for k in range(200)]
    got = filtered(spark, rows)
    assert {(got[k].template, got[k].verdict) for k in range(200)} == {("/*/x", "block")}
    assert {(got[k].template, got[k].verdict) for k in range(200, 400)} == {("/*~1/x", "allow")}


def test_urls_of_nothing(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_tree.url_filter(none, spark.createDataFrame([], "page_id long, bad int"), RULES).count() == 0


# ---- the pipeline ---------------------------------------------------------------------------

def test_stages_hand_on_their_documents(spark, tmp_path):
    """Each stage against brute force on its own input."""
    clean, junk = corpus_with_junk()
    rows = clean + junk + [(3000 + k, r[1], *r[2:]) for k, r in enumerate(clean[:40])]
    near = [(4000 + k, r[1].replace(" ", " extra ", 1), *r[2:]) for k, r in enumerate(r for r in clean if len(r[1].split()) > 150)][:30]
    rows += near
    items = [(1, " ".join(clean[5][1].split()[20:34])), (2, "short item")]
    documents(spark, rows).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, held = docs.columns, {r[0]: r for r in rows}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        if k < 4:
            assert docs.columns == columns
        if name == "quality_rules":
            assert after == before - {r[0] for r in junk}
        elif name == "near_duplicates":
            assert after == {c for _, _, c in classes_by_hand([held[i] for i in sorted(before)])}
        elif name == "decontamination":
            assert before - after == {5}
        else:
            assert after == before
    assert docs.count() == len(after)
    assert docs.groupBy("shard").agg((F.max("slot") + 1 - F.count("slot")).alias("gap")).where("gap <> 0").count() == 0


def test_pipeline_runs_on_the_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and out.select("doc_id").distinct().count() == out.count()
