"""N-gram Jaccard self-join by a grouped prefix join, and the classes that its links form.

A document is the set of its word shingles, as 64-bit hashes. Documents of equal sets are one node.

1. Read the texts in slices of ``SLICE_BYTES``: (document, set size, set name), and the shingles that a
   share of 1/HOT_SHARE of a slice's sets hold. Summed, these give the hot shingles of the corpus: at
   most HOT_SHARE times the mean set size of them, whatever the number of documents.
2. Read the texts again: each slice sends its other shingles to buckets by hash (as many as the counted
   shingles ask for), as packed arrays of (set in the slice, shingle). A bucket counts its shingles and
   sends those that at least two sets hold back to their slice. A slice then knows, for each set, all
   shingles that any other set shares, with their frequency. All others are unique to the set.
3. Global order: rarest first, ties by hash. A set of n shingles has a prefix of n - ceil(0.75 n) + 1;
   unique shingles come first in it and can't match. Sets without a shared shingle in their prefix
   have no partner and leave here.
4. Sets of identical prefix and size are collapsed into one group. Groups that share a prefix token
   are paired with the most central group of its list (the one whose shingles are most frequent), and
   members with the first of their group; pairs pass the length and the positional bound and are
   verified. Their links give preliminary classes.
5. Lists whose members are all in one class are done. In the others the pairs of members of different
   classes are formed, pass the bounds, and are verified. The smaller set of a pair must hold the token in
   the shorter prefix n - ceil(2t/(1+t) n) + 1 (sets that share boilerplate too small a part to link
   don't even meet), lists are split by bands of lengths, and members of a list's largest class meet
   only others. No link between different classes is lost, and pairs inside a class, which can't
   change the result, are never formed.

Verification is on the whole shared sets: sizes and the exact number of common shingles. Hashes stand
for shingles: two different shingles of a pair of sets with m shingles agree with a probability
of about m^2 / 2^65.

Defined results:
* null or blank text: no shingles, linked with nothing; its class is its own id;
* fewer words than ``size``: the whole word sequence is the one shingle;
* null ids: listed with a null class; they link nothing;
* equal ids are one document in the classes: it has the links of all its texts;
* an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import cut_lineage, scratch_path
from .components import components
from .spans import windows_of, word_hashes

HOT_SHARE = 512
SLICE_BYTES = 2 << 20  # of text whose shingles are held at a time
HOT_RUN = 2_000_000  # shingles among which frequent ones are counted at a time, about
BUCKET_SHINGLES = 1_000_000  # in a bucket, about
HOT_LEAST = 64  # a token of fewer sets isn't hot in any corpus


# ---- in tasks -------------------------------------------------------------------------------

def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; A-Z lower-cased, six ASCII blanks separate."""
    words = word_hashes((text or "").encode().lower())  # of bytes: ASCII only
    return np.unique(windows_of(words, min(size, len(words)))) if len(words) else words


def set_name(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def slices(batches):
    """Runs of rows with at most ``SLICE_BYTES`` of text, or one row: what is held at a time doesn't follow the texts' lengths."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False))
        lo, before = 0, 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield batch.slice(lo, hi - lo)
            lo, before = hi, int(ends[hi - 1])


def batch_sets(batch, size: int) -> tuple[list[np.ndarray], list[bytes], list[int]]:
    """Sets and names of the texts of a slice, and the first place of each distinct non-empty set."""
    sets = [shingles(t.as_py(), size) for t in batch.column(batch.num_columns - 1)]
    names = [set_name(s) for s in sets]
    first = {}
    for i, (name, tokens) in enumerate(zip(names, sets, strict=True)):
        if len(tokens):
            first.setdefault(name, i)
    return sets, names, list(first.values())


def packed(at: np.ndarray, tokens: np.ndarray, df: np.ndarray | None = None) -> bytes:
    head = np.array([len(tokens)], "<u4").tobytes()
    return head + tokens.astype("<u8").tobytes() + at.astype("<u4").tobytes() + (b"" if df is None else df.astype("<u4").tobytes())


def unpacked(blob: bytes, with_df: bool = False) -> tuple[np.ndarray, ...]:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    out = np.frombuffer(blob, "<u4", n, 4 + 8 * n), np.frombuffer(blob, "<u8", n, 4)
    return (*out, np.frombuffer(blob, "<u4", n, 4 + 12 * n)) if with_df else out


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


# ---- steps 1 to 3 ---------------------------------------------------------------------------

def read_facts(size: int):
    """Facts of each slice, and the frequent shingles of each run of slices (so rare ones aren't sent from small slices)."""
    none = lambda k, t: pa.nulls(k, t)

    def frequent(held: dict[bytes, np.ndarray]):
        tokens, counts = np.unique(np.concatenate(list(held.values())), return_counts=True)
        often = (counts >= 2) & (counts * HOT_SHARE >= len(held))
        k = int(often.sum())
        return pa.RecordBatch.from_arrays(
            [none(k, pa.int64()), pa.array(counts[often], pa.int64()), none(k, pa.binary()), pa.array(tokens[often].view(np.int64), pa.int64())],
            ["doc_id", "n", "name", "token"])

    def read(batches):
        held: dict[bytes, np.ndarray] = {}  # distinct sets since the last count
        for batch in slices(batches):
            sets, names, first = batch_sets(batch, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()),
                 none(len(sets), pa.int64())], ["doc_id", "n", "name", "token"])
            held |= {names[i]: sets[i] for i in first}
            if sum(map(len, held.values())) >= HOT_RUN:
                yield frequent(held)
                held = {}
        if held:
            yield frequent(held)

    return read


def facts(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, n, name) of documents and rows (token, n) of shingles frequent in a slice."""
    rows = docs.mapInArrow(read_facts(size), "doc_id long, n long, name binary, token long")
    path = scratch_path(docs.sparkSession, "shingle-facts")
    rows.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def hot_tokens(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted tokens, frequencies) of the shingles that at least 1 of HOT_SHARE sets hold.

    The list is bounded: its frequencies sum to at most all shingles, so it has at most HOT_SHARE times
    the mean set size entries.
    """
    sets = rows.where("token is null and n > 0").select(F.approx_count_distinct("name").alias("sets"))
    least = F.greatest(F.col("sets") / F.lit(HOT_SHARE), F.lit(HOT_LEAST))
    sums = rows.where("token is not null").groupBy("token").agg(F.sum("n").alias("df"))
    found = sums.where(F.col("df") >= F.greatest(sets.scalar() / F.lit(HOT_SHARE), F.lit(HOT_LEAST))).collect()
    tokens = np.array([r.token for r in found], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.array([r.df for r in found], np.int64)[order]


def read_buckets(size: int, hot: np.ndarray, buckets: int):
    """(bucket, batch, kind, data): kind 0 packed shingles, kind 1 the names, sizes and hot shingles of a slice.

    A slice (column ``batch``) is named by what it holds, so a repeated task gives the same rows.
    """
    def read(batches):
        for batch in slices(batches):
            sets, names, first = batch_sets(batch, size)
            if not first:
                continue
            own = [sets[i] for i in first]
            sizes = np.array([len(s) for s in own], np.uint32)
            tokens = np.concatenate(own)
            at = np.repeat(np.arange(len(own), dtype=np.uint32), sizes)
            joined = b"".join(names[i] for i in first)
            batch_id = hashlib.blake2b(joined + repr(batch.column(0)[0].as_py()).encode(), digest_size=16).digest()
            is_hot = np.isin(tokens, hot)
            head = np.array([len(own)], "<u4").tobytes() + joined + sizes.astype("<u4").tobytes() + packed(at[is_hot], tokens[is_hot])
            rows = [(int.from_bytes(batch_id[:4], "little") % buckets, batch_id, 1, head)]
            tokens, at = tokens[~is_hot], at[~is_hot]
            to = (tokens % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(buckets + 1))
            rows += [(b, batch_id, 0, packed(at[order[lo:hi]], tokens[order[lo:hi]]))
                     for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo]
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.binary())], ["bucket", "batch", "kind", "data"])

    return read


def count_bucket(table: pa.Table) -> pa.Table:
    """Shingles of a bucket that two or more sets hold, back to their batches."""
    batches, kinds, data = (table.column(c).to_pylist() for c in ("batch", "kind", "data"))
    parts = [unpacked(d) for d, k in zip(data, kinds, strict=True) if k == 0]
    out = [(b, 1, d) for b, k, d in zip(batches, kinds, data, strict=True) if k == 1]
    if parts:
        at, tokens = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        order = np.argsort(tokens, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(tokens[order]) != 0)))
        df = np.empty(len(tokens), np.uint32)
        df[order] = np.repeat(np.diff(np.append(cuts, len(tokens))), np.diff(np.append(cuts, len(tokens))))
        keep = df > 1
        at, tokens, of, df = at[keep], tokens[keep], of[keep], df[keep]
        edges = np.searchsorted(of, np.arange(len(parts) + 1))
        ids = [b for b, k in zip(batches, kinds, strict=True) if k == 0]
        out += [(ids[i], 0, packed(at[lo:hi], tokens[lo:hi], df[lo:hi])) for i, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]
    cols = list(zip(*out)) or [(), (), ()]
    return pa.table({"batch": pa.array(cols[0], pa.binary()), "kind": pa.array(cols[1], pa.int32()), "data": pa.array(cols[2], pa.binary())})


def merge_batch(hot: np.ndarray, hot_df: np.ndarray, percent: int):
    """Sets of a batch that can have a partner: name, n, shared shingles in the global order, prefix."""
    def merge(table: pa.Table) -> pa.Table:
        kinds, data = table.column("kind").to_pylist(), table.column("data").to_pylist()
        head = next(d for d, k in zip(data, kinds, strict=True) if k == 1)  # twice if a batch is repeated
        n = int(np.frombuffer(head, "<u4", 1)[0])
        names = [head[4 + 16 * i: 20 + 16 * i] for i in range(n)]
        sizes = np.frombuffer(head, "<u4", n, 4 + 16 * n).astype(np.int64)
        hot_at, hot_token = unpacked(head[4 + 20 * n:])
        parts = [(hot_at, hot_token, hot_df[np.searchsorted(hot, hot_token)] if len(hot) else np.zeros(0, np.int64))]
        parts += [unpacked(d, True) for d, k in zip(data, kinds, strict=True) if k == 0]
        at, tokens, df = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((tokens, df, at))
        at, tokens, df = at[order].astype(np.int64), tokens[order], df[order].astype(np.int64)
        fresh = np.ones(len(at), bool)  # a repeated batch sends everything twice
        fresh[1:] = (at[1:] != at[:-1]) | (tokens[1:] != tokens[:-1])
        at, tokens, df = at[fresh], tokens[fresh], df[fresh]
        cuts = np.searchsorted(at, np.arange(n + 1))
        rows = []
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            size, unique = int(sizes[i]), int(sizes[i]) - int(hi - lo)
            in_prefix = prefix_length(size, percent) - unique
            if in_prefix > 0:
                own = tokens[lo:hi]
                prefix = own[:in_prefix]
                group = set_name(prefix) if unique == 0 else names[i]
                rows.append((names[i], size, unique, float(np.log2(df[lo:hi]).sum() / size), group,
                             prefix.view(np.int64).tolist(), np.sort(own).tobytes()))
        cols = list(zip(*rows)) or [()] * 7
        types = [pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
        return pa.table({c: pa.array(v, t) for c, v, t in zip(NODE_COLUMNS, cols, types, strict=True)})

    return merge


NODE_COLUMNS = ["name", "n", "n_unique", "central", "prefix_name", "prefix", "tokens"]
NODE_SCHEMA = "name binary, n long, n_unique long, central double, prefix_name binary, prefix array<long>, tokens binary"


def partnered_sets(docs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Distinct sets that share a prefix token with another row, written once."""
    spark = docs.sparkSession
    hot, hot_df = hot_tokens(rows)
    total = rows.where("token is null").agg(F.sum("n").alias("n")).collect()[0].n or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_SHINGLES + 1)
    sent = docs.mapInArrow(read_buckets(size, hot, buckets), "bucket int, batch binary, kind int, data binary")
    counted = sent.groupBy("bucket").applyInArrow(
        count_bucket, "batch binary, kind int, data binary")
    nodes = counted.groupBy("batch").applyInArrow(merge_batch(hot, hot_df, percent), NODE_SCHEMA)
    path = scratch_path(spark, "shingle-sets")
    nodes.write.parquet(path)
    return spark.read.parquet(path)


# ---- steps 4 and 5 --------------------------------------------------------------------------

def can_link(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Length bound, and the positional bound for a common token at these places of the order."""
    length = F.least(na, nb) * 100 >= F.greatest(na, nb) * percent
    rest = 1 + F.least(na - pa_, nb - pb) - 1
    return length & (rest * (100 + percent) >= (na + nb) * percent)


def verify(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the similarity."""
    side = nodes.select("id", "n", "tokens")
    both = (pairs.join(side.toDF("a", "na", "ta"), "a").join(side.toDF("b", "nb", "tb"), "b")
            .select("a", "b", "na", "nb", "ta", "tb"))

    def check(batches):
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            same = np.array([len(np.intersect1d(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), True))
                             for x, y in zip(batch.column(4), batch.column(5), strict=True)], np.int64)
            ok = pa.array(100 * same >= percent * (na + nb - same), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(ok)

    return both.mapInArrow(check, "a long, b long")


def open_pairs(nodes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different classes that share a prefix token and pass the bounds (step 5)."""
    place = F.posexplode("prefix").alias("k", "token")
    # The smaller set of a pair needs a common token in a shorter prefix, and lengths in neighbouring bands.
    listed = (nodes.select("id", "n", "n_unique", place).join(classes.withColumnRenamed("vertex", "id"), "id", "left")
              .select("token", "id", "n", (F.col("n_unique") + F.col("k")).alias("pos"), F.coalesce("label", "id").alias("label")))
    sizes = listed.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c"))
    open_lists = sizes.groupBy("token").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    least = F.floor((F.lit(2 * percent) * F.col("n") + (99 + percent)) / (100 + percent))  # common shingles of two sets of this size, rounded up
    level = F.log(F.col("n").cast("double")) / math.log(100 / percent)  # sets that link are at most 1 apart
    left = cut_lineage(listed.join(open_lists.drop("labels"), "token").withColumns(
        {"minor": F.col("label") != F.col("main"), "indexed": F.col("pos") < F.col("n") - least + 1, "band": F.floor(level).cast("int")}).drop("main"))
    bands = F.sequence(F.floor(level - 1e-6).cast("int"), F.floor(level + 1 + 1e-6).cast("int"))
    small = left.where("indexed").withColumn("band", F.explode(bands)).select(
        "token", "band", *[F.col(c).alias(f"s_{c}") for c in ("id", "n", "pos", "label", "minor")])

    def meet(small: DataFrame, large: DataFrame) -> DataFrame:
        return (small.join(large, ["token", "band"]).where(F.col("label") != F.col("s_label"))
                .where(F.struct("s_n", "s_id") < F.struct("n", "id"))
                .where(can_link(F.col("n"), F.col("pos"), F.col("s_n"), F.col("s_pos"), percent))
                .select(F.least("id", "s_id").alias("a"), F.greatest("id", "s_id").alias("b")))

    # Two members of a list's largest class need no pair: the small side, the large side or both are of other classes.
    return meet(small.where("s_minor"), left).union(meet(small.where("not s_minor"), left.where("minor"))).distinct()


def links(nodes: DataFrame, same: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(verified links, classes of the linked nodes); ``same`` holds pairs of vertices that are one document."""
    place = F.posexplode("prefix").alias("k", "token")
    group = nodes.groupBy("n", "prefix_name").agg(F.max_by("id", F.struct("central", "id")).alias("rep"), F.max("central").alias("central"))
    members = nodes.join(group.select("n", "prefix_name", "rep"), ["n", "prefix_name"])
    inside = members.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    reps = members.where("id = rep").select("id", "n", "central", "n_unique", place).withColumn("pos", F.col("n_unique") + F.col("k"))
    leads = reps.groupBy("token").agg(F.max(F.struct("central", "id", "n", "pos")).alias("l"), F.count(F.lit(1)).alias("c"))
    star = (reps.join(leads.where("c > 1").drop("c"), "token").where("id <> l.id")
            .where(can_link(F.col("l.n"), F.col("l.pos"), F.col("n"), F.col("pos"), percent))
            .select(F.col("l.id").alias("a"), F.col("id").alias("b")))
    first = cut_lineage(verify(star.union(inside).distinct(), nodes, percent))
    classes = cut_lineage(components(first.union(same)))

    second = cut_lineage(verify(open_pairs(nodes, classes, percent), nodes, percent))
    # Links between classes join their labels; labels of the joined classes name the classes anew.
    label = classes.toDF("v", "label")
    bridged = (second.join(label.toDF("a", "la"), "a", "left").join(label.toDF("b", "lb"), "b", "left")
               .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    upper = components(bridged).toDF("label", "top")
    final = (classes.join(upper, "label", "left").select("vertex", F.coalesce("top", "label").alias("label"))
             .union(upper.select(F.col("label").alias("vertex"), F.col("top").alias("label"))).distinct())
    return first.union(second), cut_lineage(final)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, n_shingles, component_id; links: pairs a, b of class representatives).

    A link's ends are the smallest ids of documents of equal sets; ``documents`` has the membership.
    Links are no full join: every one is true and they span each class, but further links between sets
    that already share a class are not formed.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = facts(texts, size)
    members = rows.where("token is null").drop("token")
    ids = members.where("n > 0 and doc_id is not null").groupBy("name").agg(F.min("doc_id").alias("id"))
    # A vertex is the smallest id of a set. Sets of one id meet in that id: each joins the smallest vertex among them.
    several = (members.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("name").alias("x"), F.max("name").alias("y"))
               .where("x <> y").select("doc_id"))
    shared = members.where("n > 0").join(several, "doc_id").select("doc_id", "name").distinct().join(ids, "name")
    same = cut_lineage(shared.select(F.col("doc_id").alias("a"), F.col("id").alias("b")).where("a <> b").distinct())
    sets = partnered_sets(texts, rows, size, percent)
    # Copies in several slices give equal rows of a set: one stays.
    nodes = cut_lineage(sets.join(ids, "name").dropDuplicates(["name"]).drop("name"))
    pairs, classes = links(nodes, same, percent)
    named = ids.join(classes, ids["id"] == classes["vertex"], "left").select("name", F.coalesce("label", "id").alias("class"))
    out = (members.join(named, "name", "left")
           .select("doc_id", F.col("n").alias("n_shingles"),
                   F.when(F.col("doc_id").isNull(), None).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("class")).alias("component_id")))
    return out, pairs
