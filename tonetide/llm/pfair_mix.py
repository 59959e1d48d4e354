"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are laid out in id order and cut into blocks of ``block_bytes``. Block k of a
source of weight w (a share of 1) is released at slot floor(k / w) and due at slot ceil((k + 1) / w);
in every slot the released block of the earliest deadline goes next. One slot holds one block, and
the weights sum to 1, so every block keeps its window and each source is at all times less than one
block away from its share.

Weights are the targets themselves, as whole numbers that sum to ``resolution`` (10^15, so rounding moves
a source by one block in 10^15 slots at most). No short cycle repeats: the slots of all blocks are
simulated. The slot axis is cut into segments of about ``segment`` blocks. At a cut some blocks are open,
that is released before it and due after it. One task over the table of sources (one row for each) decides at each
cut which of them go before it (``quotas``), in the time of a sort of the sources; the segments are then
scheduled side by side, each block in its own window as far as that lies in the segment.

* Before cut t every source has floor(w t) blocks or one more, t in all, so its remainder carries over.
* Earliest deadline first fills a segment without a miss if no run of slots is the whole room of more
  blocks than it has slots. Inside a segment that is so for any weights. At its ends it is so if, of the
  open blocks due by any slot (and released by any slot), at most as many wait as the parts of these blocks
  that lie after the cut add up to, rounded up. Both are chains of nested sets, for which the greedy choice of
  ``quotas`` finds the full number.
* ``slot``: a source that has run out keeps its slots, empty, up to the first cut at which those that still
  run have less than 1/RUNNING_SHARE of the weight. From there on a free slot may take any block that is released.
  Before and after, every block has a slot of its own in its own window. Every document is placed once.

Blocks, not documents, carry the promise: a document is in the block where its first byte falls.
Positions come from prefix sums over range partitions, so a source that holds a third of all rows is
split by position like any other.

Defined results:
* null source: a source of its own; null id: before all other ids; null text: ``overhead`` bytes;
* repeated ids and rows: each row is placed; ties go by size, then checksum, then (``mixed``) by row;
* weights given for some sources only: the others get weight 0 and follow after all blocks in order;
* an empty table gives an empty result; extra columns don't matter (``mixed`` keeps them all).
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from itertools import islice
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import cut_lineage
from .byte_shards import ROW_OVERHEAD, text_bytes, with_global_prefix

BLOCK_BYTES = 1 << 16
RESOLUTION = 1000  # of a cycle that is written out
EXACT = 10 ** 15  # of the weights that documents are mixed by
SEGMENT = 1 << 18  # steps of a segment, about: scheduled by one task
RUNNING_SHARE = 8  # empty slots are stepped through while at least 1/8 of the weight runs
LAST = 1 << 62


def whole_weights(shares: dict, resolution: int = RESOLUTION) -> dict:
    """Whole numbers, at least 1 each, that sum to the resolution (largest remainders get the rest).

    Shares are taken as written in decimal, so 0.3 of 1000 is 300. Only a share under 1 is raised, at
    the cost of the largest.
    """
    shares = {s: Fraction(repr(v)) for s, v in shares.items() if v > 0}
    resolution = max(resolution, 4 * len(shares))
    total = sum(shares.values())
    exact = {s: v / total * resolution for s, v in shares.items()}
    out = {s: max(1, int(v)) for s, v in exact.items()}
    by_rest = sorted(exact, key=lambda s: (out[s] - exact[s], s))
    for s in by_rest[: max(0, resolution - sum(out.values()))]:
        out[s] += 1
    while sum(out.values()) > resolution:
        out[max(out, key=lambda s: (out[s], s))] -= 1
    return out


def windows(weight: int, total: int, block: int) -> tuple[int, int]:
    """Release and deadline of a source's block."""
    return block * total // weight, -(-(block + 1) * total // weight)


def nested_bounds(parts: dict[int, int], at: dict[int, int], total: int) -> tuple[list[int], list[int]]:
    """The distinct times of ``at`` and, up to each, the sum of the parts (of ``total``), rounded up."""
    sums: dict[int, int] = defaultdict(int)
    for s, part in parts.items():
        sums[at[s]] += part
    times, bounds, upto = sorted(sums), [], 0
    for t in times:
        upto += sums[t]
        bounds.append(-(-upto // total))
    return times, bounds


def quotas(weights: list[int], total: int, begin: int, end: int, done: list[int]) -> list[int]:
    """Blocks of each source before slot ``end``, from those ``done`` before ``begin``; they sum to ``end``.

    Releases are gone through from the last to the first. Each level has room for so many waiting blocks
    of its own or a later release; those of the latest deadlines take it, as they are in the fewest sets.
    """
    out = [w * end // total for w in weights]
    parts = {s: total - w * end % total for s, w in enumerate(weights) if w * end % total}  # of an open block, after the cut
    opened = {s: windows(weights[s], total, out[s]) for s in parts}
    released, due = {s: max(begin, o[0]) for s, o in opened.items()}, {s: o[1] for s, o in opened.items()}
    levels, room = nested_bounds(parts, released, total)
    deadlines, free = nested_bounds(parts, due, total)
    rank, free = {t: i for i, t in enumerate(deadlines)}, np.array(free)
    entering = defaultdict(list)
    for s in parts:
        if done[s] <= out[s]:  # else the open block lies before this segment
            entering[released[s]].append(s)
    waiting, pool = set(), []
    for k in reversed(range(len(levels))):
        for s in entering[levels[k]]:
            heapq.heappush(pool, (-rank[due[s]], s))
        left = room[k] - (room[k - 1] if k else 0)
        while left and pool and free[-pool[0][0]:].min() > 0:
            r, s = heapq.heappop(pool)
            free[-r:] -= 1
            waiting.add(s)
            left -= 1
    out = [n + (s in parts and s not in waiting) for s, n in enumerate(out)]
    if sum(out) != end:
        raise AssertionError(f"{sum(out)} blocks before slot {end}")
    return out


def segments(weights: dict, blocks: dict, length: int = SEGMENT) -> Iterator[tuple[int, int, list]]:
    """(begin, end, [(source, weight, total, first, last, blocks)]): blocks first..last - 1 of each source in slots begin..end - 1.

    Sources that have run out (last > blocks) have rows while their slots stay empty. After that a segment
    is as long as the others need for ``length`` blocks, so its steps never exceed about ``length``.
    """
    shared = gcd(*weights.values())
    names, whole = list(weights), [w // shared for w in weights.values()]
    total, wanted = sum(whole), [blocks[s] for s in names]
    end, done = 0, [0] * len(names)
    while running := sum(w for w, n, b in zip(whole, wanted, done) if b < n):
        keep = RUNNING_SHARE * running >= total
        begin, before, end = end, done, end + (length if keep else -(-length * total // running))
        done = quotas(whole, total, begin, end, before)
        rows = [(s, w, total, b, d if keep else min(d, n), n) for s, w, n, b, d in zip(names, whole, wanted, before, done)]
        rows = [row for row in rows if row[3] < row[4]]
        if any(row[3] < row[5] for row in rows):
            yield begin, end, rows


def place(begin: int, end: int, rows: list) -> Iterator[tuple[object, int, int]]:
    """(source, block, slot) of a segment's blocks, earliest deadline first."""
    def opened(at, block):
        _, weight, total, _, last, _ = rows[at]
        release, due = windows(weight, total, block)
        return (max(begin, release), min(end, due), at, block) if block < last else None

    later = [x for at, row in enumerate(rows) if (x := opened(at, row[3]))]
    heapq.heapify(later)
    ready, slot = [], begin
    while later or ready:
        if not ready:
            slot = max(slot, later[0][0])
        while later and later[0][0] <= slot:
            _, due, at, block = heapq.heappop(later)
            heapq.heappush(ready, (due, rows[at][0], at, block))
        due, source, at, block = heapq.heappop(ready)
        if slot >= due:
            raise AssertionError(f"block {block} of {source} misses slot {due}")
        if block < rows[at][5]:
            yield source, block, slot
        if after := opened(at, block + 1):
            heapq.heappush(later, after)
        slot += 1


def slots(weights: dict, blocks: dict, length: int = SEGMENT) -> Iterator[tuple[object, int, int]]:
    """(source, block, slot) of the first ``blocks`` blocks of each source, segment after segment."""
    for segment in segments(weights, blocks, length):
        yield from place(*segment)


def cycle(weights: dict) -> list[tuple[object, int, int]]:
    """(source, j, slot): the slot of each source's j-th block in one cycle of as many slots as the weights' sum."""
    return list(slots(weights, weights))


def source_name(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def schedule(sources: DataFrame, power: float, targets: dict | None, resolution: int, segment: int = SEGMENT) -> DataFrame:
    """(_source, block, slot) of every block of the sources with a weight, from (_source, bytes, blocks).

    One task has the whole table of sources, one row for each, and sends on the segments' quotas. Each
    segment is a group of its own: one row for each source goes in, one for each of its blocks comes out.
    """
    plan = pa.schema([("segment", pa.int64()), ("begin", pa.decimal128(38)), ("end", pa.decimal128(38)), ("_source", pa.string()),
                      ("weight", pa.int64()), ("total", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("blocks", pa.int64())])

    def cut(batches):
        table = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        if targets is None:
            shares = {s: float(size) ** power for s, size, _ in table}
        else:
            known = {"null" if k is None else f"={k}": v for k, v in targets.items()}
            shares = {s: known.get(s, 0.0) for s, _, _ in table}
        weights = whole_weights(shares, resolution)
        planned = segments(weights, {s: n for s, _, n in table}, segment) if weights else ()
        for k, (begin, end, rows) in enumerate(planned):
            columns = [[k] * len(rows), [Decimal(begin)] * len(rows), [Decimal(end)] * len(rows), *zip(*rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, plan)], schema=plan)

    def fill(table):
        begin, end = int(table["begin"][0].as_py()), int(table["end"][0].as_py())
        rows = sorted(zip(*(table[c].to_pylist() for c in ["_source", "weight", "total", "first", "last", "blocks"])))
        placed, parts = place(begin, end, rows), []
        while some := list(islice(placed, 1 << 16)):
            s, block, slot = zip(*some)
            parts.append(pa.table({"_source": pa.array(s, pa.string()), "block": pa.array(block, pa.int64()),
                                   "slot": pa.array([min(at, LAST - 1) for at in slot], pa.int64())}))
        return pa.concat_tables(parts)

    width = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sources.select("_source", "bytes", "blocks").repartition(1).mapInArrow(
        cut, "segment long, begin decimal(38,0), end decimal(38,0), _source string, weight long, total long, first long, last long, blocks long")
    # The number is given because the rows are few and the work behind them is not.
    return (cuts.repartition(width, "segment").groupBy("segment")
            .applyInArrow(fill, "_source string, block long, slot long"))


def mix_positions(docs: DataFrame, power: float = 0.5, targets: dict | None = None, block_bytes: int = BLOCK_BYTES,
                  resolution: int = EXACT, id_col: str = "doc_id", source_col: str = "source",
                  text_col: str = "text", overhead: int = ROW_OVERHEAD, segment: int = SEGMENT,
                  row: list[Column] | None = None) -> DataFrame:
    """(id, size, crc, source, block, slot, position) of every document in mixture order.

    Target weights are ``targets`` (source -> share) or, by default, the sources' bytes to ``power``.
    Columns ``row`` that name a row come along as _r0, _r1, ... and break ties.
    """
    named = [c.alias(f"_r{k}") for k, c in enumerate(row or [])]
    keys = [f"_r{k}" for k in range(len(named))]
    narrow = docs.select(F.col(id_col).alias("id"), source_name(source_col).alias("_source"),
                         (text_bytes(F.col(text_col)) + F.lit(overhead)).alias("size"),
                         F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"), *named)
    laid = cut_lineage(with_global_prefix(narrow, ["_source", "id", "size", "crc", *keys], "size"))
    sources = laid.groupBy("_source").agg(F.min("start").alias("first"), F.max("start").alias("last"), F.sum("size").alias("bytes"))
    block = F.floor((F.col("start") - F.col("first")) / F.lit(block_bytes)).cast("long")
    counted = sources.withColumn("blocks", F.floor((F.col("last") - F.col("first")) / F.lit(block_bytes)).cast("long") + 1)
    plan = cut_lineage(schedule(counted, power, targets, resolution, segment))
    blocks = laid.join(sources.select("_source", "first"), "_source").withColumn("block", block)
    placed = (blocks.join(plan, ["_source", "block"], "left")
              # A source without weight follows after everything else.
              .withColumn("slot", F.coalesce("slot", F.lit(LAST)))
              .select("id", "_source", "size", "crc", "block", "slot", F.col("start").alias("laid"), *keys))
    ordered = with_global_prefix(placed, ["slot", "_source", "laid"], "size")
    return ordered.select("id", "size", "crc", "_source", "block", "slot", F.col("row").alias("position"), *keys)


def mixed(docs: DataFrame, power: float = 0.5, targets: dict | None = None, id_col: str = "doc_id",
          source_col: str = "source", text_col: str = "text", row: list[Column] | None = None) -> DataFrame:
    """The documents with their own columns, sorted in mixture order.

    Rows meet their positions by ``row``: columns that no two rows share, such as the file and the place in
    it of a table read from Parquet. Without them the documents are written once, to number them.
    """
    if row is None:
        rows = cut_lineage(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                                       F.monotonically_increasing_id().alias("_r0")))
        narrow = rows.select(*[F.col("_doc").getField(c).alias(n) for c, n in [(id_col, "id"), (source_col, "source"), (text_col, "text")]], "_r0")
        at = mix_positions(narrow, power, targets, id_col="id", source_col="source", text_col="text", row=[F.col("_r0")])
    else:
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                           *[c.alias(f"_r{k}") for k, c in enumerate(row)])
        at = mix_positions(docs, power, targets, id_col=id_col, source_col=source_col, text_col=text_col, row=row)
    keys = [c for c in rows.columns if c != "_doc"]
    return rows.join(at.select(*keys, "position"), keys).orderBy("position").select("_doc.*")
