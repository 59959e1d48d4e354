"""Conversation structure repair by Four-Russians block tables.

The rows of a conversation, by turn, become symbols; the cheapest edits bring its role initials into the
form ``(s?(ua)+)?``. Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (the only one for blank and
duplicate rows), Insert an empty user or assistant row 5; a truncated row that stays adds 5. Of all cheapest
edit strings the one whose letters are least in ASCII is taken.

The cost to finish from each of four states (start, after s, after u, after a) is a vector. Less its
minimum it is one of few vectors, so ``Tables`` holds, for every such vector and every block of ``BLOCK``
symbols, the vector before the block and the cost it adds. A conversation is passed backward by one
lookup a block. Then, forward, each block is expanded backward from its right-hand vector to the
vectors inside it, and the least letter that keeps the cost is taken: which letter that is, is a
table too (by vector, symbol and state).

Spark range-partitions the rows by (conversation, turn), into as many partitions as the counted bytes ask
for, and sorts them; a task streams its partition and finishes each conversation that neither begins nor
ends it. The others ("open", at most two a partition, but any length) are written and finished together: a
grouped minimum finds duplicates, every piece of a conversation becomes one byte a row, and one row per
conversation gathers these bytes, as long as its audit. Texts of open conversations are then
streamed in order through one hash each. So a hot conversation is split for everything but its SHA-256,
which has no parallel form, and no task holds its texts.

Results: nulls of conversation and turn are one space in the damage key, nulls of role and text are one
space; null turns sort first and don't count for gaps; a null conversation id is a conversation. Rows of one turn
are ordered by role and text (bytes). An empty text is blank. Roles of other initials can be reroled or
deleted only. A conversation without rows: zeros, empty audit, hash of nothing. An empty table gives
an empty result; other columns than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..config import scratch_path

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 3
# Symbols: 0 a row to delete; else 1 + 2 * initial (s, u, a, other) + truncated.
SYMBOLS = 9
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEVER = 1 << 20
NEXT = {START: ("u", AFTER_U), AFTER_S: ("u", AFTER_U), AFTER_U: ("a", AFTER_A), AFTER_A: ("u", AFTER_U)}
PIECE_BYTES = 32 << 20  # of texts in a partition, about
LONG = 4096  # rows; a conversation of more is finished like one over several partitions
PIECE = 1 << 16  # rows of an open conversation whose symbols are made together


class Tables:
    """Transitions of normalised cost vectors, for single symbols and for blocks of ``BLOCK`` symbols.

    ``vectors[v]`` is a normalised vector, ``last`` the one after all rows (its minimum is 0).
    ``step[v][x]``: the vector before symbol x and the cost taken out; ``blocks[v][block]`` the same for the
    bytes of a block. ``edit[v][x][q]``: the letter to take before symbol x in state q if the vector after x is v,
    and the state that follows.
    """

    def __init__(self) -> None:
        end = self.with_inserts([0, NEVER, NEVER, 0])
        self.vectors, self.last = [tuple(end)], 0
        ids = {self.vectors[0]: 0}
        self.step: list[list[tuple[int, int]]] = []
        self.edit: list[list[list[tuple[str, int]]]] = []
        for vector in self.vectors:  # grows while new vectors turn up
            step, edit = [], []
            for x in range(SYMBOLS):
                before = self.with_inserts([min(c + vector[to] for _, c, to in self.row_edits(x, q)) for q in range(4)])
                taken = min(before)
                normal = tuple(c - taken for c in before)
                if normal not in ids:
                    ids[normal] = len(ids)
                    self.vectors.append(normal)
                step.append((ids[normal], taken))
                edit.append([self.least_letter(x, q, before, vector) for q in range(4)])
            self.step.append(step)
            self.edit.append(edit)
        self.blocks: list[dict[bytes, tuple[int, int]]] = []
        for v in range(len(self.vectors)):
            table = {b"": (v, 0)}
            for _ in range(BLOCK):
                table = {bytes([x]) + rest: (self.step[at][x][0], c + self.step[at][x][1])
                         for rest, (at, c) in table.items() for x in range(SYMBOLS)}
            self.blocks.append(table)

    @staticmethod
    def with_inserts(vector: list[int]) -> list[int]:
        """Costs when rows may be inserted first (two insertions lead back to where one stood)."""
        for _ in range(3):
            vector = [min(vector[q], INSERT + vector[NEXT[q][1]]) for q in range(4)]
        return vector

    @staticmethod
    def row_edits(x: int, q: int) -> list[tuple[str, int, int]]:
        """(letter, cost, state after) of what can be done with a row of symbol ``x`` in state ``q``."""
        out = [("D", DELETE, q)]
        if x:
            initial, extra = "sua?"[(x - 1) // 2], TRUNCATED * ((x - 1) % 2)
            need, after = NEXT[q]
            if initial == need:
                out.append(("K", KEEP + extra, after))
            if initial == "s" and q == START:
                out.append(("K", KEEP + extra, AFTER_S))
            out.append(("R", REROLE + extra, after))
        return out

    def least_letter(self, x: int, q: int, before: list[int], after: tuple[int, ...]) -> tuple[str, int]:
        rest = {(letter, to): c + after[to] for letter, c, to in self.row_edits(x, q)}
        rest["I", NEXT[q][1]] = INSERT + before[NEXT[q][1]]  # an insertion stays before the same row
        return min(edit for edit, c in rest.items() if c == before[q])

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """(cost, audit) of a conversation's symbols."""
        odd = len(symbols) % BLOCK  # whole blocks stand at the end
        v, cost, right = self.last, 0, []
        for lo in range(len(symbols) - BLOCK, odd - 1, -BLOCK):
            right.append(v)
            v, taken = self.blocks[v][symbols[lo:lo + BLOCK]]
            cost += taken
        right.append(v)
        for x in reversed(symbols[:odd]):
            v, taken = self.step[v][x]
            cost += taken
        audit, q = [], START
        for lo in (0, *range(odd, len(symbols), BLOCK)) if odd else range(0, len(symbols), BLOCK):
            block = symbols[lo:odd] if lo < odd else symbols[lo:lo + BLOCK]
            if lo >= odd and len(right) > (len(symbols) - lo) // BLOCK:
                right.pop()
            inside = [right[-1]]  # vectors after the block's symbols, last first
            for x in reversed(block[1:]):
                inside.append(self.step[inside[-1]][x][0])
            for x, after in zip(block, reversed(inside), strict=True):
                letter = "I"
                while letter == "I":
                    letter, q = self.edit[after][x][q]
                    audit.append(letter)
        while q not in (START, AFTER_A):
            audit.append("I")
            q = NEXT[q][1]
        return cost + self.vectors[v][START], "".join(audit)


def repaired_rows(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) rows that an audit makes of a conversation's rows."""
    need = "user"
    for letter in audit:
        role, text = (None, "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K" and role[:1] == "s":
            yield role, text  # an s row is kept at the start only
            continue
        yield (role if letter == "K" else need), text
        need = "assistant" if need == "user" else "user"


def joined_sha256(rows: Iterator[tuple[str, str]]) -> str:
    h = hashlib.sha256()
    for i, (role, text) in enumerate(rows):
        h.update((("\n" if i else "") + f"{role}:{text}").encode())
    return h.hexdigest()


# ---- rows -----------------------------------------------------------------------------------

def spaced(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def prepared(chats: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, damaged: bool) -> DataFrame:
    """Rows (conv, turn, role, text, gone) with nulls as spaces, damaged if asked; ``gone`` marks a dropped row."""
    key = F.crc32(F.concat(spaced(F.col(conv_col)), F.lit(":"), spaced(F.col(turn_col)))) % 20
    rows = chats.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), spaced(F.col(role_col)).alias("role"),
                        spaced(F.col(text_col)).alias("text"), (key if damaged else F.lit(-1)).alias("k"))
    rows = rows.select("conv", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("k").isin(0, 1), "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                       (F.col("k") == 0).alias("gone"), F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


LEGAL = ("su", "ua", "au")
BLANKS = b" \t\n\x0b\x0c\r"


def base_symbol(role: str, text: str) -> int:
    """Symbol of a row that is no duplicate."""
    last = text.encode().rstrip(BLANKS)[-1:]
    if not last:
        return 0
    return 1 + 2 * "sua".find(role[:1] or "?") + (last not in b".!?") if role[:1] in ("s", "u", "a") else 7 + (last not in b".!?")


SUMMARY = ("conv {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def finish(tables: Tables, chats: list[tuple]) -> list[tuple]:
    """Result rows of whole conversations, each (conv, [(turn, role, text)])."""
    out = []
    for conv, rows in chats:
        seen, symbols, blank, again = set(), bytearray(), 0, 0
        for _, role, text in rows:
            x = base_symbol(role, text)
            blank += x == 0
            if x and (role, text) in seen:
                x, again = 0, again + 1
            seen.add((role, text))
            symbols.append(x)
        truncated = sum(x > 0 and x % 2 == 0 for x in symbols)
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:]))
        cost, audit = tables.repair(bytes(symbols))
        out.append((conv, gaps, blank, again, truncated, illegal, cost, audit,
                    joined_sha256(repaired_rows(audit, (r[1:] for r in rows)))))
    return out


def as_batch(kind: pa.DataType, convs, results, opens) -> pa.RecordBatch:
    """Rows of the first pass: results of finished conversations, or rows of open ones."""
    types = [kind, *[pa.int64()] * 6, *[pa.string()] * 2, *[pa.int64()] * 3, pa.string(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((convs, *results, *opens), types, strict=True)],
                                      ["conv", *FIELDS, "part", "nth", "turn", "role", "text", "gone"])


def repair(chats: DataFrame, damaged: bool = False, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row for each conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    spark = chats.sparkSession
    rows = prepared(chats, conv_col, turn_col, role_col, text_col, damaged)
    conv_type = rows.schema["conv"].dataType.simpleString()
    size = chats.agg(F.sum(F.octet_length(text_col)).alias("b")).collect()[0].b or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, size // PIECE_BYTES + 1)
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    ranged = rows.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    summary = SUMMARY.format(conv=conv_type)

    def stream(batches: Iterator[pa.RecordBatch]):
        tables = Tables()
        current: tuple | None = None  # (conv, its rows so far)
        is_open = True  # a partition's first conversation may have begun before
        nth = 0

        def rows_in():
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    some = batch.slice(lo, 512)
                    yield batch.column(0).type, list(zip(*(c.to_pylist() for c in some.columns), strict=True))

        def opened(kind, conv, rows):
            nonlocal nth
            cols = list(zip(*rows)) or [()] * 5
            nth += len(rows)
            return as_batch(kind, [conv] * len(rows), [[None] * len(rows)] * len(FIELDS),
                            (cols[4], range(nth - len(rows), nth), *cols[:4]))

        kind = None
        for kind, rows in rows_in():
            held = []
            for conv, turn, role, text, gone, part in rows:
                if current is not None and current[0] != conv:
                    if is_open:
                        yield opened(kind, *current)
                    else:
                        held.append((current[0], [r[:3] for r in current[1] if not r[3]]))
                    current, is_open = None, False
                current = current or (conv, [])
                current[1].append((turn, role, text, gone, part))
                if len(current[1]) >= LONG:
                    is_open = True
                    yield opened(kind, *current)
                    current[1].clear()
            if held:
                cols = list(zip(*finish(tables, held)))
                yield as_batch(kind, cols[0], cols[1:], [[None] * len(held)] * 6)
        if current is not None:
            yield opened(kind, *current)

    columns = f"{summary}, part long, nth long, turn long, role string, text string, gone boolean"
    path = scratch_path(spark, "turn-repair")
    ranged.select("conv", "turn", "role", "text", "gone", "part").mapInArrow(stream, columns).write.parquet(path)
    written = spark.read.parquet(path)
    closed = written.where("part is null").select("conv", *FIELDS)
    return closed.unionByName(finish_open(written.where("part is not null").select("conv", "part", "nth", "turn", "role", "text", "gone"), summary))


def finish_open(rows: DataFrame, summary: str) -> DataFrame:
    """Result rows of the conversations that begin or end a partition, whatever their length."""
    live = rows.where("not gone").withColumn("digest", F.sha2(F.concat_ws("\0", "role", "text"), 256))
    place = F.struct("part", "nth")
    firsts = live.groupBy("conv", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Only rows that have a copy meet this side; a hot one is one row of it.
    marked = (live.alias("l").join(firsts.alias("f"), F.col("l.conv").eqNullSafe(F.col("f.conv")) & (F.col("l.digest") == F.col("f.digest")), "left")
              .select("l.conv", "l.part", "l.nth", "l.turn", "l.role", F.expr("substring(l.role, 1, 1)").alias("initial"), "l.text",
                      F.coalesce(F.struct("l.part", "l.nth") > F.col("f.first"), F.lit(False)).alias("again")))
    stripped = F.rtrim(F.regexp_replace("text", "[\t\n\\x0b\\f\r]", " "))
    last = F.right(stripped, F.lit(1))
    blank = last == ""
    cut = ~last.isin(".", "!", "?")
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    symbol = F.when(blank | F.col("again"), 0).otherwise(1 + 2 * initial + cut.cast("int"))
    slim = marked.select("conv", "part", (F.col("nth") / PIECE).cast("long").alias("chunk"), "nth", "turn", "initial", blank.alias("blank"), (~blank & F.col("again")).alias("again"), symbol.alias("symbol"))

    def piece(table: pa.Table) -> pa.Table:
        """One row for the rows of a conversation in one partition: a byte for each row's symbol, and what adds up."""
        table = table.sort_by("nth")
        turns = table.column("turn").drop_null()
        initials = table.column("initial").to_pylist()
        symbols = table.column("symbol").to_numpy().astype(np.uint8)
        known = turns.to_numpy()
        pairs = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        return pa.table({
            **{c: table.column(c).slice(0, 1) for c in ("conv", "part", "chunk")},
            "symbols": pa.array([symbols.tobytes()], pa.binary()),
            "low": pa.array([int(known.min()) if len(known) else None], pa.int64()),
            "high": pa.array([int(known.max()) if len(known) else None], pa.int64()),
            "turns": pa.array([len(np.unique(known))], pa.int64()),
            "blank": pa.array([int(np.count_nonzero(table.column("blank").to_numpy()))], pa.int64()),
            "again": pa.array([int(np.count_nonzero(table.column("again").to_numpy()))], pa.int64()),
            "illegal": pa.array([pairs], pa.int64()),
            "head": pa.array(initials[:1], pa.string()), "tail": pa.array(initials[-1:], pa.string())})

    conv_type = rows.schema["conv"].dataType.simpleString()
    pieces = slim.groupBy("conv", "part", "chunk").applyInArrow(
        piece, f"conv {conv_type}, part long, chunk long, symbols binary, low long, high long, turns long, blank long, again long, illegal long, head string, tail string")

    def whole(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("part", "ascending"), ("chunk", "ascending")]).to_pylist()
        symbols = b"".join(r["symbols"] for r in rows)
        cost, audit = Tables().repair(symbols)
        timed = [r for r in rows if r["low"] is not None]
        gaps = 0
        if timed:  # a turn's rows can stand on both sides of a cut
            distinct = sum(r["turns"] for r in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
            gaps = timed[-1]["high"] - timed[0]["low"] + 1 - distinct
        out = {"gaps": gaps, "blank": sum(r["blank"] for r in rows), "duplicate": sum(r["again"] for r in rows),
               "truncated": sum(symbols.count(x) for x in range(2, SYMBOLS, 2)),
               "illegal": sum(r["illegal"] for r in rows) + sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(rows, rows[1:])),
               "cost": cost}
        return pa.table({"conv": table.column("conv").slice(0, 1), **{k: pa.array([x], pa.int64()) for k, x in out.items()},
                         "audit": pa.array([audit], pa.string())})

    found = pieces.groupBy("conv").applyInArrow(whole, summary.rsplit(",", 1)[0])
    path = scratch_path(rows.sparkSession, "turn-repair-open")
    found.write.parquet(path)
    found = rows.sparkSession.read.parquet(path)
    # One stream for each conversation: its audit first, then its rows in order, each hashed as it comes.
    feed = (found.select("conv", F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("nth"), F.lit("").alias("role"), F.col("audit").alias("text"))
            .unionByName(live.select("conv", "part", "nth", "role", "text")))
    feed = feed.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "part", "nth")

    conv_arrow = to_arrow_type(rows.schema["conv"].dataType)

    def hashes(batches: Iterator[pa.RecordBatch]):
        def rows_in():
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    yield from zip(*(c.to_pylist() for c in batch.slice(lo, 512).columns), strict=True)

        stream = rows_in()
        row = next(stream, None)
        while row is not None:
            conv, audit = row[0], row[4]

            def own():
                nonlocal row
                for row in stream:
                    if row[1] == -1:
                        return
                    yield row[3], row[4]
                row = None

            rest = own()
            digest = joined_sha256(repaired_rows(audit, rest))
            for _ in rest:  # inserted rows at the end leave the stream where it is
                pass
            yield pa.RecordBatch.from_arrays([pa.array([conv], conv_arrow), pa.array([digest], pa.string())], ["conv", "repaired_sha256"])

    hashed = feed.mapInArrow(hashes, f"conv {conv_type}, repaired_sha256 string")
    # Conversations without rows left have no pieces.
    empty = rows.groupBy("conv").agg(F.bool_and("gone").alias("g")).where("g").select(
        "conv", *(F.lit(0).cast("long").alias(c) for c in FIELDS[:6]), F.lit("").alias("audit"), F.lit(hashlib.sha256().hexdigest()).alias("repaired_sha256"))
    joined = found.alias("a").join(hashed.alias("h"), F.col("a.conv").eqNullSafe(F.col("h.conv"))).select("a.*", "h.repaired_sha256")
    return joined.unionByName(empty)
