"""Contiguous shards of near-equal bytes from global prefix sums (DataFrame functions only).

Rows are put in one global order (the id, then the size and the checksum of the text) and dealt into
range partitions of that order. Each partition is summed on its own; only those totals, one row for
each partition, are cumulated globally. A row's global byte offset is its partition's offset plus a
running sum inside the partition, and the byte axis is cut at equal targets.

Only (order key, size) rows move: whole texts never take part in a shuffle. A hot source or a large
group of copies has no effect, because rows are dealt by position in the order, not by content.

Defined results:
* null text: 0 bytes of text; null id: before all other ids;
* repeated ids or rows: each row is placed on its own; ties of the id go by size, then checksum;
* an empty table gives an empty result; fewer rows than shards leave shards empty;
* columns of the input are not touched, so extra or clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..config import cut_lineage

ROW_OVERHEAD = 16  # bytes that each stored row adds to its text


def text_bytes(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def partition_offsets(df: DataFrame, pid: str, sums: dict[str, Column]) -> DataFrame:
    """(pid, one exclusive prefix sum for each of ``sums``) over the partitions' totals.

    The window sees one row for each partition, not the rows themselves.
    """
    totals = df.groupBy(pid).agg(*[F.sum(c).alias(f"_{k}") for k, c in sums.items()])
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(pid, *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(k) for k in sums])


def with_global_prefix(df: DataFrame, order: list[str], size: str) -> DataFrame:
    """Add ``start`` (bytes before the row) and ``row`` (rows before it) in the global ``order``.

    The rows are written to the shared folder once, so their partition numbers stay what they are
    when executors are lost.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    dealt = cut_lineage(df.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id()))
    offsets = partition_offsets(dealt, "_pid", {"_bytes_before": F.col(size), "_rows_before": F.lit(1)})
    inside = Window.partitionBy("_pid").orderBy(*keys)
    local = dealt.select("*", (F.row_number().over(inside) - 1).alias("_row"),
                         F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"))
    return (local.join(offsets, "_pid")
            .withColumn("start", F.col("_bytes_before") + F.col("_upto") - F.col(size))
            .withColumn("row", F.col("_rows_before") + F.col("_row"))
            .drop("_pid", "_bytes_before", "_rows_before", "_row", "_upto"))


def written_order(docs: DataFrame) -> list[Column]:
    """The order of files (by name) and rows in which a table read from Parquet was written."""
    return [F.col("_metadata.file_name"), F.col("_metadata.row_index")]


def byte_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                overhead: int = ROW_OVERHEAD, order: list[Column] | None = None) -> DataFrame:
    """(id, size, text_crc32, start, row, shard, slot) of every row; law: bytes.

    A row goes to the shard whose equal target holds the middle of its bytes, so shards are contiguous
    in the ``order`` (by default the id) and each differs from the target by at most one row at either
    end. ``slot`` counts from 0 inside a shard.
    """
    order = [F.col(id_col)] if order is None else order
    names = [f"_o{i}" for i in range(len(order))]
    narrow = docs.select(*[c.alias(n) for c, n in zip(order, names, strict=True)], F.col(id_col).alias("_id"),
                         (text_bytes(F.col(text_col)) + F.lit(overhead)).alias("size"),
                         F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = cut_lineage(with_global_prefix(narrow, [*names, "size", "text_crc32"], "size"))
    total = placed.agg(F.sum("size").cast("decimal(38,0)").alias("t")).scalar()
    middle = (2 * F.col("start") + F.col("size")).cast("decimal(26,0)") * F.lit(shards).cast("decimal(8,0)")
    cut = F.least(F.floor(middle / (2 * total)).cast("int"), F.lit(shards - 1))
    sharded = placed.withColumn("shard", cut)
    first = sharded.groupBy("shard").agg(F.min("row").alias("_first"))  # one row for each shard
    return (sharded.join(first, "shard")
            .select(F.col("_id").alias(id_col), "size", "text_crc32", "start", "row", "shard",
                    (F.col("row") - F.col("_first")).alias("slot")))
