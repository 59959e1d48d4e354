"""A corpus pipeline of five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of documents.

1. quality_rules: documents that the base rules or the robust outlier test reject go.
2. near_duplicates: of each class of near copies (five-word shingles, Jaccard 0.75) one row stays: of the
   smallest id the least row. Rows of one id are one document; rows without an id are known by their
   texts and stay only where no row with an id is in their class.
3. decontamination: documents that hold a ten-word window of a benchmark item go.
4. mixing: documents in the order of the Pfair schedule of their sources. All stay; the order is kept
   in the order of the written files and rows.
5. sharding: 40 contiguous shards of near-equal bytes of what is left, in that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.config import cut_lineage, scratch_path
from tonetide.llm import byte_shards, decontaminate, ngram_join, pfair_mix, robust_outliers
from tonetide.llm.registry import table
from tonetide.llm.sizes import counted_side


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return robust_outliers.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A row without an id is known by its text, above all given ids, so that it never replaces one of them.
    by_text = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    named = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), by_text))
    members, _ = ngram_join.near_duplicates(named.select("_id", "text"), size=5, percent=75, id_col="_id")
    members = cut_lineage(members.groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count(F.lit(1)).alias("n")))
    copies = members.where(F.col("first") != F.col("doc_id")).select(F.col("doc_id").alias("_id"))
    kept = named.join(copies, "_id", "left_anti")
    repeated = counted_side(cut_lineage(members.where("n > 1").select(F.col("doc_id").alias("_id"))), 200_000)
    one = kept.join(repeated, "_id").groupBy("_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return kept.join(repeated, "_id", "left_anti").select(*docs.columns).unionByName(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), window=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pfair_mix.mixed(docs, power=0.5, row=byte_shards.written_order(docs))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = byte_shards.byte_shards(docs, shards=40, order=byte_shards.written_order(docs))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

# The outlier estimates (iterated, in floating point) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
