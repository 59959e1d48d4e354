"""The registered queries of this package: ``opN_<name>`` and ``pipeline``.

Each query reads a whole table, applies its operator with production parameters
and derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline

from ..config import cut_lineage, scratch_path
from . import (byte_shards, cell_codes, decontaminate, license_lookup, ngram_join, oracles, pfair_mix, robust_outliers, suffix_dedup,
               token_planes, toxicity, turn_repair, url_tree, warc_writer)
from .registry import ORACLES, QUERIES, query, table  # noqa: F401
from .sizes import counted_side


@query("op4_byte_prefix_shards", oracles.OP4_SQL)
def op4(spark, sf_dir):
    placed = byte_shards.byte_shards(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op1_suffix_array_dedup", oracles.OP1_SQL)
def op1(spark, sf_dir):
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op2_token_byte_planes")
def op2(spark, sf_dir):
    import public_tokenizers

    written = token_planes.write_tokens(table(spark, sf_dir, "documents"),
                                        public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_planes.read_token_digests(written).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op7_warc_dictionary_writer", oracles.OP7_SQL)
def op7(spark, sf_dir):
    written = warc_writer.write_warc(table(spark, sf_dir, "pages"))
    return warc_writer.read_warc(written).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_robust_outliers")
def op3(spark, sf_dir):
    report = robust_outliers.quality_report(table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "distance")


@query("op5_prefix_decontamination", oracles.OP5_SQL)
def op5(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query("op8_grouped_prefix_join", oracles.OP8_SQL)
def op8(spark, sf_dir):
    members, _ = ngram_join.near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=75)
    return members.select("doc_id", "n_shingles", "component_id")


@query("op6_pfair_mix")
def op6(spark, sf_dir):
    placed = pfair_mix.mix_positions(table(spark, sf_dir, "documents"), power=0.5)
    return placed.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"),
                         F.expr("CASE WHEN _source = 'null' THEN NULL ELSE substring(_source, 2) END").alias("source"),
                         "block", "slot", "position")


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


@query("op9_path_template_tree")
def op9(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    # The number in a page's path is the document that it shows; labels are on documents.
    shown = F.regexp_extract(url_tree.path_of("url"), r"([0-9]+)[^0-9]*$", 1).try_cast("long")
    labels = (pages.select("page_id", shown.alias("doc_id"))
              .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
              .select("page_id", F.when(F.col("quality") == 0, 1).otherwise(0).alias("bad")))
    return url_tree.url_filter(pages, labels, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query("op10_license_digests", oracles.OP10_SQL)
def op10(spark, sf_dir):
    found = license_lookup.license_scan(table(spark, sf_dir, "documents"), license_lookup.known_texts(spark))
    return found.select("doc_id", F.array_join("whole", ",").alias("whole"), F.array_join("notices", ",").alias("notices"), "n_notices")


@query("op11_noisy_or_toxicity")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out), train_rows=20_000)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("sentences").alias("n_sentences"))


@query("op12_block_table_repair", oracles.OP12_SQL)
def op12(spark, sf_dir):
    return turn_repair.repair(table(spark, sf_dir, "conversations"), damaged=True).withColumnRenamed("conv", "conv_id")


@query("op13_memoised_cell_codes", oracles.OP13_SQL)
def op13(spark, sf_dir):
    kept = cell_codes.kept_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    books = cell_codes.fit_codebooks(kept, parts=16, entries=64, rounds=2)
    path = scratch_path(spark, "cell-codes")
    cell_codes.encode(kept, books).write.parquet(path)
    coded = spark.read.parquet(path)
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(19,0)")).cast("long").alias("label_error"))
    sums = counted_side(cut_lineage(sums.withColumnRenamed("label", "of")), 200_000)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        "error", "label_error", F.lit(books.sha256() if books else None).alias("codebooks_sha256"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
