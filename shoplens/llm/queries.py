"""The registered queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import ctw, langid, minhash, mixing, packing, pii, quality, rabitq, sharding, spelling, token_files, warc, whitening
from shoplens.llm.common import table
from shoplens.session import scratch_path


def op1_probminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicate_groups(table(spark, sf_dir, "documents")).select("doc_id", "group_id", "group_size", "kept")


def op2_bestfit_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"))


def op4_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.warc_round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    base = F.sha2(pii.spans_text(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *[pii.count_kind(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
                        base.alias("base_sha256"), pii.spans_text(F.concat("base", "extra")).alias("spans"))


def op8_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times")


def op9_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(table(spark, sf_dir, "documents"))


def op10_rabitq_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op12_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_vgram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_probminhash_dedup, op2_bestfit_sharding, op3_context_tree, op4_warc_salvage, op5_bin_completion, op6_boosted_quality, op7_bootstrapped_pii, op8_fair_queueing, op9_arrow_sequences, op10_rabitq_links, op11_crf_language, op12_block_whitening, op13_vgram_variants)}
