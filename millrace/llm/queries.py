"""The registered queries of this package: the digest columns of each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    classifier, collocations, decontamination, hard_negatives, license_scan, near_dups, packing, quality_rules, sharding,
    substring_dedup, suffix_dedup, toxicity, url_filter,
)
from millrace.llm.common import keep, read
from millrace.llm.oracles import ORACLES


def vocabulary() -> str:
    """Place of the tokenizer's vocabulary file, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read(spark, sf_dir, "documents"))
    return found.withColumn("score", F.round("score", 9)).drop("n_probes")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return suffix_dedup.digest(docs, keep(suffix_dedup.removals(docs), "runs"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary())


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(read(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return substring_dedup.digest(docs, keep(substring_dedup.removals(docs), "runs"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(read(spark, sf_dir, "documents"))
    return found.withColumn("rank", F.col("rank").cast("long"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), label.alias("label"),
        hard_negatives.whole_numbers(F.col("embedding")).alias("vector"),
    )
    return hard_negatives.mine(vectors, F.col("id") % 50 == 0)


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_quality_rules, op3_url_filter, op4_suffix_dedup, op5_decontamination,
    op6_packing, op7_sharding,
    op8_near_duplicates, op9_quality_classifier,
    op10_substring_dedup, op11_collocations, op12_toxicity, op13_hard_negatives,
)}
