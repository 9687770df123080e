"""The corpus pipeline: from raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns documents with the same
columns; the last returns pieces placed in sequences. A stage's result is written as Parquet
and read again, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm import classifier, decontamination, near_dups, packing, substring_dedup
from millrace.llm.common import keep, read, row_key
from millrace.llm.queries import vocabulary

SIMILARITY = near_dups.Likeness(words=5, percent=80, bands=30)
REPEATED_WORDS = 50


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return classifier.filter_documents(docs, read(spark, sf_dir, "labels"))


def marked(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, Column]:
    """Keys of the rows found and the condition to meet them."""
    keys = found.select(F.col("doc_id").alias("found id"), F.col("row_key").alias("found key"))
    return keys, docs["doc_id"].eqNullSafe(keys["found id"]) & (row_key() == keys["found key"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, similarity 0.8.
    Repeated rows of a document are that document."""
    found = near_dups.near_duplicates(docs, SIMILARITY)
    return docs.join(*marked(docs, found.filter("kept")), "left_semi")


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of words that an earlier document has too are cut."""
    runs = keep(substring_dedup.removals(docs, REPEATED_WORDS), "runs")
    return substring_dedup.shorten(docs, runs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    found = decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return docs.join(*marked(docs, found.filter("n_hit > 0")), "left_anti")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality_classifier", quality),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substrings),
    ("decontamination", benchmarks),
    ("packing", sequences),
]

# Tokenised sequences are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
