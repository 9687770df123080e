"""Health scorecard of a written table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.records import parse_records

PARTIAL_MARK = 4


def index_profile(records: DataFrame, line: str = "foams") -> DataFrame:
    """One row: records, parsed records, distinct indices, index range, newest instant.

    Distinct indices are counted exactly: 64 neighbours share one word with a bit each,
    merged before the shuffle. A stream writes neighbours together, so little is moved;
    in the worst case it is one word per record, as a plain distinct count would take.
    """
    return words_profile(index_words(records, line))


def index_words(records: DataFrame, line: str = "foams") -> DataFrame:
    """A row for each 64 neighbouring indices: how many records, and a bit for each index."""
    parsed = parse_records(records.select(line), line)
    word = F.call_function("shiftright", "index", F.lit(6))
    place = F.col("index").bitwiseAND(63).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    return parsed.groupBy(word.alias("word")).agg(
        F.count("*").alias("records"),
        F.count("index").alias("parsed"),
        F.bit_or(bit).alias("bits"),
        F.min("index").alias("first"),
        F.max("index").alias("last"),
        F.max("ts").alias("newest"),
    )


def words_profile(words: DataFrame) -> DataFrame:
    """The row of :func:`index_profile` from index words; those of several scans are merged."""
    merged = words.groupBy("word").agg(
        F.sum("records").alias("records"), F.sum("parsed").alias("parsed"),
        F.bit_or("bits").alias("bits"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.max("newest").alias("newest"),
    )
    return merged.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("parsed"), F.lit(0)).alias("parsed"),
        F.coalesce(F.sum(F.bit_count("bits").cast("long")), F.lit(0)).alias("distinct"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("newest").alias("newest"),
    )


def scorecard(
    records: DataFrame,
    files: DataFrame,
    as_of: Column,
    fresh_s: int,
    max_file_bytes: int,
    length: str = "length",
    line: str = "foams",
) -> DataFrame:
    """One row per check, with the score and the verdict.

    ``files`` has a ``length`` per file (an inventory or a part summary). The verdict is
    ``ok`` when all checks pass, ``partial`` from four on, else ``failed``.
    """
    return checks(index_profile(records, line), files, as_of, fresh_s, max_file_bytes, length)


def checks(
    profile: DataFrame, files: DataFrame, as_of: Column, fresh_s: int, max_file_bytes: int,
    length: str = "length",
) -> DataFrame:
    """The scorecard from a profile that is known already."""
    largest = files.agg(F.max(F.col(length)).cast("long").alias("largest"))
    facts = profile.unionByName(largest, allowMissingColumns=True)
    facts = facts.agg(*(F.max(c).alias(c) for c in facts.columns))
    fresh_from = F.unix_micros(as_of.cast("timestamp")) - F.lit(fresh_s * 1_000_000)
    tests = {
        "table_not_empty": F.col("records") > 0,
        "lines_match": F.col("parsed") == F.col("records"),
        "no_duplicates": F.col("distinct") == F.col("parsed"),
        "no_gaps": F.col("last") - F.col("first") + 1 == F.col("distinct"),
        "fresh": F.unix_micros("newest") >= fresh_from,
        "file_sizes": F.col("largest") <= max_file_bytes,
    }
    passed = {name: F.coalesce(test, F.lit(False)).cast("int") for name, test in tests.items()}
    rows = F.array(
        *(F.struct(F.lit(k).alias("check"), v.alias("passed")) for k, v in passed.items())
    )
    score = sum(passed.values(), F.lit(0))
    verdict = (
        F.when(score == len(tests), "ok").when(score >= PARTIAL_MARK, "partial").otherwise("failed")
    )
    return facts.select(score.alias("score"), verdict.alias("verdict"), F.inline(rows))
