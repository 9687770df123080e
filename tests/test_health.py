from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.health import index_profile, scorecard
from millrace.sources.generator import bounded_records

START = datetime(2025, 10, 10, 17, 15, 23, 456000)


def card(spark, records, sizes=(100,), as_of="2025-10-10 18:00:00"):
    files = spark.createDataFrame([(s,) for s in sizes], "length long")
    rows = scorecard(records, files, F.lit(as_of).cast("timestamp"), 3600, 1000).collect()
    failed = {r.check for r in rows if not r.passed}
    assert len(rows) == 6 and {r.score for r in rows} == {6 - len(failed)}
    (verdict,) = {r.verdict for r in rows}
    return failed, verdict


@pytest.fixture()
def records(spark):
    return bounded_records(spark, 70_000, START, 1000).select("foams")


def test_all_checks_pass(spark, records):
    assert card(spark, records) == (set(), "ok")


def test_gap(spark, records):
    assert card(spark, records.filter(~F.col("foams").startswith("Record-41234:"))) == (
        {"no_gaps"},
        "partial",
    )


def test_copies(spark, records):
    copies = records.union(records.filter(F.col("foams").startswith("Record-7:")))
    assert card(spark, copies) == ({"no_duplicates"}, "partial")


def test_bad_line_and_large_file(spark, records):
    noise = spark.createDataFrame([("noise",)], "foams string")
    assert card(spark, records.union(noise), (10, 1001)) == ({"lines_match", "file_sizes"}, "partial")


def test_stale(spark, records):
    assert card(spark, records, as_of="2025-10-10 20:00:00") == ({"fresh"}, "partial")


def test_empty_table(spark, records):
    failed, verdict = card(spark, records.limit(0))
    assert {"table_not_empty", "fresh", "no_gaps"} <= failed and verdict == "failed"
    assert index_profile(records.limit(0)).first()["records"] == 0


def test_failed_below_four(spark):
    lines = [("noise",), ("Record-3: Data from foams column at 2020-01-01T00:00:00Z",)] + [
        ("Record-5: Data from foams column at 2020-01-01T00:00:00Z",)
    ] * 2
    df = spark.createDataFrame(lines, "foams string")
    failed, verdict = card(spark, df)
    assert failed == {"lines_match", "no_duplicates", "no_gaps", "fresh"} and verdict == "failed"
