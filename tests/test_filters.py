from datetime import timedelta

from pyspark.sql import functions as F

from millrace.operators import filters

LOG = [
    ("2025-10-10 17:00:00", "started"),
    ("2025-10-10 17:04:00", "ERROR s3 write failed"),
    ("2025-10-10 17:05:00", "error in job"),
    ("2025-10-10 17:09:59", "S3 sink open"),
    ("2025-10-10 17:10:00", "checkpoint done"),
]


def log(spark):
    return spark.createDataFrame(LOG, "t string, message string").select(
        F.col("t").cast("timestamp").alias("ts"), "message"
    )


def messages(df):
    return [r.message for r in df.orderBy("ts").collect()]


def test_recent_counts_back_from_the_newest(spark):
    got = messages(filters.recent(log(spark), timedelta(minutes=5)))
    assert got == [m for _, m in LOG[2:]]


def test_recent_with_a_given_end(spark):
    end = F.lit("2025-10-10 17:09:00").cast("timestamp")
    assert messages(filters.recent(log(spark), timedelta(minutes=5), end)) == [m for _, m in LOG[1:]]
    assert messages(filters.recent(log(spark), timedelta(minutes=5), F.current_timestamp())) == []


def test_patterns(spark):
    assert messages(filters.containing(log(spark), "ERROR")) == ["ERROR s3 write failed"]
    found = messages(filters.matching(log(spark), "s3|error", ignore_case=True))
    assert found == ["ERROR s3 write failed", "error in job", "S3 sink open"]
    assert messages(filters.matching(log(spark), "s3|error")) == ["ERROR s3 write failed", "error in job"]
    counts = filters.pattern_counts(log(spark), "s3|error", "message").first()
    assert tuple(counts) == (2, 3)


def test_last_events(spark):
    newest = filters.last_events(log(spark), 2).collect()
    assert [r.message for r in newest] == ["checkpoint done", "S3 sink open"]


def test_first_records_are_in_number_order(spark):
    lines = [f"Record-{i}: Data from foams column at 2025-10-10T17:15:23Z" for i in (10, 9, 2)]
    df = spark.createDataFrame([(x,) for x in [*lines, "noise"]], "foams string")
    assert [r.foams for r in filters.first_records(df, 4).collect()] == [*reversed(lines), "noise"]
    plan = filters.first_records(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
