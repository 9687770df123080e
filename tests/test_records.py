from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace.functions import records as R
from millrace.sources.generator import bounded_records, to_micros

START = datetime(2025, 10, 10, 17, 15, 23, 456000, timezone.utc)
# Fixed values below: the documented records and variants of their format.


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_golden_lines(spark):
    rows = bounded_records(spark, 3, START).orderBy("index").collect()
    assert [r.foams for r in rows] == [
        "Record-0: Data from foams column at 2025-10-10T17:15:23.456Z",
        "Record-1: Data from foams column at 2025-10-10T17:15:23.956Z",
        "Record-2: Data from foams column at 2025-10-10T17:15:24.456Z",
    ]
    assert {r.bucket for r in rows} == {"2025-10-10--17"}


@pytest.mark.parametrize(
    "us, text",
    [
        (1_760_116_523_000_000, "2025-10-10T17:15:23Z"),
        (1_760_116_523_456_000, "2025-10-10T17:15:23.456Z"),
        (1_760_116_523_400_000, "2025-10-10T17:15:23.400Z"),
        (1_760_116_523_456_789, "2025-10-10T17:15:23.456789Z"),
        (1_760_116_523_000_010, "2025-10-10T17:15:23.000010Z"),
        (0, "1970-01-01T00:00:00Z"),
        (-1, "1969-12-31T23:59:59.999999Z"),
    ],
)
def test_instant_text(spark, us, text):
    assert one(spark, R.iso_instant(F.timestamp_micros(F.lit(us)))) == text


def test_longest_line_fits(spark):
    longest = R.record_text(F.lit(2**63 - 1), F.lit("9999-12-31 23:59:59.999999").cast("timestamp"))
    assert one(spark, R.line_bytes(longest)) <= R.MAX_LINE_BYTES
    assert one(spark, R.is_record(longest)) is True
    assert one(spark, R.record_index(longest)) == 2**63 - 1


def test_bytes_are_utf8(spark):
    assert one(spark, R.line_bytes(F.lit("ä€"))) == 6


@pytest.mark.parametrize(
    "line",
    [
        "",
        "Record-: Data from foams column at 2025-10-10T17:15:23Z",
        "Record-1: Data from foams column at 2025-10-10T17:15:23.4Z",
        "Record-1: Data from foams column at 2025-10-10 17:15:23Z",
        "xRecord-1: Data from foams column at 2025-10-10T17:15:23Z",
        "Record-1: Data from foams column at 2025-10-10T17:15:23Z!",
        "record-1: Data from foams column at 2025-10-10T17:15:23Z",
    ],
)
def test_other_lines_parse_to_null(spark, line):
    df = R.parse_records(spark.createDataFrame([(line,)], "foams string"))
    assert tuple(df.select("index", "ts").first()) == (None, None)


def test_parse_edge_values(spark):
    lines = [
        ("Record-99999999999999999999: Data from foams column at 2025-10-10T17:15:23Z",),
        ("Record-7: Data from foams column at 2025-99-10T17:15:23Z",),
        ("Record-8: Data from foams column at 2025-10-10T17:15:23.456789123Z",),
    ]
    df = R.parse_records(spark.createDataFrame(lines, "foams string"))
    got = df.select("index", F.unix_micros("ts")).collect()
    assert [tuple(r) for r in got] == [
        (None, 1_760_116_523_000_000),
        (7, None),
        (8, 1_760_116_523_456_789),
    ]


def test_parse_is_the_inverse(spark):
    made = bounded_records(spark, 5000, START, 333_333)
    parsed = R.parse_records(made.select("foams", F.col("index").alias("i"), F.col("ts").alias("t")))
    assert parsed.filter((F.col("i") != F.col("index")) | (F.col("t") != F.col("ts"))).count() == 0
    assert parsed.filter("index is null or ts is null").count() == 0


def test_no_python_on_the_generating_path(spark):
    plan = bounded_records(spark, 10, START)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_own_render(spark):
    df = bounded_records(spark, 2, START, render=lambda i, t: F.concat(F.lit("n"), i.cast("string")))
    assert [r.foams for r in df.orderBy("index").collect()] == ["n0", "n1"]
    assert df.schema["foams"].dataType.simpleString() == "string"


def test_to_micros():
    assert to_micros(START) == 1_760_116_523_456_000
    assert to_micros(START.replace(tzinfo=None)) == 1_760_116_523_456_000


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_text_and_bucket_are_utc_in_any_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        test_golden_lines(spark)
        # An hour that the first zone has twice, and a zoneless column.
        for us in (1_762_061_400_000_000, 1_762_065_000_000_000):
            instant = F.timestamp_micros(F.lit(us))
            hour = datetime.fromtimestamp(us / 1e6, timezone.utc)
            assert one(spark, R.hour_bucket(instant)) == f"{hour:%Y-%m-%d--%H}"
            assert one(spark, R.iso_instant(instant)) == f"{hour:%Y-%m-%dT%H:%M:%SZ}"
        plain = spark.sql("SELECT 1L AS i, TIMESTAMP_NTZ '2025-03-09 02:30:00' AS t")
        row = R.as_records(plain, F.col("i"), F.col("t")).first()
        assert row.bucket == "2025-03-09--02" and row.foams.endswith("2025-03-09T02:30:00Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_long_index_is_read_whole(spark):
    line = "Record-" + "0" * 90 + "17: Data from foams column at 2025-10-10T17:15:23Z"
    assert one(spark, R.record_index(F.lit(line))) == 17
