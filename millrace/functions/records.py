"""Column expressions for the record text: render, bucket, measure and parse.

Everything here is a built-in expression, so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import TimestampNTZType

# The record text, its pattern, the hour bucket and the longest line.
RECORD_HEAD = "Record-"
RECORD_BODY = ": Data from foams column at "
RECORD_PATTERN = (
    r"^Record-(\d+): Data from foams column at "
    r"(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d{3,9})?Z)$"
)
BUCKET_PATTERN = r"(\d{4}-\d\d-\d\d--\d\d)"
MAX_LINE_BYTES = 82
EPOCH = "1970-01-01 00:00:00"


def utc_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of an instant in UTC, whatever zone the session has."""
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)")
    seconds = (micros * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(18,6)")
    none = F.lit(0)
    wall = F.to_timestamp_ntz(F.lit(EPOCH)) + F.make_dt_interval(none, none, none, seconds)
    return F.substring(wall.cast("string"), 1, 19)


def instant_of(df, ts: Column) -> Column:
    """A zoneless timestamp column as the instant it names in UTC; others as they are."""
    if isinstance(df.select(ts).schema[0].dataType, TimestampNTZType):
        return F.concat(ts.cast("string"), F.lit("Z")).cast("timestamp")
    return ts.cast("timestamp")


def iso_instant(ts: Column) -> Column:
    """ISO-8601 UTC text with 0, 3 or 6 fraction digits, the shortest that is exact."""
    fraction = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1_000_000))
    millis = F.call_function("div", fraction, F.lit(1000))
    digits = (
        F.when(fraction == 0, F.lit(""))
        .when(fraction % 1000 == 0, F.concat(F.lit("."), F.lpad(millis.cast("string"), 3, "0")))
        .otherwise(F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0")))
    )
    return F.concat(F.replace(utc_text(ts), F.lit(" "), F.lit("T")), digits, F.lit("Z"))


def record_text(index: Column, ts: Column) -> Column:
    """The record line of an index and its instant."""
    return F.concat(F.lit(RECORD_HEAD), index.cast("string"), F.lit(RECORD_BODY), iso_instant(ts))


def hour_bucket(ts: Column) -> Column:
    """Hour directory label (``2025-10-10--17``) of an instant, in UTC."""
    return F.replace(F.substring(utc_text(ts), 1, 13), F.lit(" "), F.lit("--"))


def line_bytes(line: Column) -> Column:
    """Bytes the line takes in a file, newline included."""
    return F.octet_length(line).cast("long") + 1


def is_record(line: Column) -> Column:
    return line.rlike(RECORD_PATTERN)


def record_index(line: Column) -> Column:
    """Index of a record line, null for any other line."""
    return F.regexp_extract(line, RECORD_PATTERN, 1).try_cast("long")


def record_instant(line: Column) -> Column:
    """Instant of a record line, null for any other line."""
    return F.regexp_extract(line, RECORD_PATTERN, 2).try_cast("timestamp")


def as_records(df, index: Column, ts: Column, render=record_text, *keep: str):
    """Project any table with an index and an instant to ``index, ts, foams, bucket``."""
    ts = instant_of(df, ts)
    return df.select(
        index.cast("long").alias("index"),
        ts.alias("ts"),
        render(index, ts).alias("foams"),
        hour_bucket(ts).alias("bucket"),
        *keep,
    )


def parse_records(df, line: str = "foams"):
    """Add ``index`` and ``ts`` parsed from the line; both null where it is no record."""
    return df.withColumns(
        {"index": record_index(F.col(line)), "ts": record_instant(F.col(line))}
    )
