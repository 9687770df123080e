"""Record generators: a bounded range and a rate-limited stream."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.records import as_records, record_text

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def to_micros(instant: datetime) -> int:
    """Microseconds since the epoch; an instant without a zone is UTC."""
    if instant.tzinfo is None:
        instant = instant.replace(tzinfo=timezone.utc)
    delta = instant - EPOCH
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def bounded_records(
    spark: SparkSession,
    count: int,
    start: datetime | int,
    step_us: int = 500_000,
    partitions: int | None = None,
    render=record_text,
) -> DataFrame:
    """Records 0 .. count-1, ``step_us`` apart from ``start`` (an instant or epoch µs)."""
    first = start if isinstance(start, int) else to_micros(start)
    ids = spark.range(0, count, 1, partitions)
    instant = F.timestamp_micros(F.lit(first) + F.col("id") * F.lit(step_us))
    return as_records(ids, F.col("id"), instant, render)


@dataclass(frozen=True)
class LiveRecords:
    """A stream of records and the trigger it is paced for, which its writer must keep."""

    frame: DataFrame
    trigger_s: float


def stream_records(
    spark: SparkSession,
    rate: float = 2,
    trigger_s: float = 30,
    partitions: int = 1,
    render=record_text,
    catch_up: bool = False,
) -> LiveRecords:
    """Unbounded records at ``rate`` per second, ``rate * trigger_s`` per trigger.

    The number of records per trigger is fixed, so after a pause the stream goes on at the
    same rate. ``catch_up=True`` emits what was missed instead. The records of a trigger are
    spread evenly over the last full span of the trigger's length before the clock of the
    batch: none lies in the future, and while a job runs instants follow the index. A rate
    that gives no whole number of records is refused.
    """
    rows = rate if catch_up else rate * trigger_s
    if round(rows) < 1 or abs(rows - round(rows)) > 1e-9 * rows:
        unit = "a second" if catch_up else f"a trigger of {trigger_s} s"
        raise ValueError(f"{rate} records/s are no whole number in {unit}")
    rows = round(rows)
    if catch_up:
        source = (
            spark.readStream.format("rate")
            .option("rowsPerSecond", rows)
            .option("numPartitions", partitions)
            .load()
        )
        records = as_records(source, F.col("value"), F.col("timestamp"), render)
        return LiveRecords(records, trigger_s)
    source = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows)
        .option("numPartitions", partitions)
        .load()
    )
    trigger_us = round(trigger_s * 1_000_000)
    share = (F.col("value") % rows) * F.lit(trigger_us)
    offset = F.call_function("div", share, F.lit(rows)) - trigger_us
    # Triggers fall on multiples of their length, so spans of successive batches do not meet.
    clock = F.unix_micros(F.current_timestamp())
    instant = F.timestamp_micros(clock - clock % trigger_us + offset)
    return LiveRecords(as_records(source, F.col("value"), instant, render), trigger_s)


def replay_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Stream a parquet table, given as one file or a folder of part files.

    ``max_files`` or ``max_bytes`` bounds one micro-batch, so a long replay is committed
    piece by piece.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    # As a pattern, the path may be a single file as well as a folder.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
