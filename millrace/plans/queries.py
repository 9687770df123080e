"""The registered queries. Each takes a session and a folder of parquet tables.

``events`` stands in for the generator: ``event_id`` is the index, ``ts`` the instant.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.records import (
    as_records, hour_bucket, line_bytes, parse_records as parse_lines, record_text,
)
from millrace.operators import filters, health, parts
from millrace.operators.policy import RollPolicy
from millrace.session import scratch_path, ship_package
from millrace.sources import generator, tables
from millrace.streaming.jobs import StreamJob
from millrace.streaming.sink import export_csv, text_writer, write_parts

# Events are minutes apart, so the rolling limits are wider in time and tighter in bytes
# than the defaults of the policy.
POLICY = RollPolicy(max_age_s=1200, max_idle_s=480, max_bytes=300)
# Files are kept to a few per hour.
FILE_POLICY = RollPolicy(max_age_s=1800, max_idle_s=None, max_bytes=4000)
# A replay has no clock to follow: files are as large as a scan likes them, and the commit log
# grows with the bytes of the table.
LAND_POLICY = RollPolicy(max_age_s=None, max_idle_s=None, max_bytes=128 << 20)
FIRST_INSTANT_US = 1_760_116_523_456_000  # 2025-10-10T17:15:23.456Z
ONE_BUCKET = "2024-01-15--12"
AS_OF = "2024-01-31 12:00:00"
FRESH_S = 6 * 3600
MAX_FILE_BYTES = 300 + 82
BATCH_BYTES = 1 << 40

_landed: dict[tuple[str, str], str] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{sf_dir}/events.parquet")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_records(events(spark, sf_dir), F.col("event_id"), F.col("ts"))


def land_events(spark: SparkSession, sf_dir: str) -> str:
    """Stream all events into hour directories of a new table; returns its root."""
    path = f"{sf_dir}/events.parquet"
    source = generator.replay_stream(ship_package(spark), path, max_bytes=BATCH_BYTES)
    records = as_records(source, F.col("event_id"), F.col("ts"))
    root, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    writer = text_writer(records, root, state, LAND_POLICY, available_now=True, spread=True)
    writer.start().awaitTermination()
    return root


def landed_table(spark: SparkSession, sf_dir: str) -> str:
    """Root of a table written once per application, for the queries that only read it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        _landed[key] = land_events(spark, sf_dir)
    return _landed[key]


def event_parts(spark: SparkSession, sf_dir: str, parallelism: int, **options) -> DataFrame:
    records = event_records(spark, sf_dir)
    return parts.assign_parts(records, POLICY, parallelism, keep=[], **options)


def all_cores(spark: SparkSession) -> dict[str, int]:
    """Cut even a small table into chunks, as a large one is."""
    return {"min_chunks": spark.sparkContext.defaultParallelism}


def generate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many generated records as there are line items."""
    count = ship_package(spark).read.parquet(f"{sf_dir}/lineitem.parquet").count()
    return generator.bounded_records(spark, count, FIRST_INSTANT_US).select(
        "index", "foams", "bucket"
    )


def format_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(spark, sf_dir).select("index", "foams", "bucket")


def parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = event_records(spark, sf_dir).select("foams")
    return parse_lines(lines).select("index", F.unix_micros("ts").alias("ts_us"))


def hourly_bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(spark, sf_dir)
    return records.groupBy("bucket").agg(F.count("*").alias("records"))


def text_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events streamed into hour directories and read back."""
    return tables.scan_table(spark, land_events(spark, sf_dir))


def stream_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate-limited stream with one record per event in a one-second trigger; records
    and index range of each tenth of that second, from the instants in the text."""
    count = events(spark, sf_dir).count()
    root = _generated(spark, count)
    records = parse_lines(tables.scan_table(spark, root))
    first = records.select(F.min("ts")).scalar()
    passed_us = F.unix_micros("ts") - F.unix_micros(first)
    return (
        records.groupBy(F.call_function("div", passed_us, F.lit(100_000)).alias("slot"))
        .agg(
            F.count("*").alias("records"),
            F.min("index").alias("first_index"),
            F.max("index").alias("last_index"),
        )
    )


def restart_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, replayed in batches by a job whose first run fails in the middle, whose
    second is stopped by force and whose third does the rest."""
    rows = events(spark, sf_dir).select("event_id", "ts")
    path = scratch_path(spark, "replay")
    rows.repartitionByRange(4, "event_id").write.parquet(path)
    middle = rows.agg(F.avg("event_id")).first()[0] or 0
    root, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    runs = iter([middle])

    def render(index, ts):
        limit = next(runs, None)
        text = record_text(index, ts)
        if limit is None:
            return text
        return F.when(index > limit, F.raise_error(F.lit("planned failure"))).otherwise(text)

    def build():
        source = generator.replay_stream(spark, path, max_files=1)
        records = as_records(source, F.col("event_id"), F.col("ts"), render)
        return text_writer(records, root, state, available_now=True, spread=True)

    job = StreamJob(build, restarts=1).start()
    try:
        job.query.awaitTermination()
    except StreamingQueryException:
        job.restart()
    job.stop(force=True)
    job.start().wait_for_end()
    return tables.scan_table(spark, root)


def _generated(spark: SparkSession, count: int) -> str:
    root, state = scratch_path(spark, "stream"), scratch_path(spark, "state")
    records = generator.stream_records(
        spark, rate=count, trigger_s=1, partitions=spark.sparkContext.defaultParallelism
    )
    text_writer(records, root, state, available_now=True).start().awaitTermination()
    return root


def external_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landed_table(spark, sf_dir)
    name = f"millrace_{root.rsplit('-', 1)[-1]}"
    tables.register_table(spark, name, root)
    return spark.sql("SELECT COUNT(*) AS records FROM IDENTIFIER(:name)", args={"name": name})


def scan_one_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan_bucket(spark, landed_table(spark, sf_dir), ONE_BUCKET)


def limit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tables.scan_table(spark, landed_table(spark, sf_dir))
    return filters.first_records(table.select("*"), 10)


def csv_scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    export_csv(event_records(spark, sf_dir).select("foams"), path)
    return filters.first_records(tables.scan_csv(spark, path), 10)


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts, with their spaces, quotes, commas and line ends, through CSV."""
    path = scratch_path(spark, "csv")
    docs = ship_package(spark).read.parquet(f"{sf_dir}/documents.parquet")
    export_csv(docs.select("doc_id", "text"), path)
    return tables.scan_csv(spark, path, "doc_id LONG, text STRING")


def own_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a text of the caller's."""
    records = as_records(
        events(spark, sf_dir), F.col("event_id"), F.col("ts"),
        lambda index, ts: F.concat_ws("|", index.cast("string"), hour_bucket(ts)),
    )
    return records.select("index", "foams", "bucket")


def key_pattern_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in the files whose path matches a pattern: those of the first six hours of a day."""
    root = landed_table(spark, sf_dir)
    files = tables.file_inventory(spark, root, r"bucket=[^/]*--0[0-5]/part-[^/]*\.txt$")
    rows = tables.rows_per_file(tables.scan_foreign(spark, root))
    name = F.element_at(F.split("path", "/"), -1)
    met = rows.withColumn("file", name).join(files.select(name.alias("file")), "file", "left_semi")
    return met.agg(F.sum("records").alias("records"))


def roll_by_inactivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(spark, sf_dir)
    rolled = parts.roll_by_inactivity(records, POLICY.max_idle_s, keep=[], **all_cores(spark))
    return rolled.select("bucket", "index", "part")


def assign_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = event_parts(spark, sf_dir, 1, **all_cores(spark))
    return assigned.select("bucket", "subtask", "index", "part")


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.part_summary(event_parts(spark, sf_dir, 2))


def part_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir).select(
        "bucket", "subtask", "part", "records", "bytes",
        F.unix_micros("opened").alias("opened_us"), F.unix_micros("closed").alias("closed_us"),
    )


def rolled_table(spark: SparkSession, sf_dir: str) -> str:
    """Root of a table written by the exact rule, once per application."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} rolled")
    if key not in _landed:
        root = scratch_path(spark, "rolled")
        write_parts(event_records(spark, sf_dir), root, FILE_POLICY, 2)
        _landed[key] = root
    return _landed[key]


def rolled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and bytes of every file of that table, from its listing."""
    files = tables.part_files(spark, rolled_table(spark, sf_dir))
    return files.select("bucket", "subtask", "part", "records", F.col("length").alias("bytes"))


def last_rolled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five files of the listing."""
    newest = tables.last_part_files(spark, rolled_table(spark, sf_dir), 5)
    return newest.select(parts.part_name().alias("name"), "records", F.col("length").alias("bytes"))


def rolled_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and bytes of the files of that table."""
    root = rolled_table(spark, sf_dir)
    return tables.inventory_summary(tables.file_inventory(spark, root, r"\.txt$"))


def recent_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = parts.last_parts(_summary(spark, sf_dir), 5)
    return newest.select(parts.part_name().alias("name"), "records", "bytes")


def layout_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.layout_summary(_summary(spark, sf_dir))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes on disk of each hour, from the listing of the written table."""
    files = tables.file_inventory(spark, landed_table(spark, sf_dir), r"/part-[^/]*\.txt$")
    return files.groupBy(tables.inventory_bucket().alias("bucket")).agg(
        F.sum("length").alias("bytes")
    )


def rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every file of the written table, by the hour in the file's path."""
    files = tables.rows_per_file(tables.scan_foreign(spark, landed_table(spark, sf_dir)))
    return files.groupBy(tables.inventory_bucket().alias("bucket")).agg(
        F.sum("records").alias("records")
    )


def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = filters.recent(events(spark, sf_dir), timedelta(days=1))
    return newest.select("event_id", "event_type")


def last_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten newest messages of the recent window."""
    newest = filters.recent(events(spark, sf_dir), timedelta(days=1))
    return filters.last_events(newest, 10, "ts", "event_id").select("event_id", "event_type")


def error_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filters.containing(events(spark, sf_dir), "error", "event_type")
    return found.select("event_id", "event_type")


def pattern_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filters.matching(events(spark, sf_dir), "SIGN|ERROR", "event_type", ignore_case=True)
    return found.select("event_id", "event_type")


def pattern_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count of lines that match a pattern, and of those that do not."""
    return filters.pattern_counts(events(spark, sf_dir), r"\"k\": \d\d?\}", "props")


def table_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line count of the table and the bytes its lines take."""
    return tables.scan_table(spark, landed_table(spark, sf_dir)).agg(
        F.count("*").alias("records"), F.sum(line_bytes(F.col("foams"))).alias("bytes")
    )


def health_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the event records against the parts they roll into."""
    return health.scorecard(
        event_records(spark, sf_dir),
        _summary(spark, sf_dir),
        F.lit(f"{AS_OF}Z").cast("timestamp"),
        FRESH_S,
        MAX_FILE_BYTES,
        length="bytes",
    )


QUERIES = {
    f.__name__: f
    for f in (
        generate_records, format_event_records, parse_records, hourly_bucket_counts,
        text_sink_roundtrip, stream_generated, restart_exactly_once,
        external_table_count, scan_one_bucket, limit_records, csv_scan_limit,
        csv_text_roundtrip, own_render, key_pattern_count,
        roll_by_inactivity, assign_parts, part_summary, recent_parts, layout_summary,
        rolled_files, last_rolled_files, rolled_layout, file_inventory, rows_per_file, recent_events, last_events, error_events, pattern_events,
        pattern_counts, table_size, health_scorecard,
    )
}
