"""Queries over jobs as they grow, stop, fail and change, each over all events."""

from __future__ import annotations

import time
from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.records import as_records, record_text
from millrace.operators import health
from millrace.plans.queries import (
    AS_OF, FILE_POLICY, FRESH_S, LAND_POLICY, POLICY, event_records, events, rolled_table,
)
from millrace.session import scratch_path
from millrace.sources import generator, tables
from millrace.sources.facts import TableFacts
from millrace.streaming.jobs import ProgressLog, StreamJob
from millrace.streaming.live_parts import assign_live
from millrace.streaming.savepoints import Savepoints
from millrace.streaming.sink import text_writer

MARK = "#2"


class GrowingSource:
    """Events that arrive in two halves, split at the mean instant, in a folder that a stream
    reads."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.path = spark, scratch_path(spark, "growing")
        self.rows = events(spark, sf_dir).select("event_id", "ts")
        us = F.unix_micros(F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp"))
        self.middle = self.rows.agg(F.floor(F.avg(us))).first()[0] or 0
        self.us = us

    def add(self, first: bool) -> None:
        chosen = self.us <= self.middle if first else self.us > self.middle
        self.rows.filter(chosen).write.mode("append").parquet(self.path)

    def records(self, render=record_text) -> DataFrame:
        source = generator.replay_stream(self.spark, self.path)
        return as_records(source, F.col("event_id"), F.col("ts"), render)


def foreign_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per hour of a table in plain hour directories, beside hidden and unfinished files,
    and of an empty location."""
    root, written = scratch_path(spark, "foreign"), scratch_path(spark, "written")
    event_records(spark, sf_dir).select("foams", "bucket").write.partitionBy("bucket").text(written)
    jvm = spark._jvm.org.apache.hadoop.fs
    place = jvm.Path(root)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    for found in files.listStatus(jvm.Path(written)):  # a name for each hour
        name = found.getPath().getName()
        if name.startswith("bucket="):
            hour = jvm.Path(f"{root}/{name.removeprefix('bucket=')}")
            files.rename(found.getPath(), hour)
            files.create(jvm.Path(f"{hour}/.part-0-3.inprogress.x"), True).close()
            out = files.create(jvm.Path(f"{hour}/_part-0-4"), True)
            out.write(bytearray(b"not finished\n"))
            out.close()
    files.mkdirs(jvm.Path(f"{root}-empty"))
    none = tables.register_table(spark, f"millrace_{root.rsplit('-', 1)[-1]}", f"{root}-empty")
    lines = tables.scan_foreign(spark, root).select("bucket").unionByName(
        none.select(F.lit("nowhere").alias("bucket"))
    )
    return lines.groupBy("bucket").agg(F.count("*").alias("records"))


def redeploy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named job writes the first half of the events and is redeployed with another text for
    the second, on the same checkpoint."""
    source = GrowingSource(spark, sf_dir)
    root, state = scratch_path(spark, "table"), scratch_path(spark, "state")

    def build(render):
        return lambda: text_writer(
            source.records(render), root, state, LAND_POLICY, name=f"job {root[-8:]}",
            available_now=True, spread=True, max_line_bytes=100,
        )

    source.add(first=True)
    job = StreamJob(build(record_text)).start()
    job.wait_for_end()
    source.add(first=False)
    job.redeploy(build(lambda index, ts: F.concat(record_text(index, ts), F.lit(MARK))))
    job.wait_for_end()
    return tables.scan_table(spark, root)


def restore_savepoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job writes all events in two halves; then it goes back to the savepoint between them and
    writes the second half again with another text."""
    source = GrowingSource(spark, sf_dir)
    root, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    saved = Savepoints(spark, scratch_path(spark, "savepoints"), state, root)

    def build(render):
        return lambda: text_writer(
            source.records(render), root, state, LAND_POLICY, available_now=True, spread=True,
            max_line_bytes=100,
        )

    job = StreamJob(build(record_text))
    for first in (True, False):
        source.add(first)
        job.start().wait_for_end()
        saved.save("half" if first else "all", job)
    saved.restore("half", job)
    job.redeploy(build(lambda index, ts: F.concat(record_text(index, ts), F.lit(MARK))))
    job.wait_for_end()
    return tables.scan_table(spark, root)


def progress_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reports of a job tell whose first run fails in the second half of the events: rows
    read by the batches that were done, endings with and without an error."""
    source = GrowingSource(spark, sf_dir)
    root, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    log = ProgressLog(spark, scratch_path(spark, "log"), batch=3)
    middle, runs = source.middle, iter([False, True])

    def render(index, ts):
        text = record_text(index, ts)
        if not next(runs, False):
            return text
        late = F.unix_micros(ts.cast("timestamp")) > middle
        return F.when(late, F.raise_error(F.lit("planned failure"))).otherwise(text)

    job = StreamJob(
        lambda: text_writer(source.records(render), root, state, LAND_POLICY, available_now=True, spread=True),
        restarts=1,
    )
    spark.streams.addListener(log)
    ids = []
    try:
        for first in (True, False):
            source.add(first)
            job.start()
            ids.append(str(job.query.runId))
            try:
                job.query.awaitTermination()
            except StreamingQueryException:
                job.restart()
                ids.append(str(job.query.runId))
                job.wait_for_end()
        job.wait_for("READY", polls=50, interval_s=0.2)
        await_endings(log, ids)
    finally:
        spark.streams.removeListener(log)
    # A new log over the folder, as after the end of the driver, finds all of it.
    again = ProgressLog(spark, log.folder)
    read = again.table().agg(F.coalesce(F.sum("numInputRows"), F.lit(0)).alias("rows_read"))
    ended = again.endings().filter(F.col("runId").isin(ids)).agg(
        F.count_if(F.col("error").contains("planned failure")).alias("failures"),
        F.count_if(F.col("error").isNull()).alias("finished"),
    )
    both = read.unionByName(ended, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def await_endings(log: ProgressLog, ids: list[str], seconds: float = 60) -> None:
    """Reports reach a listener a little after the query has ended."""
    end = time.monotonic() + seconds
    while log.endings().filter(F.col("runId").isin(ids)).count() < len(ids):
        if time.monotonic() > end:
            raise TimeoutError("the endings of the queries were not reported")
        time.sleep(0.2)


def live_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of all events as a stream decides them, with a restart half way."""
    source = GrowingSource(spark, sf_dir)
    root, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    for first in (True, False):
        source.add(first)
        parts = assign_live(source.records(), POLICY, keep=[]).select("bucket", "subtask", "index", "part")
        writer = parts.writeStream.format("parquet").option("path", root)
        writer = writer.option("checkpointLocation", state).trigger(availableNow=True)
        writer.start().awaitTermination()
    return spark.read.schema("bucket string, subtask long, index long, part long").parquet(root)


def grown_facts(spark: SparkSession, sf_dir: str) -> TableFacts:
    """Facts of a table that grew in two halves, brought up to date after each."""
    source = GrowingSource(spark, sf_dir)
    root, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    facts = TableFacts(spark, root, scratch_path(spark, "facts"))
    for first in (True, False):
        source.add(first)
        writer = text_writer(
            source.records(), root, state, LAND_POLICY, available_now=True, spread=True
        )
        writer.start().awaitTermination()
        facts.update()
    return facts


def facts_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and bytes of each hour from the facts of the files."""
    return grown_facts(spark, sf_dir).per_hour().select("bucket", "records", "bytes")


def recent_by_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the last day; only files that reach into it are opened."""
    found = grown_facts(spark, sf_dir).recent(timedelta(days=1))
    return found.select("index", "foams")


def grown_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health score of a grown table from its facts and the sizes of its files."""
    facts = grown_facts(spark, sf_dir)
    as_of = F.lit(f"{AS_OF}Z").cast("timestamp")
    return health.checks(facts.profile(), facts.files(), as_of, FRESH_S, LAND_POLICY.max_bytes)


def listing_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health score of the rolled table, from its lines and its listing."""
    root = rolled_table(spark, sf_dir)
    as_of = F.lit(f"{AS_OF}Z").cast("timestamp")
    return health.scorecard(
        tables.in_longer_tasks(tables.scan_foreign(spark, root)), tables.listed_parts(spark, root),
        as_of, FRESH_S, FILE_POLICY.max_bytes + 82,
    )


QUERIES = {
    f.__name__: f
    for f in (
        foreign_layout, redeploy, restore_savepoint, progress_rows, live_parts, facts_per_hour, recent_by_facts,
        grown_scorecard, listing_scorecard,
    )
}
