"""Sinks: hour directories of text written exactly once, and CSV export."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from millrace.functions.records import MAX_LINE_BYTES
from millrace.operators.parts import GROUP, assign_parts, group_slices
from millrace.operators.policy import RollPolicy
from millrace.sources.generator import LiveRecords
from millrace.sources.tables import CSV_OPTIONS, guarded

PLACE = [*GROUP, "part"]
# Characters that a directory name of a partition spells by their codes, as Spark does.
_SPELLED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^")]}


def by_bucket(records: DataFrame, spread: bool) -> DataFrame:
    """The two columns a text table takes.

    ``spread`` shuffles by hour so that a task writes few directories: adaptive execution
    then splits hours that are large and merges small ones. Live streams do not need it,
    as a batch holds one or two hours.
    """
    out = records.select("foams", "bucket")
    return out.hint("rebalance", "bucket") if spread else out


def text_writer(
    records: DataFrame | LiveRecords,
    root: str,
    checkpoint: str,
    policy: RollPolicy = RollPolicy(),
    name: str | None = None,
    trigger_s: float | None = None,
    available_now: bool = False,
    spread: bool = False,
    max_line_bytes: int = MAX_LINE_BYTES,
) -> DataStreamWriter:
    """Writer of a record stream to ``root/bucket=<hour>/``.

    Every micro-batch closes its files, so the trigger bounds age and idle time of a part;
    ``maxRecordsPerFile`` bounds its size, for lines of at most ``max_line_bytes``: a longer
    one fails the batch. Files count once the batch is committed. The trigger is the shortest
    of ``trigger_s`` (60 s) and the two limits; a generated stream has its own and is refused
    if that is longer, as another one would change its rate and instants.
    """
    limits = [x for x in (policy.max_age_s, policy.max_idle_s) if x is not None]
    if isinstance(records, LiveRecords):
        if trigger_s not in (None, records.trigger_s):
            raise ValueError(f"the records are paced for a trigger of {records.trigger_s} s")
        trigger_s = records.trigger_s
        if not available_now and trigger_s > min([trigger_s, *limits]):
            raise ValueError(f"a trigger of {trigger_s} s breaks the limits of {policy}")
        records = records.frame
    trigger_s = min([60 if trigger_s is None else trigger_s, *limits])
    if policy.max_bytes is not None:
        line = F.col("foams")
        long_line = F.raise_error(F.lit(f"a line is longer than {max_line_bytes} bytes"))
        checked = F.when(F.octet_length(line) >= max_line_bytes, long_line).otherwise(line)
        records = records.withColumn("foams", checked)
    writer = (
        by_bucket(records, spread)
        .writeStream.format("text")
        .outputMode("append")
        .partitionBy("bucket")
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", policy.max_records(max_line_bytes))
    )
    if name:
        writer = writer.queryName(name)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{round(trigger_s * 1000)} milliseconds")


def write_stream(
    records: DataFrame | LiveRecords, root: str, checkpoint: str, **options
) -> StreamingQuery:
    """Start the stream that :func:`text_writer` describes."""
    return text_writer(records, root, checkpoint, **options).start()


def write_parts(
    records: DataFrame, root: str, policy: RollPolicy = RollPolicy(), parallelism: int = 1, **options
) -> None:
    """Write a finite table by the exact rolling rule, one file for each part:
    ``root/bucket=<hour>/subtask=<n>/part=<n>/``.

    A part's lines meet in one task, which streams them to its file in order of instant and
    index; parts, not hours, are dealt out, so a hot hour is the work of many tasks. ``root``
    must not be there yet.

    In a folder of the machine, or one mounted on all of them, tasks write the files themselves:
    Hadoop's local file system starts two processes for every file it makes, which for small
    parts takes far longer than all the rest. Other file systems get them from Spark's writer.
    """
    assigned = assign_parts(records, policy, parallelism, keep=["foams"], **options)
    rows = (
        assigned.repartition(*PLACE)
        .sortWithinPartitions(*PLACE, "ts", "index")
        .select("foams", *PLACE)
    )
    path = records.sparkSession._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(records.sparkSession._jsc.hadoopConfiguration())
    if files.getUri().getScheme() == "file":
        _write_local(rows, files, files.makeQualified(path))
    else:
        rows.write.partitionBy(*PLACE).text(root)


def _write_local(rows: DataFrame, files, root) -> None:
    """Files are made in a hidden folder beside ``root``, which gets its name when all are done:
    a job that fails leaves nothing."""
    if files.exists(root):
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {root} already exists.")
    jvm = rows.sparkSession._jvm.org.apache.hadoop.fs
    staged = jvm.Path(root.getParent(), f".{root.getName()}-{uuid.uuid4().hex}")
    lines = rows.withColumn("foams", F.col("foams").cast("binary"))
    try:
        lines.mapInArrow(part_files(staged.toUri().getPath()), "files long").agg(F.sum("files")).first()
        files.create(jvm.Path(staged, "_SUCCESS"), True).close()
        if not files.rename(staged, root):
            raise OSError(f"{staged} could not be renamed to {root}")
    except BaseException:
        files.delete(staged, True)
        raise


def part_files(root: str):
    """Write the sorted lines of a task, one file for each part. A file gets its name when it is
    whole, so a task that is run again only replaces it by the same."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, folder, out, count = None, "", None, 0
        unfinished = f".{uuid.uuid4().hex}"

        def finish() -> None:
            if out is not None:
                out.close()
                os.replace(f"{folder}/{unfinished}", f"{folder}/part-0.txt")

        for batch in batches:
            lines = [x or b"" for x in batch.column("foams").to_pylist()]
            for key, begin, end in group_slices(batch, PLACE):
                if key != current:
                    finish()
                    current, folder = key, f"{root}/{part_folder(key)}"
                    os.makedirs(folder, exist_ok=True)
                    out, count = open(f"{folder}/{unfinished}", "wb"), count + 1
                out.write(b"\n".join(lines[begin:end]) + b"\n")
        finish()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["files"])

    return write


def part_folder(key: tuple) -> str:
    """``bucket=<hour>/subtask=<n>/part=<n>``, spelled as Spark spells it."""
    texts = ["" if x is None else str(x) for x in key]
    values = [x.translate(_SPELLED) or "__HIVE_DEFAULT_PARTITION__" for x in texts]
    return "/".join(f"{name}={value}" for name, value in zip(PLACE, values))


def export_csv(rows: DataFrame, path: str, mode: str = "error") -> None:
    """Headerless CSV result. Every value is quoted, so spaces at the ends, separators, quotes
    and line ends survive."""
    guarded(rows).write.mode(mode).options(**CSV_OPTIONS).option("quoteAll", True).csv(path)
