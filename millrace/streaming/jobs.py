"""Start, stop, restart, redeploy and observe a streaming job."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce
from threading import RLock

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

# The states of a job.
READY, STARTING, RUNNING, STOPPING = "READY", "STARTING", "RUNNING", "STOPPING"
RESTARTING, FAILED = "RESTARTING", "FAILED"

PROGRESS_SCHEMA = (
    "name string, batchId long, timestamp string, numInputRows long, "
    "inputRowsPerSecond double, processedRowsPerSecond double, durationMs long"
)
REPORT_SCHEMA = f"seq long, {PROGRESS_SCHEMA}, runId string, error string"


class StreamJob:
    """A named streaming job on one checkpoint.

    ``build`` makes the writer; its checkpoint carries the position, so a start after a
    stop, a failure or a redeploy goes on where the last committed batch ended. After a
    failure the job is ``RESTARTING`` up to ``restarts`` times: ``wait_for``, ``wait_for_end``
    or ``restart`` start it again.
    """

    def __init__(self, build: Callable[[], DataStreamWriter], restarts: int = 0) -> None:
        self.build = build
        self.restarts_left = restarts
        self.query: StreamingQuery | None = None
        self._stopping = False

    def start(self) -> StreamJob:
        if self.query is not None and self.query.isActive:
            raise RuntimeError("the job is already running")
        self.query = self.build().start()
        return self

    def status(self) -> str:
        if self.query is None:
            return READY
        if self.query.isActive:
            if self._stopping:
                return STOPPING
            return RUNNING if self.query.lastProgress else STARTING
        if not self.query.exception():
            return READY
        return RESTARTING if self.restarts_left else FAILED

    def restart(self) -> StreamJob:
        """Go on from the last committed batch after a failure."""
        if self.status() != RESTARTING:
            raise RuntimeError(f"a job that is {self.status()} has no restart left")
        self.restarts_left -= 1
        return self.start()

    def wait_for_end(self) -> None:
        """Wait until the job has done all there is, restarting it while that is allowed."""
        while True:
            try:
                self.query.awaitTermination()
                return
            except StreamingQueryException:
                if self.status() != RESTARTING:
                    raise
                self.restart()

    def failure(self) -> str | None:
        """Text of the error that ended the job."""
        error = self.query.exception() if self.query else None
        return str(error) if error else None

    def stop(self, force: bool = False, polls: int = 60, interval_s: float = 10) -> None:
        """Stop the job. A graceful stop lets a batch that is under way finish first; after
        the polls it stops anyway, as a forced stop does at once. Both keep exactly-once."""
        if self.query is None or not self.query.isActive:
            return
        self._stopping = True
        try:
            if not force:
                busy = self.query.status.get("isTriggerActive")
                before = self._batch()
                for _ in range(polls):
                    idle = not self.query.status.get("isTriggerActive")
                    if not busy or idle or self._batch() != before or not self.query.isActive:
                        break
                    time.sleep(interval_s)
            self.query.stop()
        finally:
            self._stopping = False

    def _batch(self) -> int | None:
        progress = self.query.lastProgress
        return progress["batchId"] if progress else None

    def wait_for(self, state: str, polls: int = 60, interval_s: float = 10) -> None:
        """Poll until the job is in ``state``; raise when it fails or takes too long."""
        for attempt in range(polls):
            now = self.status()
            if now == state:
                return
            if now == RESTARTING:
                self.restart()
            if now == FAILED:
                raise RuntimeError(f"job failed: {self.failure()}")
            if attempt + 1 < polls:
                time.sleep(interval_s)
        raise TimeoutError(f"job is {self.status()}, not {state}, after {polls} polls")

    def redeploy(self, build: Callable[[], DataStreamWriter], **stop_options) -> StreamJob:
        """Stop, take the new definition, start on the same checkpoint.

        The new one may render or pace records differently; another kind of source needs
        a checkpoint of its own.
        """
        self.stop(**stop_options)
        self.build = build
        return self.start()

    def progress(self, spark: SparkSession) -> DataFrame:
        return progress_table(spark, self.query.recentProgress if self.query else [])


def progress_table(spark: SparkSession, entries) -> DataFrame:
    """Table of progress reports. Spark keeps the last 100 of a query."""
    rows = [
        (
            e["name"], e["batchId"], e["timestamp"], e["numInputRows"],
            e["inputRowsPerSecond"], e["processedRowsPerSecond"],
            (e["durationMs"] or {}).get("triggerExecution"),
        )
        for e in entries
    ]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Keeps every progress report and ending of the queries of a session in ``folder``, which
    all machines share.

    A report is a small file of its own, with a sequence number, before the call that brings it
    returns, so the end of the driver loses nothing. ``batch`` of them are merged into a Parquet
    table; a report that is found both there and as a file, because the merge was cut off, is
    read once. A new log over the same folder goes on with the numbers.
    """

    def __init__(self, spark: SparkSession, folder: str, batch: int = 200) -> None:
        self.spark, self.folder, self.batch = spark, folder.rstrip("/"), batch
        self._lock = RLock()
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._files.mkdirs(self._path("pending"))
        self._pending = [f.getPath().getName() for f in self._files.listStatus(self._path("pending"))]
        merged = self._merged()
        last = merged.agg(F.max("seq")).first()[0] if merged is not None else None
        named = [int(n.split(".")[0]) for n in self._pending if n.endswith(".json")]
        self._next = max([-1 if last is None else last, *named]) + 1

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._append(
            name=p.name, batchId=p.batchId, timestamp=p.timestamp, numInputRows=p.numInputRows,
            inputRowsPerSecond=p.inputRowsPerSecond, processedRowsPerSecond=p.processedRowsPerSecond,
            durationMs=dict(p.durationMs).get("triggerExecution"),
        )

    def onQueryTerminated(self, event) -> None:
        self._append(runId=str(event.runId), error=event.exception)

    def _append(self, **report) -> None:
        with self._lock:
            # A rate of nothing in no time is no number, which JSON cannot hold.
            report = {k: v if v == v else None for k, v in report.items()}
            name = f"{self._next:015d}.json"
            line = json.dumps({"seq": self._next, **report}).encode()
            out = self._files.create(self._path(f"pending/.{name}"), True)
            out.write(bytearray(line))
            out.close()
            self._files.rename(self._path(f"pending/.{name}"), self._path(f"pending/{name}"))
            self._pending.append(name)
            self._next += 1
            if len(self._pending) >= self.batch:
                self.flush()

    def flush(self) -> None:
        """Merge the small files into the table."""
        with self._lock:
            pending = self._read_pending()
            if pending is not None:
                pending.coalesce(1).write.mode("append").parquet(f"{self.folder}/merged")
                for name in self._pending:
                    self._files.delete(self._path(f"pending/{name}"), False)
                self._pending = []

    def _read_pending(self) -> DataFrame | None:
        paths = [f"{self.folder}/pending/{n}" for n in self._pending if n.endswith(".json")]
        return self.spark.read.schema(REPORT_SCHEMA).json(paths) if paths else None

    def _merged(self) -> DataFrame | None:
        path = self._path("merged")
        if not self._files.exists(path):
            return None
        return self.spark.read.schema(REPORT_SCHEMA).parquet(f"{self.folder}/merged")

    def reports(self) -> DataFrame:
        """All reports and endings so far, by ``seq``."""
        with self._lock:
            found = [x for x in (self._merged(), self._read_pending()) if x is not None]
        empty = self.spark.createDataFrame([], REPORT_SCHEMA)
        return reduce(DataFrame.unionByName, found, empty).dropDuplicates(["seq"])

    def table(self) -> DataFrame:
        """All progress reports so far."""
        return self.reports().filter("runId IS NULL").drop("seq", "runId", "error")

    def endings(self) -> DataFrame:
        """``runId, error`` of all queries that ended so far."""
        return self.reports().filter("runId IS NOT NULL").select("runId", "error")
