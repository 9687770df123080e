"""Named savepoints of a job: its position and the commit log of its table, to go back to.

A savepoint is a copy of the checkpoint and of the table's log. The job must be stopped meanwhile, as
is the rule for a restore too; given the job, both refuse one that runs. The files of the table are not copied. After a restore the table shows what was committed then, and the
job reads again exactly what came later. Files written in between stay where they are, unseen.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.streaming.jobs import StreamJob

LOG = "_spark_metadata"


def check_stopped(job: StreamJob | None) -> None:
    if job is not None and job.query is not None and job.query.isActive:
        raise RuntimeError("stop the job before its position is saved or restored")


class Savepoints:
    """Savepoints in ``folder`` of the job on ``checkpoint`` that writes to ``root``."""

    def __init__(self, spark: SparkSession, folder: str, checkpoint: str, root: str) -> None:
        self.spark = spark
        self.folder, self.checkpoint = folder.rstrip("/"), checkpoint.rstrip("/")
        self.log = f"{root.rstrip('/')}/{LOG}"
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self, name: str):
        return self._path(name).getFileSystem(self._conf)

    def _copy(self, source: str, target: str) -> None:
        """Copy a folder, if there is one, in the place of another. The copy takes its name when
        it is complete."""
        part = f"{target}.copy"
        self._files(target).delete(self._path(part), True)
        if self._files(source).exists(self._path(source)):
            self.spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
                self._files(source), self._path(source), self._files(part), self._path(part),
                False, self._conf,
            )
        self._files(target).delete(self._path(target), True)
        if self._files(target).exists(self._path(part)):
            self._files(target).mkdirs(self._path(target).getParent())
            self._files(target).rename(self._path(part), self._path(target))

    def names(self) -> list[str]:
        """Savepoints that are complete."""
        files = self._files(self.folder)
        if not files.exists(self._path(self.folder)):
            return []
        found = [f.getPath().getName() for f in files.listStatus(self._path(self.folder))]
        return sorted(n for n in found if files.exists(self._path(f"{self.folder}/{n}/done")))

    def save(self, name: str, job: StreamJob | None = None) -> None:
        """Take a savepoint; a name is given once."""
        check_stopped(job)
        if name in self.names():
            raise ValueError(f"there is a savepoint {name} already")
        place = f"{self.folder}/{name}"
        self._copy(self.checkpoint, f"{place}/checkpoint")
        self._copy(self.log, f"{place}/log")
        self._files(place).create(self._path(f"{place}/done"), True).close()

    def restore(self, name: str, job: StreamJob | None = None) -> None:
        """Go back to a savepoint. A restore that was cut off is simply made again."""
        check_stopped(job)
        if name not in self.names():
            raise ValueError(f"there is no savepoint {name}")
        place = f"{self.folder}/{name}"
        # The log goes first: a position before it would write batches that the table has.
        self._copy(f"{place}/log", self.log)
        self._copy(f"{place}/checkpoint", self.checkpoint)
