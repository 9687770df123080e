"""What is known of the files of a growing table, kept beside it and brought up to date from the
sink's commit log: only files that are new since the last time are opened.

The log of a table has a file for each batch and, every few batches, a compact one with all
before it. From it come the committed files with their bytes, without listing a directory. Of each
new file the lines are counted once, with the least and greatest index and instant among them;
of the indices a bit each is kept, 64 neighbours to a word. Totals, the newest files, the lines of
a recent span and the health score then follow from these facts.

An update is a folder named after the last batch it covers. It counts once it is complete, so one
that was cut off is simply made again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import timedelta
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.records import parse_records
from millrace.operators.health import index_words, words_profile
from millrace.sources.tables import LINE_SCHEMA, inventory_bucket

LOG = "_spark_metadata"
ENTRY = "path string, size long, modificationTime long, action string"
FILES = (
    "path string, length long, modificationTime timestamp, records long, parsed long, "
    "first_index long, last_index long, oldest timestamp, newest timestamp"
)
# Files whose paths the driver holds at a time.
LOT = 10_000


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []


def log_files(spark: SparkSession, root: str, after: int = -1) -> tuple[list[str], int]:
    """The files of the log that hold everything past batch ``after``, and the newest batch."""
    found = [re.fullmatch(r"(\d+)(\.compact)?", n) for n in _names(spark, f"{root}/{LOG}")]
    batches = sorted((int(m[1]), bool(m[2])) for m in found if m)
    if not batches:
        return [], -1
    compact = max((b for b, whole in batches if whole), default=-1)
    wanted = [b for b in batches if b[0] > after]
    if after < compact:
        wanted = [b for b in batches if b[0] >= compact]
    return [f"{root}/{LOG}/{b}{'.compact' if whole else ''}" for b, whole in wanted], batches[-1][0]


def committed_files(spark: SparkSession, root: str, after: int = -1) -> DataFrame:
    """``path, length, modificationTime`` of the committed files of a table; of the batches past
    ``after`` at least."""
    paths, _ = log_files(spark, root.rstrip("/"), after)
    if not paths:
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    # A DataFrame reader passes over a folder of that name, so the lines come as an RDD. The line
    # with the version is no entry and reads as nulls.
    entries = spark.read.schema(ENTRY).json(spark.sparkContext.textFile(",".join(paths)))
    return entries.filter("action = 'add'").select(
        "path", F.col("size").alias("length"),
        F.timestamp_millis("modificationTime").alias("modificationTime"),
    )


def place(path: str) -> Column:
    """Hour and name of a file; a log and a scan may spell the rest of its path differently."""
    return F.substring_index(path, "/", -2)


class TableFacts:
    """Facts of the table at ``root``, kept in ``folder``."""

    def __init__(self, spark: SparkSession, root: str, folder: str) -> None:
        self.spark, self.root, self.folder = spark, root.rstrip("/"), folder.rstrip("/")

    def covered(self) -> int:
        """The last batch that is known, -1 before the first update."""
        return max(self._updates(), default=-1)

    def _updates(self) -> list[int]:
        numbers = [int(n) for n in _names(self.spark, f"{self.folder}/files") if n.isdigit()]
        return [n for n in numbers if "_SUCCESS" in _names(self.spark, f"{self.folder}/files/{n}")]

    def _read(self, name: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{name}/{n}" for n in self._updates()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def files(self) -> DataFrame:
        """A row for each known file."""
        return self._read("files", FILES)

    def words(self) -> DataFrame:
        """Index words of all known files; a word may stand in several updates."""
        return self._read("words", _words_schema(self.spark))

    def update(self) -> int:
        """Take in what was committed since; returns the last batch covered."""
        after = self.covered()
        _, newest = log_files(self.spark, self.root, after)
        if newest <= after:
            return after
        listed = committed_files(self.spark, self.root, after).filter("length > 0")
        new = listed.join(self.files().select("path"), "path", "left_anti")
        mode = "overwrite"
        for paths in self._lots(new):
            lines = self.spark.read.schema(LINE_SCHEMA).text(paths)
            index_words(lines).write.mode(mode).parquet(f"{self.folder}/words/{newest}")
            counted = parse_records(lines.select("foams", place("_metadata.file_path").alias("place")))
            facts = counted.groupBy("place").agg(
                F.count("*").alias("records"), F.count("index").alias("parsed"),
                F.min("index").alias("first_index"), F.max("index").alias("last_index"),
                F.min("ts").alias("oldest"), F.max("ts").alias("newest"),
            )
            facts.write.mode(mode).parquet(f"{self.folder}/counted/{newest}")
            mode = "append"
        if mode == "append":
            facts = self.spark.read.parquet(f"{self.folder}/counted/{newest}")
            whole = new.withColumn("place", place("path")).join(facts, "place", "left").select(*[x.split()[0] for x in FILES.split(", ")])
        else:
            whole = self.spark.createDataFrame([], FILES)
            self.spark.createDataFrame([], _words_schema(self.spark)).write.mode(mode).parquet(
                f"{self.folder}/words/{newest}"
            )
        # This folder makes the update count.
        whole.write.mode("overwrite").parquet(f"{self.folder}/files/{newest}")
        return newest

    @staticmethod
    def _lots(files: DataFrame) -> Iterator[list[str]]:
        for rows in batched(files.select("path").toLocalIterator(), LOT):
            yield [r["path"] for r in rows]

    def last_files(self, n: int) -> DataFrame:
        """The last ``n`` files in path order; no file of the table is opened."""
        return self.files().orderBy(F.col("path").desc()).limit(n)

    def per_hour(self) -> DataFrame:
        """Files, lines and bytes of each hour."""
        return self.files().groupBy(inventory_bucket().alias("bucket")).agg(
            F.count("*").alias("files"), F.sum("records").alias("records"),
            F.sum("length").alias("bytes"),
        )

    def profile(self) -> DataFrame:
        """The row that :func:`millrace.operators.health.index_profile` gives for all lines."""
        return words_profile(self.words())

    def recent(self, within: timedelta, as_of=None) -> DataFrame:
        """``foams, index, ts`` of the records of the last ``within``, back from ``as_of`` or
        from the newest record. Only files that reach into that span are opened."""
        files = self.files()
        if as_of is None:
            as_of = F.lit(files.agg(F.max("newest")).first()[0])
        bound = files.sparkSession.range(1).select((as_of - F.lit(within)).alias("b")).first()["b"]
        if bound is None:
            return parse_records(self.spark.createDataFrame([], LINE_SCHEMA))
        paths = [r["path"] for r in files.filter(F.col("newest") >= F.lit(bound)).select("path").collect()]
        if not paths:
            return parse_records(self.spark.createDataFrame([], LINE_SCHEMA))
        lines = self.spark.read.schema(LINE_SCHEMA).text(paths)
        return parse_records(lines).filter(F.col("ts") >= F.lit(bound))


def _words_schema(spark: SparkSession) -> str:
    empty = index_words(spark.createDataFrame([], LINE_SCHEMA))
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in empty.schema)
