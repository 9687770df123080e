"""Scans of text tables and of their file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from millrace.functions.records import BUCKET_PATTERN

LINE_SCHEMA = "foams STRING"
TABLE_SCHEMA = "foams STRING, bucket STRING"

NULL_MARK = "\x01"

# Both sides of a CSV file: nothing is trimmed, quotes are doubled, line ends stay as they
# are, and a null is a control character, so it differs from an empty text.
CSV_OPTIONS = {
    "header": False,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": NULL_MARK,
    "emptyValue": "",
}


def scan_table(spark: SparkSession, root: str) -> DataFrame:
    """All records of a table this engine wrote: ``foams, bucket``.

    Reads the root, so only committed files are seen, and a filter on ``bucket`` prunes
    directories. A folder with files in another layout is refused, not read as empty.
    """
    _check_layout(spark, root)
    return spark.read.schema(TABLE_SCHEMA).text(root)


def _check_layout(spark: SparkSession, root: str) -> None:
    """Only the names in the root itself are listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return
    names = [f.getPath().getName() for f in files.listStatus(path)]
    seen = [n for n in names if not n.startswith((".", "_"))]
    if seen and "_spark_metadata" not in names and not any(n.startswith("bucket=") for n in seen):
        raise ValueError(f"{root} has {seen[0]} instead of bucket=<hour>: use scan_foreign")


def scan_bucket(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """Records of one hour. Filters the root scan: a bucket path read by itself would
    also show uncommitted files."""
    return scan_table(spark, root).filter(F.col("bucket") == bucket)


def scan_foreign(spark: SparkSession, root: str) -> DataFrame:
    """Records under plain hour directories (``2025-10-10--17/part-0-0``).

    Hidden and in-progress files (leading dot) are skipped by the reader.
    """
    return (
        spark.read.schema(LINE_SCHEMA)
        .option("recursiveFileLookup", True)
        .text(root)
        .withColumn("bucket", F.regexp_extract("_metadata.file_path", BUCKET_PATTERN, 1))
    )


def in_longer_tasks(lines: DataFrame) -> DataFrame:
    """A scan of very many small files in an eighth of the tasks, but four or more for each core.

    Spark counts a file as 4 MB or more, so a task would get 32 files at most, and its shuffle
    files would cost more than reading them.
    """
    least = 4 * lines.sparkSession.sparkContext.defaultParallelism
    return lines.coalesce(max(least, lines.rdd.getNumPartitions() // 8))


def scan_foreign_bucket(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """Records of one plain hour directory; no other directory is listed."""
    return scan_foreign(spark, f"{root.rstrip('/')}/{bucket}")


def scan_file(spark: SparkSession, path: str) -> DataFrame:
    """Records of one foreign part file."""
    return spark.read.schema(LINE_SCHEMA).text(path)


def scan_csv(spark: SparkSession, path: str, schema: str = LINE_SCHEMA) -> DataFrame:
    """Headerless CSV scan. A row that does not fit the schema fails the scan."""
    options = {**CSV_OPTIONS, "multiLine": True, "mode": "FAILFAST"}
    rows = spark.read.schema(schema).options(**options).csv(path)
    return with_texts(rows, lambda x: F.when(x.rlike(f"^{NULL_MARK}{{2,}}$"), F.substr(x, F.lit(2))))


def with_texts(rows: DataFrame, change) -> DataFrame:
    """Rows with their text columns as ``change`` gives them; as they are where that is null."""
    texts = {f.name for f in rows.schema if f.dataType == StringType()}
    quoted = {n: F.col(f"`{n}`") for n in rows.columns}
    return rows.select(*[
        F.coalesce(change(c), c).alias(n) if n in texts else c for n, c in quoted.items()
    ])


def guarded(rows: DataFrame) -> DataFrame:
    """Texts made of null marks alone get one more, which :func:`scan_csv` takes off again."""
    return with_texts(
        rows, lambda x: F.when(x.rlike(f"^{NULL_MARK}+$"), F.concat(F.lit(NULL_MARK), x))
    )


def register_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Create an external table over ``root``, at any directory depth, and return it.

    A table of that name is replaced only if it is an external one at the same place: then
    nothing but its entry in the catalog goes.
    """
    if spark.catalog.tableExists(name):
        facts = {r[0]: r[1] for r in spark.sql(
            "DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name}
        ).collect()}
        if facts.get("Type") != "EXTERNAL" or _plain(facts.get("Location", "")) != _plain(root):
            raise ValueError(f"{name} is another table: {facts.get('Type')} {facts.get('Location')}")
        spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})
    schema = spark.createDataFrame([], LINE_SCHEMA).schema
    return spark.catalog.createTable(
        name, path=root, source="text", schema=schema, recursiveFileLookup="true"
    )


def _plain(location: str) -> str:
    return location.removeprefix("file:").rstrip("/").replace("//", "/")


def file_inventory(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Listing of a folder: ``path, modificationTime, length``; file contents are not read.

    ``pattern`` keeps the paths that match it.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "modificationTime", "length")
    )
    return files.filter(F.col("path").rlike(pattern)) if pattern else files


def inventory_bucket() -> Column:
    """Hour bucket of a listed path."""
    return F.regexp_extract("path", BUCKET_PATTERN, 1)


PART_PLACE = r"/bucket=([^/]*)/subtask=(\d+)/part=(\d+)/"


def listed_parts(spark: SparkSession, root: str) -> DataFrame:
    """``bucket, subtask, part, path, length`` of a table that was written part by part, from its
    listing alone."""
    keys = [F.regexp_extract("path", PART_PLACE, i) for i in (1, 2, 3)]
    return file_inventory(spark, root, PART_PLACE + r"[^/]*\.txt$").select(
        keys[0].alias("bucket"), keys[1].cast("long").alias("subtask"),
        keys[2].cast("long").alias("part"), "path", "length",
    )


def part_files(spark: SparkSession, root: str) -> DataFrame:
    """The same with the ``records`` of each file, from one scan of the table."""
    return with_records(listed_parts(spark, root), in_longer_tasks(scan_foreign(spark, root)))


def last_part_files(spark: SparkSession, root: str, n: int) -> DataFrame:
    """The last ``n`` parts, with their ``records``: only these files are opened."""
    newest = listed_parts(spark, root).orderBy(
        *[F.col(c).desc() for c in ("bucket", "subtask", "part", "path")]
    ).limit(n)
    rows = newest.collect()  # n names
    if not rows:
        return newest.withColumn("records", F.lit(0).cast("long"))
    lines = spark.read.schema(LINE_SCHEMA).text([r["path"] for r in rows])
    return with_records(spark.createDataFrame(rows, newest.schema), lines)


def with_records(files: DataFrame, lines: DataFrame) -> DataFrame:
    """Listed parts with their line counts. Paths meet by part and name, as a listing and a scan
    may spell the rest of them differently."""
    name = F.element_at(F.split("path", "/"), -1)
    counted = rows_per_file(lines).select(
        F.regexp_extract("path", PART_PLACE, 1).alias("bucket"),
        F.regexp_extract("path", PART_PLACE, 2).cast("long").alias("subtask"),
        F.regexp_extract("path", PART_PLACE, 3).cast("long").alias("part"),
        name.alias("name"), "records",
    )
    keys = ["bucket", "subtask", "part", "name"]
    return files.withColumn("name", name).join(counted, keys).drop("name")


def last_files(files: DataFrame, n: int) -> DataFrame:
    """The last ``n`` files in path order."""
    return files.orderBy(F.col("path").desc()).limit(n)


def inventory_summary(files: DataFrame) -> DataFrame:
    """File count and total bytes of a listing."""
    return files.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )


def rows_per_file(table: DataFrame) -> DataFrame:
    """Line count of every file behind a scan."""
    return table.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("records")
    )
