"""Files of parts in a local folder."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators.parts import assign_parts
from millrace.operators.policy import RollPolicy
from millrace.sources import tables
from millrace.sources.generator import bounded_records
from millrace.streaming.sink import PLACE, part_folder, write_parts

START = datetime(2025, 10, 10, 17, 59, 0)
POLICY = RollPolicy(max_age_s=30, max_idle_s=None, max_bytes=200)


def contents(root: Path) -> dict[str, bytes]:
    return {str(f.parent.relative_to(root)): f.read_bytes() for f in root.rglob("part-*.txt")}


def test_a_part_takes_one_file_and_no_other(spark, tmp_path):
    root = tmp_path / "table"
    write_parts(bounded_records(spark, 400, START, partitions=3), str(root), POLICY, 2)
    found = [f for f in root.rglob("*") if f.is_file() and f.parent != root]
    assert len(found) == len({f.parent for f in found}) == tables.part_files(spark, str(root)).count()
    assert [f.name for f in tmp_path.iterdir()] == ["table"]
    assert (root / "_SUCCESS").exists()


def test_files_are_those_of_sparks_writer(spark, tmp_path):
    records = bounded_records(spark, 400, START, partitions=3)
    odd = F.when(F.col("index") % 7 == 0, "").when(F.col("index") % 5 == 0, "é ü\t").otherwise(F.col("foams"))
    records = records.withColumn("foams", odd).withColumn("bucket", F.concat("bucket", F.lit(" a:b/c=%é")))
    write_parts(records, str(tmp_path / "mine"), POLICY, 2)
    assigned = assign_parts(records, POLICY, 2, keep=["foams"])
    (
        assigned.repartition(*PLACE).sortWithinPartitions(*PLACE, "ts", "index")
        .select("foams", *PLACE).write.partitionBy(*PLACE).text(str(tmp_path / "sparks"))
    )
    mine = contents(tmp_path / "mine")
    assert len(mine) > 50 and mine == contents(tmp_path / "sparks")


def test_copies_and_a_part_over_many_batches(spark, tmp_path):
    rows = bounded_records(spark, 30, START).crossJoin(spark.range(1000)).drop("id")
    write_parts(rows, str(tmp_path / "table"), RollPolicy(None, None, None))
    files = contents(tmp_path / "table")
    assert sum(x.count(b"\n") for x in files.values()) == 30_000
    assert len(files) == rows.select("bucket").distinct().count()


def test_no_records(spark, tmp_path):
    write_parts(bounded_records(spark, 5, START).limit(0), str(tmp_path / "table"), POLICY)
    assert tables.part_files(spark, str(tmp_path / "table")).count() == 0


def test_a_folder_that_is_there_is_refused(spark, tmp_path):
    (tmp_path / "table").mkdir()
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_parts(bounded_records(spark, 5, START), str(tmp_path / "table"), POLICY)


def test_a_job_that_fails_leaves_nothing(spark, tmp_path):
    records = bounded_records(spark, 400, START)
    bad = F.when(F.col("index") == 300, F.raise_error(F.lit("planned"))).otherwise(F.col("foams"))
    with pytest.raises(Exception, match="planned"):
        write_parts(records.withColumn("foams", bad), str(tmp_path / "table"), POLICY)
    assert not list(tmp_path.iterdir())


def test_names_that_need_spelling():
    assert part_folder(("a/b:c", 1, 2)) == "bucket=a%2Fb%3Ac/subtask=1/part=2"
    assert part_folder((None, 0, 0)) == part_folder(("", 0, 0)) == "bucket=__HIVE_DEFAULT_PARTITION__/subtask=0/part=0"


def test_many_small_pieces_are_read_in_fewer_tasks(spark):
    least = 4 * spark.sparkContext.defaultParallelism
    for pieces in (16 * least, least // 2):
        rows = spark.range(0, 1000, 1, pieces)
        packed = tables.in_longer_tasks(rows)
        assert packed.rdd.getNumPartitions() == min(pieces, 2 * least)
        assert packed.agg(F.sum("id")).first()[0] == 499_500
