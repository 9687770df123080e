"""Facts of a growing table against scans of it."""

import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.functions.records import as_records
from millrace.operators.health import index_profile
from millrace.sources import facts as module
from millrace.sources.facts import TableFacts, committed_files, log_files
from millrace.sources.generator import bounded_records, replay_stream
from millrace.sources.tables import file_inventory, last_part_files, scan_table
from millrace.streaming.sink import write_parts, write_stream

START = datetime(2025, 10, 10, 17, 30, 0)


class Table:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.root, self.count = f"{folder}/table", 0

    def grow(self, n, text="a"):
        rows = bounded_records(self.spark, self.count + n, START, 10_000_000, 2)
        rows.filter(F.col("index") >= self.count).select("index", "ts").write.mode("append").parquet(
            f"{self.folder}/source"
        )
        self.count += n
        source = as_records(replay_stream(self.spark, f"{self.folder}/source"), F.col("index"), F.col("ts"))
        write_stream(source, self.root, f"{self.folder}/state", available_now=True, spread=True).awaitTermination()


@pytest.fixture()
def table(spark, tmp_path):
    return Table(spark, str(tmp_path))


def opened(df):
    return {Path(x).name for x in df.inputFiles()}


def agree(spark, facts, root):
    """Facts equal what a scan and a listing of the whole table give."""
    assert facts.profile().first() == index_profile(scan_table(spark, root)).first()
    listed = {(Path(r.path).name, r.length) for r in file_inventory(spark, root).collect()}
    found = facts.files().collect()
    assert {(Path(r.path).name, r.length) for r in found} == listed and len(found) == len(listed)
    assert sum(r.records for r in found) == scan_table(spark, root).count()
    hours = scan_table(spark, root).groupBy("bucket").count().collect()
    assert {(r.bucket, r.records) for r in facts.per_hour().collect()} == {tuple(r) for r in hours}


def monkeypatch_conf(request, spark, key, value):
    spark.conf.set(key, value)
    request.addfinalizer(lambda: spark.conf.unset(key))


def test_growing_table_past_a_compact_log(spark, table, request):
    monkeypatch_conf(request, spark, "spark.sql.streaming.fileSink.log.compactInterval", "3")
    facts = TableFacts(spark, table.root, f"{table.folder}/facts")
    assert facts.covered() == facts.update() == -1 and facts.files().count() == 0
    assert facts.profile().first()["records"] == 0
    for step in range(5):  # the log is compacted every three batches
        table.grow(40)
        if step in (0, 3, 4):
            before = {"/".join(r.path.split("/")[-2:]) for r in facts.files().collect()}
            assert facts.update() == step and facts.update() == step
            counted = spark.read.parquet(f"{table.folder}/facts/counted/{step}")
            assert not before & {r.place for r in counted.collect()}  # no file is opened twice
            agree(spark, facts, table.root)
    paths, newest = log_files(spark, table.root, 3)
    assert newest == 4 and [Path(p).name for p in paths] == ["4"]
    assert any(p.endswith(".compact") for p in log_files(spark, table.root, 1)[0])
    assert committed_files(spark, table.root).count() == facts.files().count()


def test_an_update_that_was_cut_off_is_made_again(spark, table, monkeypatch):
    facts = TableFacts(spark, table.root, f"{table.folder}/facts")
    table.grow(300)
    monkeypatch.setattr(module, "LOT", 1)
    facts.update()
    agree(spark, facts, table.root)
    table.grow(300)
    done = facts.update()
    Path(f"{table.folder}/facts/files/{done}/_SUCCESS").unlink()
    assert facts.covered() < done
    shutil.rmtree(f"{table.folder}/facts/counted/{done}")
    table.grow(10)
    assert facts.update() == done + 1
    agree(spark, facts, table.root)


def test_recent_opens_only_files_that_reach_into_the_span(spark, table):
    facts = TableFacts(spark, table.root, f"{table.folder}/facts")
    assert facts.recent(timedelta(hours=1)).count() == 0
    table.grow(2000)  # some five and a half hours
    facts.update()
    whole = scan_table(spark, table.root)
    newest = facts.files().agg(F.max("newest")).first()[0]
    for span in (timedelta(minutes=50), timedelta(hours=2), timedelta(days=3)):
        got = facts.recent(span)
        want = bounded_records(spark, 2000, START, 10_000_000).filter(F.col("ts") >= F.lit(newest - span))
        assert sorted(r.foams for r in got.collect()) == sorted(r.foams for r in want.collect())
        assert opened(got) <= opened(whole)
    few = opened(facts.recent(timedelta(minutes=50)))
    assert 0 < len(few) < len(opened(whole)) / 2
    late = facts.recent(timedelta(minutes=1), F.lit("2030-01-01 00:00:00").cast("timestamp"))
    assert late.count() == 0


def test_last_files_and_foreign_lines(spark, table):
    facts = TableFacts(spark, table.root, f"{table.folder}/facts")
    table.grow(900)
    facts.update()
    names = sorted(r.path for r in facts.files().collect())
    assert [r.path for r in facts.last_files(2).collect()] == names[::-1][:2]


def test_last_part_files_opens_only_these(spark, tmp_path):
    root = str(tmp_path / "parts")
    write_parts(bounded_records(spark, 2000, START, 1_000_000), root, parallelism=2)
    newest = last_part_files(spark, root, 3)
    rows = newest.collect()
    assert len(rows) == 3 and all(r.records > 0 for r in rows)
    every = file_inventory(spark, root, r"\.txt$").orderBy(F.desc("path")).collect()
    assert {r.path for r in rows} <= {r.path for r in every} and len(every) > 10
    assert len([x for x in newest.inputFiles()]) <= 3
    (tmp_path / "none").mkdir()
    assert last_part_files(spark, str(tmp_path / "none"), 3).collect() == []
