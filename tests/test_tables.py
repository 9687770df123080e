from datetime import datetime
from pathlib import Path

import pytest

from millrace.sources import tables
from millrace.sources.generator import bounded_records
from millrace.streaming.sink import export_csv

START = datetime(2025, 10, 10, 17, 59, 0)
# Fixed values below: directory and part names of the documented layout.


@pytest.fixture()
def foreign(tmp_path):
    """Plain hour directories with finished and unfinished parts."""
    root = tmp_path / "table"
    for hour, part, lines in [
        ("2025-10-10--17", "part-0-0", 3),
        ("2025-10-10--17", "part-0-1", 2),
        ("2025-10-10--17", ".part-0-3.inprogress.xyz", 50),
        ("2025-10-10--18", "part-0-2", 4),
    ]:
        (root / hour).mkdir(parents=True, exist_ok=True)
        text = "".join(
            f"Record-{i}: Data from foams column at 2025-10-10T17:15:23.456Z\n" for i in range(lines)
        )
        (root / hour / part).write_text(text)
    return str(root)


@pytest.fixture(scope="module")
def own(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("own") / "table")
    records = bounded_records(spark, 400, START, partitions=2)
    records.select("foams", "bucket").write.partitionBy("bucket").text(root)
    return root


def test_foreign_layout(spark, foreign):
    counts = tables.scan_foreign(spark, foreign).groupBy("bucket").count().orderBy("bucket")
    assert [tuple(r) for r in counts.collect()] == [("2025-10-10--17", 5), ("2025-10-10--18", 4)]


def test_one_foreign_file(spark, foreign):
    assert tables.scan_file(spark, f"{foreign}/2025-10-10--17/part-0-1").count() == 2


def test_rows_per_file(spark, foreign):
    files = tables.rows_per_file(tables.scan_foreign(spark, foreign))
    got = {Path(r.path).name: r.records for r in files.collect()}
    assert got == {"part-0-0": 3, "part-0-1": 2, "part-0-2": 4}


def test_inventory_skips_hidden_files(spark, foreign):
    files = tables.file_inventory(spark, foreign)
    assert files.columns == ["path", "modificationTime", "length"]
    assert tables.inventory_summary(files).first().asDict() == {"files": 3, "bytes": 9 * 61}
    names = [Path(r.path).name for r in tables.last_files(files, 2).collect()]
    assert names == ["part-0-2", "part-0-1"]
    assert tables.file_inventory(spark, foreign, r"--17/part-\d+-0$").count() == 1
    per_hour = files.groupBy(tables.inventory_bucket().alias("b")).count().collect()
    assert {tuple(r) for r in per_hour} == {("2025-10-10--17", 2), ("2025-10-10--18", 1)}


def test_inventory_does_not_read_contents(spark, foreign):
    plan = tables.file_inventory(spark, foreign)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


def test_empty_location(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    table = tables.register_table(spark, "empty_records", str(tmp_path / "empty"))
    assert table.columns == ["foams"]
    assert table.count() == 0
    assert tables.scan_foreign(spark, str(tmp_path / "empty")).count() == 0


def test_registered_table(spark, own, foreign):
    tables.register_table(spark, "own_records", own)
    assert spark.sql("SELECT COUNT(*) FROM own_records").first()[0] == 400
    assert len(spark.sql("SELECT * FROM own_records LIMIT 10").collect()) == 10
    assert tables.register_table(spark, "own_records", own).count() == 400
    with pytest.raises(ValueError, match="another table"):
        tables.register_table(spark, "own_records", foreign)
    assert spark.table("own_records").count() == 400


def test_a_managed_table_is_not_replaced(spark, own):
    spark.range(3).write.saveAsTable("managed_rows", mode="overwrite")
    with pytest.raises(ValueError, match="MANAGED"):
        tables.register_table(spark, "managed_rows", own)
    assert spark.table("managed_rows").count() == 3


def test_a_foreign_layout_is_refused_not_empty(spark, foreign):
    for scan in (tables.scan_table, lambda s, r: tables.scan_bucket(s, r, "2025-10-10--17")):
        with pytest.raises(ValueError, match="use scan_foreign"):
            scan(spark, foreign)
    assert tables.scan_foreign_bucket(spark, foreign, "2025-10-10--17").count() == 5


def test_bucket_filter_prunes_directories(spark, own):
    one = tables.scan_bucket(spark, own, "2025-10-10--18")
    assert one.count() == 280
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_csv_round_trip(spark, tmp_path):
    records = bounded_records(spark, 50, START).select("foams")
    path = str(tmp_path / "csv")
    export_csv(records, path)
    back = tables.scan_csv(spark, path)
    assert back.columns == ["foams"]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, records.collect()))


def test_csv_keeps_awkward_text(spark, tmp_path):
    texts = [" lead", "t ", "", None, "x\ny", "a,b", 'say "hi"', "\\", "\\N", "tab\t", '"', "é, ü",
             "\x01", "\x01\x01", "a\x01", "\x01 b"]
    rows = spark.createDataFrame([(t,) for t in texts], "foams string").coalesce(1)
    path = str(tmp_path / "csv")
    export_csv(rows, path)
    back = [r[0] for r in tables.scan_csv(spark, path).collect()]
    assert sorted(back, key=str) == sorted(texts, key=str)


def test_csv_with_too_many_fields_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        tables.scan_csv(spark, str(tmp_path / "bad.csv")).collect()
