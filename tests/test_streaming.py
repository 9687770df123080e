import time
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from millrace.functions.records import as_records, parse_records, record_text
from millrace.operators.health import index_profile
from millrace.operators.policy import RollPolicy
from millrace.sources.generator import bounded_records, replay_stream, stream_records
from millrace.sources.tables import file_inventory, inventory_summary, register_table, scan_table
from millrace.streaming import jobs
from millrace.streaming.jobs import ProgressLog, StreamJob
from millrace.streaming.sink import text_writer, write_stream

START = datetime(2025, 10, 10, 17, 30, 0)


@pytest.fixture()
def place(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "state")


def once(records, place, **options):
    write_stream(records, *place, available_now=True, **options).awaitTermination()


def profile(spark, root):
    row = index_profile(scan_table(spark, root)).first()
    return row["records"], row["distinct"], row["first"], row["last"]


def until(condition, seconds=60):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end, "too slow"
        time.sleep(0.1)


def test_rate_and_instants(spark, place):
    once(stream_records(spark, rate=2, trigger_s=60, partitions=3), place)
    now = datetime.now(timezone.utc).timestamp()
    rows = parse_records(scan_table(spark, place[0])).select("index", F.unix_micros("ts").alias("us"))
    rows = rows.orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(120))
    assert {b.us - a.us for a, b in zip(rows, rows[1:])} == {500_000}
    assert now - 150 < rows[0].us / 1e6 < rows[-1].us / 1e6 < now


@pytest.mark.parametrize("rate, trigger_s, catch_up", [(0.4, 1, False), (2.5, 1, False), (0.4, 1, True)])
def test_a_rate_that_cannot_be_kept_is_refused(spark, rate, trigger_s, catch_up):
    with pytest.raises(ValueError, match="no whole number"):
        stream_records(spark, rate=rate, trigger_s=trigger_s, catch_up=catch_up)


@pytest.mark.parametrize("policy, trigger_s", [
    (RollPolicy(max_age_s=2, max_idle_s=None), None), (RollPolicy(max_age_s=None, max_idle_s=2), None),
    (RollPolicy(), 5),
])
def test_a_writer_keeps_the_trigger_of_the_records(spark, place, policy, trigger_s):
    with pytest.raises(ValueError, match="trigger of 10"):
        text_writer(stream_records(spark, rate=2, trigger_s=10), *place, policy=policy, trigger_s=trigger_s)


def test_live_rate_order_and_clock(spark, place):
    policy = RollPolicy(max_age_s=60, max_idle_s=1)
    begun = time.time()
    query = write_stream(stream_records(spark, rate=10, trigger_s=1), *place, policy=policy)
    until(lambda: len(query.recentProgress) >= 5)
    query.stop()
    seconds = time.time() - begun
    rows = parse_records(scan_table(spark, place[0])).select("index", F.unix_micros("ts").alias("us"))
    rows = rows.orderBy("index").collect()
    assert 40 <= len(rows) <= 10 * (seconds + 2)
    assert all(a.us < b.us for a, b in zip(rows, rows[1:]))
    assert rows[-1].us / 1e6 < time.time()


def test_a_line_that_breaks_the_size_limit_fails(spark, place):
    records = stream_records(spark, rate=5, trigger_s=1, render=lambda i, t: F.repeat(F.lit("x"), 82))
    with pytest.raises(StreamingQueryException, match="longer than 82 bytes"):
        once(records, place)


def test_no_catch_up_after_a_pause(spark, place):
    for _ in range(2):
        once(stream_records(spark, rate=5, trigger_s=1), place)
        time.sleep(2)
    assert profile(spark, place[0]) == (10, 10, 0, 9)


def test_catch_up_uses_the_other_source(spark):
    stream = stream_records(spark, rate=5, catch_up=True).frame
    assert stream.isStreaming and stream.columns == ["index", "ts", "foams", "bucket"]


def test_layout_size_limit_and_counts(spark, place):
    once(stream_records(spark, rate=120, trigger_s=1), place, policy=RollPolicy(max_bytes=50 * 82))
    files = sorted(Path(place[0]).glob("bucket=*/part-*"))
    assert 3 <= len(files) <= 4
    assert all(f.stat().st_size <= 50 * 82 for f in files)
    found = inventory_summary(file_inventory(spark, place[0])).first()
    assert found["files"] == len(files) and found["bytes"] == sum(f.stat().st_size for f in files)


def test_uncommitted_files_are_not_read(spark, place):
    once(stream_records(spark, rate=40, trigger_s=1), place)
    bucket = next(Path(place[0]).glob("bucket=*"))
    (bucket / "part-stray.txt").write_text("stray\n")
    (bucket / ".part-0-1.inprogress.x").write_text("hidden\n")
    assert scan_table(spark, place[0]).count() == 40
    assert register_table(spark, "stray_records", place[0]).count() == 40


def test_only_text_columns_reach_the_sink(spark, place):
    writer = text_writer(stream_records(spark), *place)
    assert writer is not None
    once(stream_records(spark, rate=3, trigger_s=1), place, name="plain")
    assert scan_table(spark, place[0]).columns == ["foams", "bucket"]


@pytest.mark.parametrize("files", [1, 5])
def test_replay_of_a_file_and_of_a_folder(spark, place, tmp_path, files):
    path = str(tmp_path / "src.parquet")
    bounded_records(spark, 500, START, 10_000_000, files).select("index", "ts").write.parquet(path)
    if files == 1:
        path = str(next(Path(path).glob("part-*.parquet")))
    source = replay_stream(spark, path, max_files=2)
    once(as_records(source, F.col("index"), F.col("ts")), place, spread=True)
    want = bounded_records(spark, 500, START, 10_000_000).select("foams", "bucket")
    got = scan_table(spark, place[0])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # The second run has nothing new to read.
    once(as_records(source, F.col("index"), F.col("ts")), place, spread=True)
    assert profile(spark, place[0]) == (500, 500, 0, 499)


def test_a_hot_hour_is_split_over_tasks(spark, place, tmp_path):
    path = str(tmp_path / "src.parquet")
    bounded_records(spark, 200_000, START, 1000, 8).select("index", "ts").write.parquet(path)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        source = as_records(replay_stream(spark, path), F.col("index"), F.col("ts"))
        once(source, place, spread=True, policy=RollPolicy(max_bytes=None))
    finally:
        spark.conf.set(key, before)
    assert len(list(Path(place[0]).glob("bucket=2025-10-10--17/part-*"))) > 2
    assert profile(spark, place[0]) == (200_000, 200_000, 0, 199_999)


def live(spark, place, rate=200, render=record_text):
    def build():
        records = stream_records(spark, rate=rate, trigger_s=0.5, partitions=2, render=render)
        return text_writer(records, *place, name="live")

    return build


def test_stop_and_restart_write_every_index_once(spark, place):
    job = StreamJob(live(spark, place))
    assert job.status() == jobs.READY
    for force in (True, False, True):
        job.start()
        with pytest.raises(RuntimeError, match="already running"):
            job.start()
        job.wait_for(jobs.RUNNING, polls=300, interval_s=0.2)
        job.stop(force=force, polls=100, interval_s=0.05)
        assert job.status() == jobs.READY
    records, distinct, first, last = profile(spark, place[0])
    assert records == distinct == last + 1 and first == 0 and records >= 300
    assert job.progress(spark).filter("numInputRows > 0").count() >= 1


def test_redeploy_with_new_text_and_rate(spark, place):
    job = StreamJob(live(spark, place)).start()
    job.wait_for(jobs.RUNNING, polls=300, interval_s=0.2)
    marked = live(spark, place, 60, lambda i, t: F.concat(record_text(i, t), F.lit("!")))
    job.redeploy(marked, force=True)
    job.wait_for(jobs.RUNNING, polls=300, interval_s=0.2)
    job.stop(force=True)
    table = scan_table(spark, place[0])
    index = F.regexp_extract("foams", r"^Record-(\d+):", 1).cast("long")
    row = table.agg(
        F.count("*"), F.count_distinct(index), F.min(index), F.max(index),
        F.count_if(F.col("foams").endswith("!")),
    ).first()
    assert row[0] == row[1] == row[3] + 1 and row[2] == 0 and 0 < row[4] < row[0]


def test_failure_is_reported_and_the_job_can_go_on(spark, place):
    def broken(index, ts):
        error = F.raise_error(F.lit("sink is gone"))
        return F.when(index >= 150, error).otherwise(record_text(index, ts))

    job = StreamJob(live(spark, place, render=broken)).start()
    with pytest.raises(StreamingQueryException):
        job.query.awaitTermination(60)
    assert job.status() == jobs.FAILED and "sink is gone" in job.failure()
    with pytest.raises(RuntimeError, match="sink is gone"):
        job.wait_for(jobs.RUNNING, polls=2, interval_s=0.01)
    job.redeploy(live(spark, place))
    job.wait_for(jobs.RUNNING, polls=300, interval_s=0.2)
    job.stop(force=True)
    records, distinct, first, last = profile(spark, place[0])
    assert records == distinct == last + 1 and first == 0 and records >= 200


def test_wait_times_out(spark, place):
    with pytest.raises(TimeoutError, match="READY, not RUNNING"):
        StreamJob(live(spark, place)).wait_for(jobs.RUNNING, polls=3, interval_s=0.01)


def test_trigger_is_bounded_by_the_limits(spark, place, tmp_path):
    path = str(tmp_path / "src.parquet")
    bounded_records(spark, 3, START).select("index", "ts").write.parquet(path)
    source = as_records(replay_stream(spark, path), F.col("index"), F.col("ts"))
    for limits in ({"max_age_s": 1}, {"max_age_s": None, "max_idle_s": 1}):
        writer = text_writer(source, place[0], place[1] + str(limits["max_age_s"]),
                             policy=RollPolicy(**limits))
        query = writer.start()
        assert query._jsq.toString() is not None
        until(lambda: query.lastProgress is not None)
        query.stop()


def test_bounded_restarts(spark, place):
    left = [True, True]

    def render(index, ts):
        if left and left.pop():
            return F.when(index >= 100, F.raise_error(F.lit("lost"))).otherwise(record_text(index, ts))
        return record_text(index, ts)

    job = StreamJob(live(spark, place, render=render), restarts=2).start()
    with pytest.raises(StreamingQueryException):
        job.query.awaitTermination(60)
    assert job.status() == jobs.RESTARTING
    job.restart()
    with pytest.raises(StreamingQueryException):
        job.query.awaitTermination(60)
    job.wait_for(jobs.RUNNING, polls=300, interval_s=0.2)
    job.stop(force=True)
    assert job.restarts_left == 0
    records, distinct, first, last = profile(spark, place[0])
    assert records == distinct == last + 1 and first == 0 and records >= 100


def test_progress_log_keeps_everything(spark, place, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "log"), batch=1)
    assert log.table().count() == 0
    spark.streams.addListener(log)
    try:
        for _ in range(3):
            once(stream_records(spark, rate=25, trigger_s=1), place, name="logged")
        until(lambda: log.endings().count() >= 3)
    finally:
        spark.streams.removeListener(log)
    rows = log.table().filter("name = 'logged' and numInputRows > 0").collect()
    assert [r["numInputRows"] for r in rows] == [25] * 3 and all(r["durationMs"] > 0 for r in rows)


def test_a_log_that_was_not_flushed_loses_nothing(spark, place, tmp_path):
    """The driver ends right after the last batch: another log over the folder has it all."""
    folder = str(tmp_path / "log")
    log = ProgressLog(spark, folder, batch=1000)
    spark.streams.addListener(log)
    try:
        once(stream_records(spark, rate=25, trigger_s=1), place, name="logged")
        until(lambda: log.endings().count() >= 1)
    finally:
        spark.streams.removeListener(log)
    again = ProgressLog(spark, folder)
    assert again.table().agg(F.sum("numInputRows")).first()[0] == 25
    assert again.endings().filter("error IS NULL").count() == 1
    # A merge that was cut off before it removed the small files counts each report once.
    before = again.reports().count()
    again._read_pending().write.mode("append").parquet(f"{folder}/merged")
    assert ProgressLog(spark, folder).reports().count() == before
    again = ProgressLog(spark, folder)
    again.flush()
    again._append(name="more", numInputRows=1, inputRowsPerSecond=float("nan"))
    assert again.reports().count() == before + 1 == again.reports().agg(F.max("seq")).first()[0] + 1
