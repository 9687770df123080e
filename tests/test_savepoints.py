"""Going back to a named position of a job."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.records import as_records, record_text
from millrace.sources.generator import bounded_records, replay_stream
from millrace.sources.tables import scan_table
from millrace.streaming.jobs import StreamJob
from millrace.streaming.savepoints import Savepoints
from millrace.streaming.sink import text_writer
from test_streaming import START, live, profile


def test_any_savepoint_replays_exactly_the_later_rows(spark, tmp_path):
    root, state, source = (str(tmp_path / x) for x in ("table", "state", "source"))
    saved = Savepoints(spark, str(tmp_path / "saved"), state, root)

    def grow(first, end):
        rows = bounded_records(spark, end, START).filter(F.col("index") >= first)
        rows.select("index", "ts").write.mode("append").parquet(source)

    def run(mark):
        def render(index, ts):
            return F.concat(record_text(index, ts), F.lit(mark))

        records = as_records(replay_stream(spark, source), F.col("index"), F.col("ts"), render)
        StreamJob(lambda: text_writer(records, root, state, available_now=True, max_line_bytes=90)).start().wait_for_end()

    def marks():
        lines = [r.foams for r in scan_table(spark, root).collect()]
        return {int(x.split(":")[0][7:]): x[-1] for x in lines} if len({*lines}) == len(lines) else None

    assert saved.names() == []
    saved.save("start")  # before the first run there is nothing to copy
    for n, mark in enumerate("abc"):
        grow(10 * n, 10 * n + 10)
        run(mark)
        saved.save(f"after {mark}")
    want = {i: "abc"[i // 10] for i in range(30)}
    assert marks() == want and saved.names() == ["after a", "after b", "after c", "start"]
    for name, kept, mark in (("after a", 10, "x"), ("after c", 30, "y"), ("after b", 20, "z"), ("start", 0, "w")):
        saved.restore(name)
        if kept:
            assert marks() == {i: m for i, m in want.items() if i < kept}
        run(mark)
        assert marks() == {i: want[i] if i < kept else mark for i in range(30)}
    with pytest.raises(ValueError, match="already"):
        saved.save("after a")
    with pytest.raises(ValueError, match="no savepoint"):
        saved.restore("none")


def test_a_running_job_is_refused(spark, tmp_path):
    place = (str(tmp_path / "table"), str(tmp_path / "state"))
    saved = Savepoints(spark, str(tmp_path / "saved"), place[1], place[0])
    job = StreamJob(live(spark, place)).start()
    try:
        job.wait_for("RUNNING", polls=300, interval_s=0.2)
        for act in (saved.save, saved.restore):
            if act == saved.restore:
                saved.names = lambda: ["now"]
            with pytest.raises(RuntimeError, match="stop the job"):
                act("now", job)
    finally:
        job.stop(force=True)
    assert profile(spark, place[0])[0] > 0
