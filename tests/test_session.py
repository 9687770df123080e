import subprocess
import sys
from datetime import timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest

from millrace import RollPolicy, scratch_path, ship_package
from millrace.operators.policy import OFF
from millrace.session import SETTINGS, checkpoint_root

ROOT = Path(__file__).resolve().parents[1]


def test_queries_leave_the_settings_of_the_session(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        ship_package(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, named=None, folder=None):
    conf = SimpleNamespace(get=lambda key, default: named or default)
    return SimpleNamespace(conf=conf, sparkContext=FakeContext(master, folder))


def test_the_named_folder_comes_first():
    session = fake("yarn", "/shared/", "/shared/1234")
    assert checkpoint_root(session) == "/shared"
    assert session.sparkContext.folder == "/shared/1234"
    session = fake("yarn", "/shared")
    assert checkpoint_root(session) == "/shared" == session.sparkContext.folder
    assert checkpoint_root(fake("yarn", None, "/set")) == "/set"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(fake("yarn"))
    session = fake("local[2]")
    assert checkpoint_root(session) == session.sparkContext.folder


def test_scratch_goes_with_the_application(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from millrace import build_session, scratch_path
spark = build_session("scratch", "local[1]", {{"spark.checkpoint.dir": {str(tmp_path)!r}, "spark.ui.enabled": "false"}})
paths = [scratch_path(spark, "x") for _ in range(2)]
for path in paths:
    spark.range(3).write.parquet(path)
print(len(set(paths)), [p.startswith({str(tmp_path)!r} + "/scratch-") for p in paths], spark.read.parquet(*paths).count())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.stdout.split("\n")[-2] == "2 [True, True] 6", done.stderr[-2000:]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("scratch-")]


def test_workers_can_import_the_package(spark):
    def name(_):
        import millrace.operators.rolling as module

        yield module.__name__

    assert set(spark.sparkContext.parallelize(range(2), 2).mapPartitions(name).collect()) == {
        "millrace.operators.rolling"
    }


def test_policy():
    policy = RollPolicy()
    assert (policy.age_us, policy.idle_us, policy.size) == (120_000_000, 30_000_000, 1_048_576)
    assert policy.max_records() == 12_787
    off = RollPolicy(None, None, None)
    assert (off.age_us, off.idle_us, off.size, off.max_records()) == (OFF, OFF, OFF, 0)
    assert RollPolicy(max_bytes=1).max_records() == 1
    for bad in ({"max_age_s": 0}, {"max_idle_s": -1}, {"max_bytes": 0}):
        with pytest.raises(ValueError):
            RollPolicy(**bad)
    assert timedelta(microseconds=policy.age_us) == timedelta(minutes=2)
