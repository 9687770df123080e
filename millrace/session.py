"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Adaptive execution splits hot buckets and merges small ones. Texts and buckets are in UTC
# whatever the zone of the session is; this one only sets how timestamps are shown.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
}

# Can only be set when a session is built: drop checkpoint files with their table.
BUILD_SETTINGS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(
    app: str = "millrace", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Build a session with the settings above; ``conf`` adds to them or overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = conf or {}
    for key, value in {**SETTINGS, **BUILD_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in {**SETTINGS, **conf}.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return ship_package(spark)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent
        base = Path(tempfile.mkdtemp(prefix="millrace-package-")) / package.name
        archive = shutil.make_archive(str(base), "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where nothing is set, as in a
    local test, a temporary folder of this machine is used.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="millrace-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's own folder under the shared one. The folder goes with
    everything in it when the driver ends."""
    application = spark.sparkContext.applicationId
    root = checkpoint_root(spark)
    if _scratch.get(application) is None or not _scratch[application].startswith(f"{root}/"):
        _scratch[application] = f"{root}/scratch-{application}"
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch[application])
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{_scratch[application]}/{label}-{uuid.uuid4().hex}"
