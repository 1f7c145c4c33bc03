"""Session helpers: building a local session for tests and the bench, and
locating the shared folder that round-trip writes and checkpoints go to."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "tenor",
                  event_log_dir: str | None = None) -> SparkSession:
    """Local session with the settings used by tests and the bench.

    The UI stays off; AQE re-plans joins and coalesces shuffle partitions at run time.
    ``event_log_dir`` turns on Spark's event log there (stage and task times without a UI).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TENOR_DRIVER_MEMORY", "8g"))
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    The setting is read from the session. Only when it is unset (local tests, a
    bare driver session) a folder is created and registered as the checkpoint
    folder, so that later ``checkpoint()`` calls and round-trip writes agree on
    one place.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if conf_dir:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tenor-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared folder for one write."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Python workers get Arrow batches of at most so many rows in what is written inside; the setting is set back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, str(rows if before <= 0 else min(before, rows)))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))
