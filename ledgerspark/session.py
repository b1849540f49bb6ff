"""Session defaults and the shared folder for written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: str | int = "*", app: str = "ledgerspark", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the cluster's own.

    Only the partition count is specific to local mode. Adaptive execution, its
    skew-join splitting and its rebalancing of written partitions are Spark's
    defaults and are what the plans here rely on for hot keys.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a temporary folder, which is deleted when
    the program ends; on a cluster a machine-local folder would be lost with its executor, so there the
    setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app_id = spark.sparkContext.applicationId
    if app_id not in _LOCAL_DIRS:
        _LOCAL_DIRS[app_id] = tempfile.mkdtemp(prefix="ledgerspark-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[app_id], ignore_errors=True)
    return _LOCAL_DIRS[app_id]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has written."""
    return f"{shared_dir(spark)}/ledgerspark/{name}-{uuid.uuid4().hex}"
