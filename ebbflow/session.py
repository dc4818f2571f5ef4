"""Session construction and the shared work folder.

On a cluster the operator names a shared folder in ``spark.checkpoint.dir``;
everything this library persists between jobs (lineage cuts, versioned
tables, stream checkpoints) lives below it.  Only when nothing is
configured (local runs, tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster run (set by the operator on the session):
# AQE sizes shuffle partitions from the data, splits skewed join
# partitions and picks broadcast joins from runtime sizes; the initial
# partition count only has to be high enough for the largest shuffle.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(master: str = "local[8]", app: str = "ebbflow", **conf) -> SparkSession:
    """A local session with settings that suit small test data."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**_LOCAL_DEFAULTS, "spark.driver.memory": "8g", **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for persisted intermediate state.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset (a
    local or test session) a fresh folder under the system temp dir is
    chosen once and written back, so the SparkContext checkpoint dir and
    our tables agree.
    """
    global _LOCAL_WORK
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _LOCAL_WORK is None:
            _LOCAL_WORK = tempfile.mkdtemp(prefix="ebbflow-")
        d = _LOCAL_WORK
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_LOCAL_WORK: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared work folder."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, on whichever file system it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_dir(path: str) -> None:
    if is_local_path(path):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
