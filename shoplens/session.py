"""Session settings and the shared scratch folder.

The settings are the ones the operators rely on or benefit from at scale:
adaptive execution with partition coalescing and skew-join splitting, and a
fixed session time zone. Nothing here is needed for correctness except that
the operators never depend on the session zone for NTZ input (see
``functions.columns.epoch_seconds``).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    # tables that load at the same time share the executors
    "spark.scheduler.mode": "FAIR",
    # checkpoint files go when their frame is garbage
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "shoplens", extra: dict | None = None) -> SparkSession:
    """A session with ``SESSION_CONF``; ``shuffle_partitions`` sized to the cluster."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


class NoSharedFolder(RuntimeError):
    """A cluster session without ``spark.checkpoint.dir``."""


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Lineage cuts (``checkpoint()``) and scratch tables go there, never to a
    machine-local temp folder. Only a single-machine session (``local[...]``)
    that names none gets a local folder in its place; on any other master a
    missing setting raises ``NoSharedFolder``.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session: the server owns the setting
        if not d:
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share") from None
        return d
    current = sc.getCheckpointDir()
    if d:
        if not current:
            sc.setCheckpointDir(d)
        return d
    if current:
        return current
    if not _is_local(sc.master):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="shoplens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


def _scratch_root(spark: SparkSession) -> str:
    """This application's scratch folder under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/shoplens-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the application's scratch folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables; call it when no result needs them any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
