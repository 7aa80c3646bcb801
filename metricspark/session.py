"""Session settings and the shared folder that jobs write intermediate data to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "metricspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on.

    Times are read and split in UTC, and adaptive execution sizes the shuffle
    partitions and splits skewed ones. Cluster sizing (executors, memory) is left
    to the deployment.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it then uses its warehouse folder.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/metricspark-work"
    spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created."""
    return f"{shared_root(spark)}/metricspark/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes folders that ``work_path`` named and nothing reads any more."""
    for path in paths:
        if not path.startswith(f"{shared_root(spark)}/metricspark/"):
            raise ValueError(f"not a work folder: {path}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        root = shared_root(spark)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
