"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE sizes the reducers, splits skewed join partitions and switches to a
    # broadcast join only when the measured side is below the size threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "silverlode", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the engine expects; ``extra`` overrides by config key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder.  A cluster
    session without it is an error: a machine-local folder would not be shared.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="silverlode-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, empty path below the shared folder, dropped when the driver JVM ends."""
    path = f"{shared_root(spark)}/silverlode/{label}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
