"""Session settings and the shared folder that survives the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the operators are written for. They can be set on a live
# session, so a cluster session started elsewhere gets them through ``tune``.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the split costs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Parquet sizes are of compressed data; what a broadcast holds is larger.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.session.timeZone": "UTC",
}

# Folders made because no shared folder was configured (local sessions only);
# they are removed when the interpreter exits.
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def tune(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session.

    ``shuffle_partitions`` is the number a shuffle starts with, which adaptive
    execution then reduces to the data at hand: choose it for the largest shuffle,
    about one per 128 MB.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffle_partitions)
    return spark


def local_session(cores: int | str = "*", name: str = "objsync", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting: a machine-local folder on
    a cluster would be invisible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach")
    if "default" not in _local_folders:
        _local_folders["default"] = tempfile.TemporaryDirectory(prefix="objsync-")
    return _local_folders["default"].name


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared folder, for results to keep; nothing is created yet."""
    return f"{shared_folder(spark)}/objsync/{purpose}-{uuid.uuid4().hex}"


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name for working data, which is deleted when the application ends."""
    top, files = _hadoop_path(spark, new_folder(spark, purpose))
    files.mkdirs(top)
    files.deleteOnExit(top)
    return f"{top.toString()}/data"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder before the application ends."""
    data, files = _hadoop_path(spark, folder)
    files.delete(data.getParent(), True)


def _hadoop_path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())
