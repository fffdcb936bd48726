"""Session construction and the shared folder that checkpoints live in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_run_dirs: list[str] = []

ENGINE_CONF = {
    # Adaptive execution sizes the reducers, splits skewed join partitions and turns a
    # join into a broadcast only when the measured side is below the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where what follows must then shuffle once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming state spills to disk instead of living on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session that names none gets a temporary one; on a cluster each machine
    would write to its own disk, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tradewind-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder for one run's checkpoint or output.

    It stays until :func:`clear_run_dirs`, as results may be read from it at any time.
    """
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    _run_dirs.append(path)
    return path


def clear_run_dirs(spark: SparkSession) -> None:
    """Remove the folders of this session's runs, once their results are no longer read."""
    while _run_dirs:
        path = spark._jvm.org.apache.hadoop.fs.Path(_run_dirs.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
