"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", cpus: int | str | None = "*",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with UTC time, AQE (coalescing + skew join) and the UI off.

    ``cpus``: run locally on so many cores; None leaves the master (and the
    driver's memory) to spark-submit or spark-defaults. ``shuffle_partitions``
    defaults to the core count for local runs; on a cluster leave it to the
    cluster config and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app)
    if cpus is not None:
        builder = builder.master(f"local[{cpus}]").config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(executors: int = 1000, cores_per_executor: int = 8) -> dict[str, str]:
    """Settings for a large cluster run (pass as ``extra`` or in spark-defaults).

    The initial shuffle partition count is sized for the biggest shuffle (a few
    ×100 MB per task over the whole cluster) and AQE coalesces the small ones and
    splits skewed partitions at runtime; file splits are 256 MB.
    """
    slots = executors * cores_per_executor
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.shuffle.partitions": str(slots * 3),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


_SCRATCH: list[str] = []


def is_local(master: str) -> bool:
    """Driver and executors are one process (``local-cluster`` has executors of its own)."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the shared (HDFS/object store) location the cluster
    configures; without it a session that is not local is refused, as each
    executor would write to its own disk. A local session gets a temporary
    folder that is removed when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    try:  # classic sessions: let DataFrame.checkpoint() use the same folder
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    except Exception:  # noqa: BLE001 - no SparkContext behind a remote session
        pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one job's output."""
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove what this driver wrote through ``scratch_path``, once no plan reads it any more; how many paths went."""
    jvm, removed = spark._jvm, 0
    conf = spark._jsc.hadoopConfiguration()
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def materialize(df):
    """Compute ``df`` once into the shared checkpoint folder (reliable
    ``checkpoint()``, never ``localCheckpoint``) and continue from the written
    copy: later actions reuse it and a lost executor does not recompute the
    lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
