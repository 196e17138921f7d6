"""Session helpers.

``get_session`` is for tests, the bench and local runs only; on a cluster
the caller owns the session.  ``shared_dir`` resolves the folder used to cut
lineage and to hold tables the jobs write: the cluster names it in
``spark.checkpoint.dir``; a local session without one gets a fresh folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "medstar") -> SparkSession:
    master = master or os.environ.get("MEDSTAR_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the document parse is CPU-bound: keep small inputs spread over cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", os.environ.get("MEDSTAR_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets its own folder (tests,
    bench); a cluster session without it is a configuration error, because a
    machine-local folder is not visible to the other executors.
    """
    path = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if path:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)       # for DataFrame.checkpoint()
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            f"{_CHECKPOINT_KEY} is not set; jobs need a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="medstar-")
    spark.conf.set(_CHECKPOINT_KEY, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder, for what lives as
    long as the application: its folder is deleted when the driver exits."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        root = f"{shared_dir(spark)}/scratch-{app}-{uuid.uuid4().hex[:8]}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _scratch[app] = root
    return f"{_scratch[app]}/{name}-{uuid.uuid4().hex[:12]}"
