"""Spark session helpers.

The library never assumes a machine-local scratch folder on a cluster: the
checkpoint folder is read from ``spark.checkpoint.dir``; a local default is
set only when the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quotelens") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")  # local runs only; ignored once a JVM is running
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stage tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one (or the context's
    checkpoint folder when one was set). Only when neither exists (local runs,
    tests) a fresh local folder is created and registered with the context;
    core settings cannot be changed on a running session, so it is remembered
    here instead.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: executors of a cluster need a shared folder for stage tables")
        key = sc.applicationId
        if key not in _LOCAL_DIRS:
            _LOCAL_DIRS[key] = tempfile.mkdtemp(prefix="quotelens-ckpt-")
        configured = _LOCAL_DIRS[key]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def stage_path(spark: SparkSession, name: str) -> str:
    """Path for a written stage table under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "stages", spark.sparkContext.applicationId, name)


def drop_stages(spark: SparkSession) -> None:
    """Removes the stage tables of this application; frames that read them can't be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(stage_path(spark, "x")).getParent()
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str = "stage", partition_by: list[str] | None = None):
    """Cut lineage with a written parquet stage table in the shared checkpoint folder.

    Unlike an RDD checkpoint, reads of the stage table keep parquet column
    pruning, filter push-down and (with ``partition_by``) partition pruning, and
    the table survives lost executors: a failed downstream task re-reads files
    instead of recomputing the upstream plan.
    """
    import uuid
    spark = df.sparkSession
    path = stage_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)
