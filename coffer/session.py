"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "coffer", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC time.

    On a cluster the master, memory and partition counts come from spark-submit; only a local run sets a master here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1GB")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder for checkpoints and hand-over tables, under the shared folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset the session's warehouse takes its place, which
    all executors share too; a folder of one machine never does.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/{name}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder, unless the context has one already."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark, "frames"))
