"""Spark session and cluster settings used by the library, tests and bench.

The settings favour a cluster run: adaptive execution re-plans joins from
runtime sizes (a side is broadcast only once its materialised size is under
the threshold), splits skewed shuffle partitions, and coalesces small ones.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session options every job relies on.  Time zone is pinned so that
# date/timestamp arithmetic gives the same answer on every executor.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # runtime bloom filters let a selective order filter prune the item scan
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # MIN/MAX/COUNT without filters are answered from Parquet footers
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ratify", driver_memory: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master``/``shuffle_partitions`` are for local runs; on a cluster the
    submitter supplies them and this only adds the session options.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        # local mode runs every task in the driver JVM; only effective before it starts
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    for key, value in CLUSTER_CONF.items():
        spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is given by the deployment (a shared filesystem
    every executor can reach); without it a cluster session fails here.  Only
    a local master, as in tests, gets a fresh scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ratify-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def local_session(cores: int | None = None) -> SparkSession:
    """Session for tests and the bench (``local[N]``)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return build_session(master=f"local[{cores}]", shuffle_partitions=cores,
                         driver_memory=os.environ.get("RATIFY_DRIVER_MEMORY", "12g"))
