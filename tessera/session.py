"""Session settings the library relies on.

Every query function calls :func:`configure` first: the driver may hand us a
session it built itself, and results that involve timestamps are only stable
when the session time zone is pinned to UTC.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results (time zone) or plan quality (AQE). They are
# runtime SQL confs, so they can be set on a live session.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime bloom filters cut the probe side of selective joins before the shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """Session for tests and the local bench (the cluster brings its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    The setting is read from the session (runtime conf, then the SparkConf the
    cluster started with, then the context's checkpoint directory). Without it
    a local session, whose executors all live in this process, gets a fresh
    temporary folder; on a cluster that would be another disk on every
    machine, so there its absence is an error.
    """
    sc = spark.sparkContext
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or sc.getConf().get("spark.checkpoint.dir", None)
                  or sc.getCheckpointDir())
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")  # the context keeps it for the next call
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: several readers
    compute it once, and a lost executor recomputes nothing before it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
