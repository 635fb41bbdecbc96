"""Session helpers for tests, the benchmark and local runs.

On a cluster the caller supplies the session; nothing here overrides a
setting that is already present (``spark.checkpoint.dir`` in particular is
read from the session and only set when it is missing).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "matchlog") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a scratch one only if unset and
    all executors are on this machine."""
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors share: the master is {master}")
    path = tempfile.mkdtemp(prefix="matchlog-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
