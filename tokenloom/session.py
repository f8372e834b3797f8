"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tokenloom") -> SparkSession:
    """Session with AQE on and the UI off; reuses an active session.

    The master and all sizes are those of the submitted job; only a caller that
    names a master (bench, tools) gets local sizes.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (spark.checkpoint.dir).

    Only a local master without that setting (tests) gets a scratch folder; a
    cluster without a shared folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return d
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # a running session refuses the setting, so its context remembers the folder
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tokenloom-ckpt-"))
    return spark.sparkContext.getCheckpointDir()
