"""Session helpers: building a local session for tests/bench and locating the
shared checkpoint folder that iterative operators cut lineage into."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "ruleweave", shuffle_partitions: int = 8,
                  driver_memory: str = "16g") -> SparkSession:
    """A local session for tests and the benchmark (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, reading it from the session first.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS, S3,
    ...); it is used as is.  Only when nothing is configured *and* the master is
    local (tests, the benchmark) a private temporary folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared checkpoint folder on a cluster")
    path = tempfile.mkdtemp(prefix="ruleweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
