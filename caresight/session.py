"""Spark session construction and lineage-cut settings."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "caresight", driver_memory: str | None = None) -> SparkSession:
    """Session tuned for the report jobs.

    AQE stays on: it coalesces small shuffle partitions, splits skewed join partitions and
    turns sort-merge joins into broadcast joins only after it has *measured* the build side.
    Locally the shuffle width equals the core count; on a cluster pass ``shuffle_partitions``
    sized for the data (AQE only coalesces downwards), e.g. input bytes / 128 MB. The range
    scans in ``operators/scans.py`` use the same width, so hot keys split that finely.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory or os.environ.get("CARESIGHT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # files of frames that are gone
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured *and* Spark runs in local mode (tests) is a private
    scratch folder created; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="caresight-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()
