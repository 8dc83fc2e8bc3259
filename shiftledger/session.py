"""A session with the settings the reports are tuned for."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def scratch_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    Only a session of one machine without that setting makes its own, which is
    removed when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="shiftledger-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoint to the folder the cluster names; a session of one machine may make its own."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_folder(spark))


def local_session(cores: int | str, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks.  On a cluster, use your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shiftledger")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
