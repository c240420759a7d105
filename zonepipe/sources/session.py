"""Session settings the jobs rely on, and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
PARTITION_BYTES = 256 * 1024 * 1024

JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    # Rebalanced staging writes and merged shuffle partitions aim at this much data.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Adaptive execution merges partitions but adds none: ask for many.  A deployment whose
    # lookup shuffles more than this number times the size above should raise it.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
}


def job_session(name: str) -> SparkSession:
    """Session for the command line; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in JOB_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``.  Only a local master may go without
    that setting; it then gets a temporary folder, removed at exit.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="zonepipe-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
