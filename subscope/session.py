"""Session settings the operators rely on.

``configure`` works on a session somebody else made (a cluster's, a notebook's) and only
sets runtime SQL options; ``local_session`` is for tests and the local bench.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# UTC: month buckets and date casts must not move with the machine's zone.
# ANSI stays on, so that a bad plain cast raises as it does in the source database.
RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for option, value in RUNTIME_OPTIONS.items():
        if spark.conf.get(option, None) != value:
            spark.conf.set(option, value)
    return spark


SHUFFLE_BYTES = 128 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffle(spark: SparkSession, scan_bytes: int) -> int:
    """Let shuffles start with enough partitions for an input of ``scan_bytes``.

    The default of 200 would give partitions of hundreds of gigabytes on a large input.
    Adaptive execution merges what turns out small, so starting high is safe; a session
    that already starts higher is left alone. Returns the number in force.
    """
    have = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    need = -(-scan_bytes // SHUFFLE_BYTES)
    if need > have:
        spark.conf.set(INITIAL_PARTITIONS, str(need))
    return max(need, have)


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query planned inside go when it ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    A session on one machine may go without and gets a temporary folder. On a cluster that would leave each
    executor's rows on its own disk, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder all executors share; the master is {master}")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="subscope-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def local_session(cores: int | str = "*", app: str = "subscope") -> SparkSession:
    shuffle = os.cpu_count() if cores == "*" else cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SUBSCOPE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
