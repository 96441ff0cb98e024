"""Sinks: marts as versioned tables, bucketed tables, views."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "version bigint, folder string, written_at timestamp"


def write_mart(
    df: DataFrame,
    root: str,
    name: str,
    partition_by: Sequence[str] = (),
) -> str:
    """Full refresh of one mart as parquet; returns the path of the new version.

    The rows go to a folder of their own; then one record in the mart's log publishes it. Readers
    (``read_mart``) resolve the log, so they see the old version until the new one is complete, a write that
    fails half-way changes nothing for them, and whoever has planned a query on the old version can finish it.

    A partitioned mart is rebalanced on the partition columns first: adaptive execution
    then merges small partitions and splits a hot one, so neither thousands of tiny files
    nor one huge task comes out.
    """
    spark, base = df.sparkSession, f"{root.rstrip('/')}/{name}"
    folder = f"v-{uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/{folder}")
    publish(spark, base, folder)
    return f"{base}/{folder}"


def publish(spark: SparkSession, base: str, folder: str) -> int:
    """Make a complete folder the mart's current version; returns its number.

    The record is one small file that the committer moves into place as a whole. Two refreshes at once may
    take one number; the later record of the two is current then.
    """
    known = _log(spark, base)
    number = 1 + (known.agg(F.max("version")).first()[0] or 0 if known is not None else 0)
    record = spark.range(1).select(
        F.lit(number).cast("bigint").alias("version"), F.lit(folder).alias("folder"), F.current_timestamp().alias("written_at"))
    record.coalesce(1).write.mode("append").json(f"{base}/log")
    return number


def _log(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LOG).json(f"{base}/log")
    except Exception as failure:  # Spark says so in a condition, whatever the store is
        if "PATH_NOT_FOUND" in str(failure):
            return None
        raise


def versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(version, folder, written_at) of all published versions of a mart."""
    known = _log(spark, f"{root.rstrip('/')}/{name}")
    return spark.createDataFrame([], _LOG) if known is None else known


def mart_path(spark: SparkSession, root: str, name: str, version: int | None = None) -> str:
    """Folder of a version of a mart, the current one by default."""
    known = versions(spark, root, name)
    if version is not None:
        known = known.where(F.col("version") == version)
    found = known.agg(F.max_by("folder", F.struct("version", "written_at", "folder"))).first()[0]
    if found is None:
        raise FileNotFoundError(f"mart {name!r} has no version {version or ''} below {root}")
    return f"{root.rstrip('/')}/{name}/{found}"


def read_mart(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A published version of a mart, the current one by default."""
    return spark.read.parquet(mart_path(spark, root, name, version))


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> str:
    """Full refresh as a catalog table bucketed on its join keys, at ``path`` if one is given.

    Facts bucketed alike on a shared key join without a shuffle. The rows are dealt to the buckets before the
    write, so that a bucket is one file.
    """
    writer = (
        df.repartition(buckets, *keys).write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .format("parquet")
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
