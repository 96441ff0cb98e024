"""Scans of the raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from subscope.schemas import raw_schema


def read_raw(
    spark: SparkSession,
    root: str,
    table: str,
    fmt: str = "parquet",
    physical_names: Mapping[str, str] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan one raw table with its declared schema.

    ``root`` is a directory of parquet (or ORC) folders, a catalog schema
    (``fmt="table"``), or a JDBC URL (``fmt="jdbc"``). ``physical_names`` maps a logical
    table or column name to the name it carries at the site. No schema is inferred, and
    the selection reaches the scan as ``ReadSchema``.
    """
    names = dict(physical_names or {})
    schema = raw_schema(table)
    source = names.get(table, table)
    if fmt == "jdbc":
        raw = spark.read.format("jdbc").options(**jdbc_options(root, source, options)).load()
    elif fmt == "table":
        raw = spark.read.table(f"{root}.{source}" if root else source)
    else:
        renamed = StructType([
            f.__class__(names.get(f.name, f.name), f.dataType, f.nullable) for f in schema
        ])
        raw = spark.read.schema(renamed).format(fmt).load(f"{root.rstrip('/')}/{source}")
    return raw.select([
        F.col(names.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in schema
    ])


def jdbc_options(
    url: str, table: str, options: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Options of a JDBC scan.

    A parallel scan needs ``partitionColumn`` with bounds and ``numPartitions`` together;
    giving only some of them would silently read the table in one task, so it is refused.
    """
    opts = {"url": url, "dbtable": table, "driver": "org.postgresql.Driver", "fetchsize": "10000"}
    opts.update(options or {})
    split = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    given = [o for o in split if o in opts]
    if given and len(given) < len(split):
        raise ValueError(f"a parallel scan needs all of {split}, got only {given}")
    return opts


def live_rows(df: DataFrame, flag: str | None = "deleted", deleted_at: str | None = None) -> DataFrame:
    """Rows that are not soft-deleted.

    Flag style keeps only an explicit false (NULL is dropped too); timestamp style keeps
    rows that carry no deletion time. Both are plain predicates and reach the scan.
    """
    if deleted_at is not None:
        return df.where(F.col(deleted_at).isNull())
    return df.where(F.col(flag) == F.lit(False))
