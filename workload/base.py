"""Registry of queries and what every query shares: the warehouse and the output edge."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscope.plans.warehouse import Warehouse, size_for
from subscope.session import configure
from subscope.sources.bindings import bound_raw

AS_OF = "2001-11-20"  # fixed, so that runs can be compared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SURVEY: dict[str, tuple[str, ...]] = {}  # query -> inventory ids it covers


_PLANNED: WeakKeyDictionary[SparkSession, dict[str, Warehouse]] = WeakKeyDictionary()


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over one folder of given tables.

    One per session and folder, as a user would hold it: its models are lazy plans, so
    nothing computed is shared between queries.
    """
    known = _PLANNED.setdefault(spark, {})
    if sf_dir not in known:
        known[sf_dir] = _plan(spark, sf_dir)
    return known[sf_dir]


def _plan(spark: SparkSession, sf_dir: str) -> Warehouse:
    configure(spark)
    w = Warehouse(spark, bound_raw(spark, sf_dir), AS_OF)
    size_for(w)
    w.calendar_start = w["stg_orders"].agg(F.min(F.to_date("created_at")).alias("first_day"))
    return w


def edge(df: DataFrame) -> DataFrame:
    """Output types any consumer compares alike: decimals as double, zone-less timestamps."""
    df = df.drop("_etl_synced_at", "_etl_source_system")
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            casts[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


def query(name: str, *ids: str):
    """Register a builder ``Warehouse -> DataFrame`` under a name."""
    def register(build: Callable[[Warehouse], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: edge(build(warehouse(spark, sf_dir)))
        SURVEY[name] = ids
        return build

    return register
