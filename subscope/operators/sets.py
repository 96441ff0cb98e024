"""Set operations, ranking and deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def conform_union(sources: Mapping[str, DataFrame], schema: Mapping[str, str], tag: str) -> DataFrame:
    """Union all of sources brought to one schema.

    A column a source lacks becomes a typed NULL; ``tag`` names the source of each row.
    """
    def fit(label: str, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(
            F.lit(label).alias(tag),
            *[
                (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
                for c, t in schema.items()
            ],
        )

    return reduce(DataFrame.unionByName, [fit(k, df) for k, df in sources.items()])


def union_keys(*dfs: DataFrame) -> DataFrame:
    """Distinct keys over several sources; NULL is a key too."""
    return reduce(DataFrame.union, dfs).distinct()


def union_distinct_count(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """Number of distinct non-NULL keys in A or B."""
    both = a.select(key).union(b.select(key)).where(F.col(key).isNotNull())
    return both.agg(F.count_distinct(key).alias(name))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order.

    Spark plans a partial group limit before the shuffle, so at most one row per key and
    task is moved, also for a hot key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def top_k_per_group(
    df: DataFrame, group: Sequence[str], item: Sequence[str], measure: Column, name: str, k: int
) -> DataFrame:
    """The k best items of each group by an aggregate; ties go by item, ascending.

    The measure is aggregated per (group, item) first, and the partial group limit keeps k
    rows per group and task before the ranking shuffle.
    """
    totals = df.groupBy(*group, *item).agg(measure.alias(name))
    w = Window.partitionBy(*group).orderBy(
        F.desc_nulls_last(name), *[F.asc_nulls_last(i) for i in item]
    )
    return totals.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ranked(df: DataFrame, measure: str, *keys: str) -> DataFrame:
    """Order an aggregate by its measure, largest first, then by key."""
    return df.orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_first(k) for k in keys])
