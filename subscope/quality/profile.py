"""Profiling jobs: what a new extract looks like before it is trusted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.operators.joins import orphans


def profile_table(df: DataFrame, pk: str, flag: str | None = "deleted", deleted_at: str | None = None) -> DataFrame:
    """Row count, distinct keys, duplicated rows and soft-deleted rows in one pass."""
    gone = F.col(deleted_at).isNotNull() if deleted_at else F.coalesce(F.col(flag), F.lit(False))
    # counting per key first spreads a repeated key; the second step only sums up
    per_key = df.groupBy(pk).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(gone).alias("gone")
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(pk).alias("distinct_keys"),
        F.count_if((F.col("n") > 1) & F.col(pk).isNotNull()).alias("duplicated_keys"),
        F.coalesce(F.sum("gone"), F.lit(0)).alias("deleted_rows"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return (
        df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc_nulls_first(col))
    )


def orphan_report(links: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Orphaned rows per (name, child, fk, parent, pk)."""
    def one(name: str, child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
        return orphans(child, fk, parent, pk).agg(
            F.lit(name).alias("relation"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            F.count("fk").alias("orphan_keys"),
        )

    return reduce(DataFrame.unionByName, [one(*link) for link in links])


def null_rates(df: DataFrame) -> DataFrame:
    """Share of NULL per column, and whether a column holds nothing at all."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("null_rows")) for c in df.columns
    ])
    return counts.select("_rows", F.inline(pairs)).select(
        "column",
        "null_rows",
        F.try_divide(F.col("null_rows").cast("double"), F.col("_rows").cast("double"))
        .alias("null_rate"),
        (F.col("null_rows") == F.col("_rows")).alias("is_all_null"),
    )
