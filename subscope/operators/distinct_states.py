"""Exact distinct counts that can be merged: bitmaps over a dense dictionary.

A dictionary numbers the distinct keys once. A state holds, per group and run of 32,768 numbers, a bitmap of the keys
the group has. States of finer groups merge into those of coarser ones by OR, so a total, a slice or a roll-up
reads the states and never the facts; a sum of distinct counts could not be used for that.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY, NUMBER = "_key", "_number"
BUCKET, BITS = "bucket", "bits"


def dictionary(
    facts: DataFrame, key: str, keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """(key, number from 1) of the distinct keys that are not NULL, in key order.

    Keys are sorted over the cluster; each partition numbers its own and adds what lies before it, so no
    task sees all of them. ``keep`` writes the sorted keys, which must not be planned twice.
    """
    keys = facts.select(F.col(key).alias(KEY)).where(F.col(KEY).isNotNull()).distinct()
    placed = keep(keys.repartitionByRange(KEY).sortWithinPartitions(KEY).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per partition
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.withColumn("_part", part).join(starts, "_part").select(
        KEY, (F.col("_start") + place + 1).alias(NUMBER))


def distinct_state(facts: DataFrame, by: Sequence[str], key: str, numbers: DataFrame) -> DataFrame:
    """(``by``, bucket, bits): which keys each group has. A group of only NULL keys has an empty state.

    Rows are made distinct before they meet the dictionary, so a hot key or group is one row per task.
    """
    pairs = facts.select(*by, F.col(key).alias("_k")).distinct()
    numbered = pairs.join(numbers, F.col("_k") == F.col(KEY), "left")
    bucket = F.coalesce(F.bitmap_bucket_number(NUMBER), F.lit(0))
    return numbered.groupBy(*by, bucket.alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce(F.col(NUMBER), F.lit(1)))).alias(BITS))


def merged_state(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """The state of coarser groups; ``by`` are columns of the state or of a dimension joined to it."""
    return state.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_state(state: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct keys per group, 0 for a group without any."""
    merged = merged_state(state, by)
    counted = F.when(F.col(BUCKET) > 0, F.bitmap_count(BITS)).otherwise(0)
    return merged.groupBy(*by).agg(F.coalesce(F.sum(counted), F.lit(0)).cast("bigint").alias(name))
