"""Exact medians of measures with any number of distinct values.

A task never holds the values of a group. Mergeable quantile sketches bracket the middle ranks of every group; only
what lies inside a bracket is counted, and brackets shrink until each holds at most ``bound`` distinct values, from which the
middle ones are read. A sketch decides only where to look: rows below a bracket are counted exactly, and a bracket
that misses a middle rank is opened again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Distinct values of one group that a task may hold.
BOUND = 1 << 16
#: Half the width of a bracket as a share of the rows in the one before, and the sketch's accuracy: its error is less.
MARGIN, ACCURACY = 0.002, 2000


def _equal(by: Sequence[str], prefix: str) -> Column:
    out = F.lit(True)
    for c in by:
        out &= F.col(c).eqNullSafe(F.col(prefix + c))
    return out


def median_by_ranks(
    df: DataFrame, by: Sequence[str], x: Column, name: str, bound: int = BOUND,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Median per group; the mean of the two middle values of an even number. NULL and NaN are left out.

    ``keep`` may write a table and read it back; it gets the measure's rows, then each round's smaller rest.
    Each round runs two small jobs: planning this needs answers from the data.
    """
    value, wanted = F.col("_x"), [f"_{c}" for c in by]
    rows = keep(df.select(*by, x.cast("double").alias("_x")).where(value.isNotNull() & ~F.isnan(value)))
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    # ranks count from 0 within the rows that are left; ``_low`` and ``_high`` are the middle ones
    state = keep(counts.select(
        *[F.col(c).alias(w) for c, w in zip(by, wanted, strict=True)],
        F.floor((F.col("_n") - 1) / 2).alias("_low"), F.floor(F.col("_n") / 2).alias("_high"), "_n"))
    while True:
        sizes = rows.groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_c")) if not _large(rows, by, bound) else None
        if sizes is not None:
            return _read_off(sizes, state, by, name)
        share = [F.greatest(F.lit(0.0), F.col("_low") / F.col("_n") - MARGIN), F.least(F.lit(1.0), F.col("_high") / F.col("_n") + MARGIN)]
        sketch = rows.groupBy(*by).agg(F.percentile_approx("_x", [i / 1000 for i in range(1001)], ACCURACY).alias("_q"))
        marks = sketch.select(*[F.col(c).alias(f"_s{c}") for c in by], "_q")
        joined = state.join(marks, _pairs(wanted, [f"_s{c}" for c in by])) if by else state.crossJoin(marks)
        bracket = joined.select(
            *wanted, "_low", "_high", "_n",
            F.element_at("_q", (F.floor(share[0] * 1000) + 1).cast("int")).alias("_from"),
            F.element_at("_q", (F.ceil(share[1] * 1000) + 1).cast("int")).alias("_to"))
        held = rows.join(F.broadcast(bracket) if not by else bracket, _equal(by, "_") if by else F.lit(True))
        passed = held.groupBy(*wanted, "_low", "_high", "_n", "_from", "_to").agg(
            F.count_if(value < F.col("_from")).alias("_below"),
            F.count_if(value.between(F.col("_from"), F.col("_to"))).alias("_inside"))
        good = (F.col("_below") <= F.col("_low")) & (F.col("_high") < F.col("_below") + F.col("_inside"))
        narrowed = keep(passed.select(
            *wanted,
            F.when(good, F.col("_low") - F.col("_below")).otherwise(F.col("_low")).alias("_low"),
            F.when(good, F.col("_high") - F.col("_below")).otherwise(F.col("_high")).alias("_high"),
            F.when(good, F.col("_inside")).otherwise(F.col("_n")).alias("_n"),
            F.when(good, F.col("_from")).otherwise(F.lit(float("-inf"))).alias("_from"),
            F.when(good, F.col("_to")).otherwise(F.lit(float("inf"))).alias("_to")))
        state = narrowed.select(*wanted, "_low", "_high", "_n")
        rows = keep(
            rows.join(narrowed, (_equal(by, "_") if by else F.lit(True)) & value.between(F.col("_from"), F.col("_to")))
            .select(*by, "_x"))


def _pairs(left: Sequence[str], right: Sequence[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out &= F.col(a).eqNullSafe(F.col(b))
    return out


def _large(rows: DataFrame, by: Sequence[str], bound: int) -> bool:
    """Whether some group has more than ``bound`` distinct values."""
    distinct = rows.groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_c"))
    return not distinct.groupBy(*by).agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") > bound).isEmpty()


def _read_off(sizes: DataFrame, state: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """The middle values, from at most ``bound`` counted ones of a group."""
    order = Window.partitionBy(*by).orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    placed = sizes.withColumn("_end", F.sum("_c").over(order))
    met = placed.join(state if by else F.broadcast(state), _equal(by, "_") if by else F.lit(True))
    covers = lambda rank: F.max(F.when((F.col("_end") - F.col("_c") <= F.col(rank)) & (F.col(rank) < F.col("_end")), F.col("_x")))
    return met.groupBy(*by).agg(((covers("_low") + covers("_high")) / 2).alias(name))
