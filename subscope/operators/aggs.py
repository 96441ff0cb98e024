"""Aggregation operators. All are decomposable: tasks pre-aggregate before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.clean import _c
from subscope.functions.dates import hierarchy_columns, month_of


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_where(p: Column | str) -> Column:
    """Rows where ``p`` is true; 0 if none."""
    return F.count_if(_c(p))


def sum_where(x: Column | str, p: Column | str) -> Column:
    """Sum over the rows where ``p`` is true; NULL if none."""
    return F.sum(F.when(_c(p), _c(x)))


def distinct_where(x: Column | str, p: Column | str | None = None) -> Column:
    """Exact distinct count, optionally conditional; NULL is not counted."""
    return F.count_distinct(_c(x) if p is None else F.when(_c(p), _c(x)))


def mean(x: Column | str) -> Column:
    """Average as exact sum over count, divided once in double: no order dependence."""
    c = _c(x)
    return F.try_divide(F.sum(c.cast("decimal(38,4)")).cast("double"), F.count(c).cast("double"))


def first_event_at(
    events: DataFrame, key: str, ts: str, p: Column | str, name: str
) -> DataFrame:
    """Earliest qualifying event per non-NULL key."""
    return events.where(_c(p) & F.col(key).isNotNull()).groupBy(key).agg(F.min(ts).alias(name))


def exact_median(
    df: DataFrame, by: Sequence[str], x: Column, name: str, approx: bool = False
) -> DataFrame:
    """Median per group.

    The exact form first counts each (group, value), spread over the cluster by both, and
    then takes the weighted median of that histogram: what one task holds is the number of
    distinct values of a group, not its rows. Measures here are whole days, so this is
    bounded by the day range. ``median_by_ranks`` is for measures without such a bound, exactly;
    ``approx`` estimates.
    """
    value = F.col("_x")
    base = df.select(*by, x.alias("_x")).where(value.isNotNull())
    if approx:
        return base.groupBy(*by).agg(F.percentile_approx(value, 0.5).cast("double").alias(name))
    histogram = base.groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_n"))
    return histogram.groupBy(*by).agg(F.percentile(value, 0.5, F.col("_n")).alias(name))


def monthly_agg(
    df: DataFrame, stamps: Sequence[str], aggs: Mapping[str, Column], name: str,
    keep_undated: bool = False,
) -> DataFrame:
    """Aggregate by the month of the first known date of several."""
    when = F.coalesce(*stamps)
    if not keep_undated:
        df = df.where(when.isNotNull())
    return df.groupBy(month_of(when).alias(name)).agg(*[a.alias(n) for n, a in aggs.items()])


def date_rollup(df: DataFrame, date_col: str, aggs: Mapping[str, Column]) -> DataFrame:
    """Totals on every level of the date hierarchy.

    ``level`` is 4 for a day, 3 month, 2 quarter, 1 year, 0 grand total. The days are
    summed up first and only they are expanded to the levels.
    """
    levels = hierarchy_columns(F.col(date_col))
    dated = df.withColumns({k: levels[k] for k in ("year", "quarter_no", "month_no", "day")})
    out = dated.rollup("year", "quarter_no", "month_no", "day").agg(
        F.grouping_id().alias("_g"), *[a.alias(n) for n, a in aggs.items()]
    )
    level = F.lit(4) - F.bit_count(F.col("_g").cast("int"))
    return out.withColumn("level", level.cast("int")).drop("_g")


def of_latest_period(counted: DataFrame, col: str) -> DataFrame:
    """The rows of the last period of a finished aggregate; the period is one row joined to it."""
    last = counted.agg(F.max(col).alias("_last"))
    return counted.join(F.broadcast(last), F.col(col) == F.col("_last")).drop("_last")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()
