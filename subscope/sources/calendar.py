"""Generated scans: date spines and calendars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INTERVALS = {"day": "interval 1 day", "month": "interval 1 month", "year": "interval 1 year"}


def _bound(value: Column | date | str) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def date_spine(
    spark: SparkSession,
    start: date | str,
    end: date | str,
    step: str = "day",
    name: str = "date_day",
) -> DataFrame:
    """One row per period from ``start`` up to, not including, ``end``."""
    return spine_of(spark.range(1), _bound(start), _bound(end), step, name)


def spine_of(
    bounds: DataFrame, start: Column, end: Column, step: str = "day", name: str = "date_day"
) -> DataFrame:
    """Spine over bounds held in a one-row DataFrame; an empty span gives no rows."""
    last = F.date_sub(end, 1)
    days = F.when(start <= last, F.sequence(start, last, F.expr(INTERVALS[step])))
    return bounds.select(F.explode(days).alias(name))


def calendar_for(df: DataFrame, date_col: str, name: str = "date") -> DataFrame:
    """Every day of the calendar years that a column touches.

    The bounds are a partial aggregate over the column, so only one row reaches the
    explode, whatever the size of the input.
    """
    day = F.to_date(F.col(date_col))
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    first = F.make_date(F.year("lo"), F.lit(1), F.lit(1))
    after = F.make_date(F.year("hi") + 1, F.lit(1), F.lit(1))
    return spine_of(span, first, after, "day", name)
