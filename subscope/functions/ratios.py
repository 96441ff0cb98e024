"""Guarded division, in the three flavours the metrics need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subscope.functions.clean import _c

RATE_INPUT = "decimal(18,0)"


def rate(num: Column | str, den: Column | str, digits: int = 4) -> Column:
    """Exact rate of two counts, rounded half up; NULL when the denominator is 0."""
    return F.round(
        F.try_divide(_c(num).cast(RATE_INPUT), _c(den).cast(RATE_INPUT)), digits
    )


def utilization(used: Column | str, limit: Column | str, digits: int = 4) -> Column:
    """Used share of a limit; NULL unless the limit is positive."""
    return F.when(_c(limit) > 0, rate(used, limit, digits))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double ratio; NULL when the denominator is 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """Double ratio that is 0 when there is nothing to divide by."""
    return F.coalesce(ratio(num, den), F.lit(0.0))
