"""Calendar functions. Every "today" is an argument, so that a run can be repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subscope.functions.clean import _c


def month_of(c: Column | str) -> Column:
    return F.trunc(_c(c), "month")


def quarter_of(c: Column | str) -> Column:
    return F.trunc(_c(c), "quarter")


def period_of(c: Column | str, grain: str) -> Column:
    """Start date of the day, week, month, quarter or year a date lies in."""
    return F.to_date(_c(c)) if grain == "day" else F.trunc(_c(c), grain)


def month_series(start: Column, end: Column) -> Column:
    """Array of month starts from ``start`` to ``end``, both included.

    A start after the end gives an empty array (``sequence`` alone would raise), and so
    does a NULL bound once exploded.
    """
    lo, hi = month_of(start), month_of(end)
    return F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 1 month")))


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Day boundaries crossed between two dates or timestamps."""
    return F.datediff(_c(end), _c(start))


def expired_before(year: Column | str, month: Column | str, as_of: Column) -> Column:
    """Card validity ended before the month of ``as_of``.

    Not expired if year or month is missing; NULL for a month outside 1 to 12, where
    building a date would raise.
    """
    y, m = _c(year), _c(month)
    first = F.when(m.between(1, 12), F.make_date(y, m, F.lit(1)))
    return y.isNotNull() & m.isNotNull() & (first < month_of(as_of))


def calendar_columns(day: Column, weekend: tuple[int, ...] = (0, 6)) -> dict[str, Column]:
    """Attributes of a calendar day; day_of_week counts from Sunday = 0."""
    dow = F.dayofweek(day) - 1
    return {
        "year_number": F.year(day),
        "quarter_number": F.quarter(day),
        "month_number": F.month(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": dow,
        "year_month": F.date_format(day, "yyyy-MM"),
        "year_quarter": F.date_format(day, "yyyy-'Q'q"),
        "is_weekend": dow.isin(*weekend),
    }


def hierarchy_columns(day: Column) -> dict[str, Column]:
    """Report date hierarchy: year, quarter label, month name, day."""
    return {
        "year": F.year(day),
        "month_no": F.month(day),
        "month": F.date_format(day, "MMMM"),
        "quarter_no": F.floor((F.month(day) + 2) / 3).cast("int"),
        "quarter": F.concat(F.lit("Qtr "), F.quarter(day).cast("string")),
        "day": F.dayofmonth(day),
    }
