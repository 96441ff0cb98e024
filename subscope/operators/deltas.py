"""Counting open intervals by their ends instead of by every period inside.

A row that is open from one month to another adds 1 to a count at the first and takes it back after
the last. Ends are added up per group and month, and a running sum over a group's months gives
the count of each; what is shuffled is groups times months, however long the rows stay open.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def monthly_counts(
    rows: DataFrame,
    by: Sequence[str],
    month: str,
    spans: Mapping[str, tuple[Column, Column]],
    moments: Mapping[str, tuple[Column, Column]],
    rows_name: str,
) -> DataFrame:
    """Counts per group and month: ``by``, ``month``, one column per span and moment.

    ``spans`` are (first month, last month), both included: the span counts a row in each of them; none if a
    bound is NULL or the first lies after the last. ``moments`` are (month, condition) and count a row
    once. Months in which ``rows_name``, one of the spans, counts no row are left out.
    """
    names = [*spans, *moments]
    begins, ends = {n: 2 * i for i, n in enumerate(spans)}, {n: 2 * i + 1 for i, n in enumerate(spans)}
    events: list[tuple[Column, int]] = []
    for name, (first, last) in spans.items():
        open_ = first <= last
        events += [(F.when(open_, first), begins[name]), (F.when(open_, F.add_months(last, 1)), ends[name])]
    codes = {n: 2 * len(spans) + i for i, n in enumerate(moments)}
    events += [(F.when(happened, when), codes[n]) for n, (when, happened) in moments.items()]
    kind = F.col("_kind")

    def summed(name: str) -> Column:
        if name in moments:
            return F.count_if(kind == codes[name])
        return F.count_if(kind == begins[name]) - F.count_if(kind == ends[name])

    changes = (
        rows.select(*by, F.inline(F.array(*[
            F.struct(when.alias(month), F.lit(code).alias("_kind")) for when, code in events
        ]))).where(F.col(month).isNotNull())
        .groupBy(*by, month).agg(*[summed(n).alias(n) for n in names])
    )
    order = Window.partitionBy(*by).orderBy(month) if by else Window.partitionBy(F.lit(0)).orderBy(month)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    counted = changes.select(
        *by, month, F.lead(month).over(order).alias("_next"),
        *[F.sum(n).over(so_far).alias(n) for n in spans], *moments,
    ).where(F.col(rows_name) > 0)
    # between two ends nothing changes: the months up to the next end have the same counts and no moments
    months = F.transform(
        F.sequence(F.col(month), F.add_months("_next", -1), F.expr("interval 1 month")),
        lambda m, i: F.struct(m.alias(month), *[
            F.col(n) if n in spans else F.when(i == 0, F.col(n)).otherwise(0).alias(n) for n in names
        ]),
    )
    return counted.select(*by, F.inline(months))
