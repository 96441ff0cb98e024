"""Boolean columns. NULL input stays NULL unless a function says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from subscope.functions.clean import _c, code


def status_flag(c: Column | str, *values: str, negate: bool = False) -> Column:
    """Cleaned status is (not) one of ``values``; NULL status gives NULL."""
    hit = code(c) == values[0] if len(values) == 1 else code(c).isin(*values)
    return ~hit if negate else hit


def ilike_flag(c: Column | str, pattern: str) -> Column:
    return F.trim(_c(c)).ilike(pattern)


def all_flags(*flags: Column | str) -> Column:
    """Conjunction where an unknown counts as false."""
    both = _c(flags[0])
    for f in flags[1:]:
        both = both & _c(f)
    return F.coalesce(both, F.lit(False))


def indicator(flag: Column | str) -> Column:
    """1 for true, 0 for false and NULL."""
    return F.when(_c(flag), 1).otherwise(0)


def over_limit_flag(used: Column | str, limit: Column | str) -> Column:
    return (_c(limit) > 0) & (_c(used) > _c(limit))


def differs(a: Column | str, b: Column | str) -> Column:
    """Null-safe inequality: NULL equals NULL and differs from everything else."""
    return ~_c(a).eqNullSafe(_c(b))


def segment(branches: Sequence[tuple[Column, str]], default: str) -> Column:
    """First branch whose predicate is true gives the label."""
    (first, label), *rest = branches
    out = F.when(first, label)
    for predicate, name in rest:
        out = out.when(predicate, name)
    return out.otherwise(default)


def first_known(*cs: Column | str, default: str | None = None) -> Column:
    """First non-NULL over alternative lookup paths."""
    cols = [_c(c) for c in cs]
    return F.coalesce(*cols, *([F.lit(default)] if default is not None else []))
