"""Column cleaning: what every staged column goes through."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subscope.schemas import MONEY


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """Strip the blanks of a padded character column."""
    return F.trim(_c(c))


def code(c: Column | str) -> Column:
    """A status or type code: stripped and lower-cased."""
    return F.lower(text(c))


def code_or(c: Column | str, default: str) -> Column:
    """A code with a default for NULL; a blank code stays blank."""
    return F.coalesce(code(c), F.lit(default))


def key(c: Column | str) -> Column:
    """A foreign key: stripped, and NULL when nothing is left."""
    return F.nullif(text(c), F.lit(""))


def money(c: Column | str) -> Column:
    return _c(c).cast(MONEY)


def whole(c: Column | str) -> Column:
    """Text or number to int; unreadable text gives NULL."""
    return _c(c).try_cast("int")


def business_key(*cs: Column | str, sep: str = "|") -> Column:
    """Composite business key; NULL parts are left out, so all-NULL gives ''."""
    return F.concat_ws(sep, *[text(c) for c in cs])


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the concatenated parts (plain strings are literals); NULL if any is NULL."""
    return F.md5(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


def entity_key(c: Column | str, on: Column | str) -> Column:
    """Key of a periodic snapshot row: id and period joined by a dash."""
    return F.concat(_c(c), F.lit("-"), _c(on).cast("string"))
