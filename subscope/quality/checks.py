"""Data-quality checks as Spark jobs.

``failures`` counts what is wrong: rows for not_null and relationships, distinct offending
values for accepted_values, duplicated keys for unique. Every check aggregates before its
shuffle, and only its columns are read. ``run_checks`` goes table by table and keeps a few rows of
each, so that the disk holds the shuffles of one table at a time.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscope.operators.joins import orphans
from subscope.schemas import TableSpec
from subscope.session import scratch_root, shuffles_released

NOT_NULL, UNIQUE, RELATIONSHIPS = "not_null", "unique", "relationships"
ACCEPTED, COMBINATION = "accepted_values", "unique_combination"
WARN, ERROR = "warn", "error"
REPORT = "check string, model string, column string, severity string, failures bigint, status string"
#: Places for the values of a combination's last column, see ``dq_unique_combination``.
SLOTS = 256


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    columns: tuple[str, ...]
    severity: str = ERROR
    where: str | None = None
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_key: str | None = None
    max_ratio: float | None = None  # tolerated share of orphans; None tolerates none

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def _rows(df: DataFrame, where: str | None) -> DataFrame:
    return df if where is None else df.where(where)


def dq_not_null(df: DataFrame, *cols: str, where: str | None = None) -> DataFrame:
    """Rows without a value, for any number of columns in one pass: (column, failures)."""
    counts = _rows(df, where).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in cols])
    return counts.select(F.inline(pairs))


def _repeated(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    groups = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.where(F.col("n") > 1).agg(F.count(F.lit(1)).alias("failures"))


def _slot(rows: DataFrame, col: str) -> Column | None:
    """One of ``SLOTS`` places for each value, other ones for months in sequence; None for types whose equal values may differ."""
    kind = rows.schema[col].dataType
    if isinstance(kind, T.DateType):
        number = F.floor(F.unix_date(col) / F.lit(28))
    elif isinstance(kind, T.IntegralType):
        number = F.col(col)
    elif kind == T.StringType():
        number = F.xxhash64(col)
    else:
        return None
    return F.coalesce(F.pmod(number.cast("bigint"), F.lit(SLOTS)), F.lit(0)).cast("int")


def dq_unique_combination(df: DataFrame, cols: Sequence[str], where: str | None = None) -> DataFrame:
    """Number of key combinations that occur more than once; NULL counts as a value.

    The rows of a combination share all columns but the last. Per value of those a row count and the places
    that the last column marks tell for most that nothing repeats, and what crosses the shuffle is one row for
    each such value and task. Only where two rows share a place are the combinations themselves counted. The
    places are counted when this is called.
    """
    cols = list(dict.fromkeys(cols))
    *first, last = cols
    rows = _rows(df, where).select(*[F.col(_quoted(c)) for c in cols])
    slot = _slot(rows, last)
    if not first or slot is None:
        return _repeated(rows, cols)
    spark, words = df.sparkSession, [f"_places{i}" for i in range(SLOTS // 64)]
    with shuffles_released(spark):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot % 64)
        marked = rows.groupBy(*first).agg(F.count(F.lit(1)).alias("_rows"), *[
            F.bit_or(F.when(F.floor(slot / 64) == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(w)
            for i, w in enumerate(words)
        ])
        places = sum((F.bit_count(w) for w in words), F.lit(0))
        path = f"{scratch_root(spark)}/checks-{uuid4().hex}"
        marked.where(F.col("_rows") > places).select(*first).write.parquet(path)
        doubtful = spark.read.schema(rows.select(*first).schema).parquet(path)
        if doubtful.isEmpty():
            return spark.range(1).select(F.lit(0).cast("bigint").alias("failures"))
    same = reduce(Column.__and__, [F.col(f"r.{_quoted(c)}").eqNullSafe(F.col(f"d.{_quoted(c)}")) for c in first])
    return _repeated(rows.alias("r").join(doubtful.alias("d"), same, "left_semi"), cols)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dq_unique(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    """Number of values that occur more than once; NULL is left out."""
    return dq_unique_combination(_rows(df, where).where(F.col(col).isNotNull()), [col])


def dq_relationships(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, where: str | None = None
) -> DataFrame:
    """Child rows whose key has no parent; NULL keys are fine."""
    lost = orphans(_rows(child, where), fk, parent, pk)
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))


def dq_accepted_values(
    df: DataFrame, col: str, values: Sequence[str], where: str | None = None
) -> DataFrame:
    """Number of distinct values outside the list; NULL is fine."""
    bad = _rows(df, where).where(~F.col(col).isin(*values))
    return bad.agg(F.count_distinct(col).alias("failures"))


def _status(severity: Column, tolerated: Column) -> Column:
    return (
        F.when(F.col("failures") <= tolerated, "pass")
        .when(severity == WARN, WARN)
        .otherwise("fail")
    )


def _report(df: DataFrame, check: Check, tolerated: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(check.kind).alias("check"),
        F.lit(check.table).alias("model"),
        (F.col("column") if "column" in df.columns else F.lit(check.column)).alias("column"),
        F.lit(check.severity).alias("severity"),
        F.col("failures").cast("bigint").alias("failures"),
        _status(F.lit(check.severity), F.lit(0) if tolerated is None else tolerated)
        .alias("status"),
    )


def _single(tables: Mapping[str, DataFrame], c: Check) -> DataFrame:
    df = tables[c.table]
    if c.kind == UNIQUE:
        return _report(dq_unique(df, c.columns[0], c.where), c)
    if c.kind == COMBINATION:
        return _report(dq_unique_combination(df, c.columns, c.where), c)
    if c.kind == ACCEPTED:
        return _report(dq_accepted_values(df, c.columns[0], c.values, c.where), c)
    raise ValueError(f"unknown check {c.kind!r}")


def _relationships(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Relationship checks together: each child and each parent is read once.

    A parent's keys are made distinct as they are, so lookups that only add columns to it are not planned. The keys of a child's checks are stacked and counted, and met with the stacked keys of the
    parents in one join; what has no parent is summed up per check.
    """
    parents = {key: i for i, key in enumerate(dict.fromkeys((c.parent, c.parent_key) for c in checks))}
    children: dict[str, list[int]] = {}
    for i, c in enumerate(checks):
        children.setdefault(c.table, []).append(i)

    def keys(numbers: Sequence[int]) -> Column:
        def key(c: Check) -> Column:
            value = F.col(c.columns[0]).cast("string")
            return value if c.where is None else F.when(F.expr(c.where), value)

        return F.array(*[
            F.struct(
                F.lit(i).alias("check_no"),
                F.lit(parents[checks[i].parent, checks[i].parent_key]).alias("parent_no"),
                key(checks[i]).alias("key"),
            ) for i in numbers
        ])

    counted = [
        tables[t].select(F.inline(keys(numbers))).where(F.col("key").isNotNull())
        .groupBy("check_no", "parent_no", "key").agg(F.count(F.lit(1)).alias("n"))
        for t, numbers in children.items()
    ]
    known = [
        tables[p].select(F.col(pk).cast("string").alias("key")).where(F.col("key").isNotNull()).distinct()
        .select(F.lit(i).alias("parent_no"), "key")
        for (p, pk), i in parents.items()
    ]
    met = reduce(DataFrame.union, counted).join(
        reduce(DataFrame.union, known).withColumn("known", F.lit(True)), ["parent_no", "key"], "left"
    )
    sums = met.groupBy("check_no").agg(
        F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("lost"), F.sum("n").alias("keys"))
    listed = sums.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("check_no"), F.lit(c.table).alias("model"), F.lit(c.column).alias("column"),
            F.lit(c.severity).alias("severity"), F.lit(float(c.max_ratio or 0)).alias("ratio"),
        ) for i, c in enumerate(checks)
    ])))
    found = listed.join(sums, "check_no", "left").withColumn(
        "failures", F.coalesce("lost", F.lit(0)).cast("bigint"))
    return found.select(
        F.lit(RELATIONSHIPS).alias("check"), "model", "column", "severity", "failures",
        _status(F.col("severity"), F.coalesce("keys", F.lit(0)) * F.col("ratio")).alias("status"),
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """All checks as one DataFrame (check, model, column, severity, failures, status).

    The checks run when this is called, table by table: the not_null checks of a table share one pass over
    it, its relationships share one join. Shuffle files go after each pass; a row for each check is kept.
    """
    single: dict[str, list[Check]] = {}
    related: dict[str, list[Check]] = {}
    for c in checks:
        (related if c.kind == RELATIONSHIPS else single).setdefault(c.table, []).append(c)
    passes = [lambda lot=lot: _of_table(tables, lot) for lot in single.values()]
    passes += [lambda lot=lot: _relationships(tables, lot) for lot in related.values()]
    spark = tables[next(iter(single | related))].sparkSession
    found: list[Row] = []
    with shuffles_released(spark):
        for run in passes:
            found += run().collect()
    return spark.createDataFrame(found, REPORT)


def _of_table(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """The checks of one table that need no other."""
    parts = [_single(tables, c) for c in checks if c.kind != NOT_NULL]
    together: dict[tuple[str, str | None], list[Check]] = {}
    for c in checks:
        if c.kind == NOT_NULL:
            together.setdefault((c.severity, c.where), []).append(c)
    for (_, where), group in together.items():
        cols = [col for c in group for col in c.columns]
        parts.append(_report(dq_not_null(tables[group[0].table], *cols, where=where), group[0]))
    return reduce(DataFrame.unionByName, parts)


def relax(checks: Iterable[Check], kinds: Collection[str]) -> list[Check]:
    """Turn the checks of some kinds into warnings."""
    return [replace(c, severity=WARN) if c.kind in kinds else c for c in checks]


def checks_from_spec(spec: TableSpec) -> list[Check]:
    """The checks a table's contract implies."""
    conditions = dict(spec.where)

    def make(kind: str, *cols: str, **kw) -> Check:
        severity = WARN if cols[0] in spec.warn else ERROR
        return Check(kind, spec.name, cols, severity, where=kw.pop("where", None), **kw)

    out = []
    if len(spec.pk) == 1:
        out.append(make(UNIQUE, spec.pk[0]))
    else:
        out.append(make(COMBINATION, *spec.pk))
    out += [make(NOT_NULL, c) for c in dict.fromkeys([*spec.pk, *spec.not_null])]
    out += [
        make(RELATIONSHIPS, fk, parent=parent, parent_key=pk, where=conditions.get(fk))
        for fk, parent, pk in spec.fks
    ]
    out += [
        make(ACCEPTED, c, values=values, where=conditions.get(c)) for c, values in spec.accepted
    ]
    return out
