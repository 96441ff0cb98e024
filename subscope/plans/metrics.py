"""Metric queries: a metric by any dimensions and time grain, as one DataFrame.

Facts are aggregated by their own columns and foreign keys before a dimension is joined,
so a join to a large dimension sees one row per key, and a hot key is one row per task by
then. Distinct counts and medians go the same way as (value, count) histograms.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.dates import period_of
from subscope.functions.ratios import ratio
from subscope.operators.joins import enrich, slice_by
from subscope.plans.conform import monthly_snapshot_counts
from subscope.plans.semantics import METRICS, MODELS, Derived, Measure, Ratio, SemanticModel, Simple, model_of_entity

TIME = "metric_time"
_WIDE = "decimal(38,4)"


@dataclass(frozen=True)
class Keys:
    """Resolved group-by: columns of the fact, and columns behind a foreign key."""

    own: dict[str, Column]
    foreign: dict[str, tuple[str, str, str, str]]  # output -> (fk, mart, key, column)

    @property
    def names(self) -> list[str]:
        return [*self.own, *self.foreign]

    @property
    def first_level(self) -> list[str]:
        """What the fact is grouped by before any dimension is joined."""
        return list(dict.fromkeys([*self.own, *self.links]))

    @property
    def links(self) -> list[str]:
        return list(dict.fromkeys(fk for fk, *_ in self.foreign.values()))


def resolve_keys(model: SemanticModel, group_by: Sequence[str], grain: str | None) -> Keys:
    """``group_by`` holds dimensions of the model itself, ``entity__dimension`` for those
    of a linked model, or ``metric_time``; a grain alone implies ``metric_time``."""
    own: dict[str, Column] = {}
    foreign: dict[str, tuple[str, str, str, str]] = {}
    wanted = list(group_by)
    if grain is not None and TIME not in wanted:
        wanted.insert(0, TIME)
    for name in wanted:
        entity, _, dim = name.rpartition("__")
        if name == TIME:
            own[name] = period_of(model.time, grain or "day")
        elif entity in ("", model.primary):
            if dim not in (*model.dimensions, model.time):
                raise KeyError(f"{dim!r} is not a dimension of {model.mart}")
            own[name] = F.col(dim)
        else:
            other = MODELS[model_of_entity(entity)]
            if dim not in (*other.dimensions, other.time):
                raise KeyError(f"{dim!r} is not a dimension of {other.mart}")
            foreign[name] = (model.foreign[entity], other.mart, other.key, dim)
    return Keys(own, foreign)


def apply_slicers(
    w: Mapping[str, DataFrame], model: SemanticModel, df: DataFrame,
    slicers: Mapping[str, Sequence[object]],
) -> DataFrame:
    """Keep the facts whose dimensions have one of the chosen values."""
    for name, values in slicers.items():
        entity, _, dim = name.rpartition("__")
        chosen = F.col(dim).isin(*values)
        if entity in ("", model.primary):
            df = df.where(chosen)
        else:
            other = MODELS[model_of_entity(entity)]
            df = slice_by(df, w[other.mart], chosen, (model.foreign[entity], other.key))
    return df


def join_keys(w: Mapping[str, DataFrame], df: DataFrame, keys: Keys) -> DataFrame:
    """Bring the linked dimensions onto the rows; facts without a match keep NULL."""
    for fk in keys.links:
        wanted = {n: spec for n, spec in keys.foreign.items() if spec[0] == fk}
        _, mart, pk, _ = next(iter(wanted.values()))
        df = enrich(df, w[mart], (fk, pk), {n: spec[3] for n, spec in wanted.items()})
    return df


SNAPSHOTS = "subscription_monthly_snapshots"
_SNAPSHOT_DIMENSIONS = {"snapshot_month", "snapshot_quarter", "subscription_status"}
_SNAPSHOT_FLAGS = {
    "is_active", "is_active_at_quarter_start", "is_churned", "is_upgraded", "is_kifed", "is_upgraded_or_kifed",
}


def counted_snapshots(
    w: Mapping[str, DataFrame], keys: Keys, slicers: Mapping[str, Sequence[object]], flags: Collection[str]
) -> DataFrame | None:
    """Counts of monthly snapshots per ``keys.first_level`` and month, from the ends of their intervals.

    ``snapshots`` counts rows and a column for each of ``flags`` those that have it. None if the snapshots are
    written as a mart, or a key or slicer needs a column only they have.
    """
    source = getattr(w, "snapshot_subscriptions", None)
    subscriptions = source() if source else None
    model = MODELS[SNAPSHOTS]

    def own(name: str) -> str | None:
        entity, _, dim = name.rpartition("__")
        return dim if entity in ("", model.primary) else None

    dims = {n: model.time if n == TIME else own(n) for n in keys.own}
    sliced = {n: own(n) for n in slicers}
    asked = {d for d in (*dims.values(), *sliced.values()) if d is not None}
    if subscriptions is None or not asked <= _SNAPSHOT_DIMENSIONS:
        return None
    early = {n: v for n, v in slicers.items() if sliced[n] in (None, "subscription_status")}
    late = {sliced[n]: v for n, v in slicers.items() if n not in early}
    status = ["subscription_status"] if "subscription_status" in dims.values() else []
    counts = monthly_snapshot_counts(
        apply_slicers(w, model, subscriptions, early), w.as_of, list(dict.fromkeys([*keys.links, *status])), flags)
    for dim, values in late.items():
        counts = counts.where(F.col(dim).isin(*values))
    return counts.withColumns({n: c for n, c in keys.own.items() if n not in counts.columns})


def _counts(w, df: DataFrame, keys: Keys, measures: Mapping[str, Measure]) -> DataFrame:
    """Counting measures over rows that are counts themselves."""
    sums = {n: "snapshots" if m.agg == "count" else m.expr for n, m in measures.items()}
    partial = df.groupBy(*keys.first_level).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    if keys.foreign:
        partial = join_keys(w, partial, keys).groupBy(*keys.names).agg(*[F.sum(n).alias(n) for n in sums])
    return partial.select(*keys.names, *[F.coalesce(n, F.lit(0)).alias(n) for n in sums])


def _additive(name: str, measure: Measure) -> tuple[dict[str, Column], dict[str, Column], Column]:
    """Partial columns, how they merge, and the final expression over the merged ones."""
    x = F.expr(measure.expr)
    if measure.agg == "count":
        parts = {f"{name}__n": F.count(F.lit(1))}
        final = F.col(f"{name}__n")
    elif measure.agg == "count_if":
        parts = {f"{name}__n": F.count_if(x)}
        final = F.col(f"{name}__n")
    elif measure.agg == "sum":
        parts = {f"{name}__s": F.sum(x)}
        final = F.col(f"{name}__s")
    else:  # average
        parts = {f"{name}__s": F.sum(x.cast(_WIDE)), f"{name}__n": F.count(x)}
        final = ratio(f"{name}__s", f"{name}__n")
    return parts, {p: F.sum(p) for p in parts}, final


def _sums(w, df: DataFrame, keys: Keys, measures: Mapping[str, Measure]) -> DataFrame:
    specs = {n: _additive(n, m) for n, m in measures.items()}
    parts = {p: c for s in specs.values() for p, c in s[0].items()}
    merged = {p: c for s in specs.values() for p, c in s[1].items()}
    final = [s[2].alias(n) for n, s in specs.items()]
    grouped = df.select("*", *[c.alias(n) for n, c in keys.own.items() if n not in df.columns])
    partial = grouped.groupBy(*keys.first_level).agg(*[c.alias(p) for p, c in parts.items()])
    if keys.foreign:
        partial = join_keys(w, partial, keys).groupBy(*keys.names).agg(
            *[c.alias(p) for p, c in merged.items()]
        )
    return partial.select(*keys.names, *final)


def _values(w, df: DataFrame, keys: Keys, name: str, measure: Measure) -> DataFrame:
    """Distinct count or median over a histogram of the values."""
    grouped = df.select(
        *[c.alias(n) for n, c in keys.own.items()],
        *[c for c in keys.links if c not in keys.own],
        F.expr(measure.expr).alias("_v"),
    )
    histogram = grouped.groupBy(*keys.first_level, "_v").agg(F.count(F.lit(1)).alias("_n"))
    if keys.foreign:
        histogram = join_keys(w, histogram, keys)
        # equal values behind different keys are one value of the group
        histogram = histogram.groupBy(*keys.names, "_v").agg(F.sum("_n").alias("_n"))
    median = F.percentile(F.col("_v"), 0.5, F.col("_n"))
    agg = median if measure.agg == "median" else F.count("_v")
    return histogram.groupBy(*keys.names).agg(agg.alias(name))


def merge_metrics(keys: Sequence[str], parts: Sequence[DataFrame]) -> DataFrame:
    """Full outer merge on the group keys, where NULL is a group like any other."""
    if len(parts) == 1:
        return parts[0]
    values = [c for p in parts for c in p.columns if c not in keys]
    stacked = None
    for p in parts:
        stacked = p if stacked is None else stacked.unionByName(p, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def simple_metrics(
    w: Mapping[str, DataFrame],
    metrics: Mapping[str, Simple],
    group_by: Sequence[str] = (),
    grain: str | None = None,
    where: Column | None = None,
    slicers: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """Several simple metrics; those over the same rows are computed in one pass."""
    passes: dict[tuple[str, str | None], dict[str, Measure]] = {}
    parts: list[DataFrame] = []
    names: list[str] = []
    for name, metric in metrics.items():
        measure = MODELS[metric.model].measures[metric.measure]
        passes.setdefault((metric.model, metric.where), {})[name] = measure
    for (model_name, condition), measures in passes.items():
        model = MODELS[model_name]
        keys = resolve_keys(model, group_by, grain)
        names = keys.names
        if model_name == SNAPSHOTS and condition is None and where is None and all(
            m.agg == "count" or m.agg == "count_if" and m.expr in _SNAPSHOT_FLAGS for m in measures.values()
        ) and (counts := counted_snapshots(
            w, keys, slicers or {}, {m.expr for m in measures.values() if m.agg == "count_if"}
        )) is not None:
            parts.append(_counts(w, counts, keys, measures))
            continue
        df = w[model.mart]
        if condition is not None:
            df = df.where(condition)
        if where is not None:
            df = df.where(where)
        df = apply_slicers(w, model, df, slicers or {})
        sums = {n: m for n, m in measures.items() if m.agg not in ("median", "count_distinct")}
        if sums:
            parts.append(_sums(w, df, keys, sums))
        parts += [_values(w, df, keys, n, m) for n, m in measures.items() if n not in sums]
    return merge_metrics(names, parts)


def metric(
    w: Mapping[str, DataFrame],
    name: str,
    group_by: Sequence[str] = (),
    grain: str | None = None,
    where: Column | None = None,
    slicers: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """A named metric grouped as asked; the value column carries the metric's name.

    ``where`` is a condition on the fact's own columns, ``slicers`` a choice of values per
    dimension (own or linked).
    """
    spec = METRICS[name]
    if isinstance(spec, Simple):
        return simple_metrics(w, {name: spec}, group_by, grain, where, slicers)
    inputs = (spec.numerator, spec.denominator) if isinstance(spec, Ratio) else spec.inputs
    simple = {i: METRICS[i] for i in inputs}
    both = simple_metrics(w, simple, group_by, grain, where, slicers)
    combine = spec.combine if isinstance(spec, Derived) else ratio
    keys = [c for c in both.columns if c not in inputs]
    return both.select(*keys, combine(*[F.col(i) for i in inputs]).alias(name))


def measure(
    w: Mapping[str, DataFrame], model: str, name: str,
    group_by: Sequence[str] = (), grain: str | None = None,
) -> DataFrame:
    """A measure no metric is declared for."""
    return simple_metrics(w, {name: Simple(model, name)}, group_by, grain)


def fill_periods(
    df: DataFrame, spine: DataFrame, values: Sequence[str], key: str = TIME
) -> DataFrame:
    """One row per period of the spine, with 0 where the metric has none."""
    period = spine.columns[0]
    out = enrich(spine, df, (period, key), list(values))
    return out.select(
        F.col(period).alias(key), *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values]
    )
