"""Join operators. Everything is an equi-join; nothing here multiplies the fact rows as
long as the looked-up key is unique (``quality.checks`` tests that contract).

Scale rules
-----------
* No side is marked for broadcast. Adaptive execution broadcasts one when its measured size is
  under the session's threshold; otherwise the join is a shuffle join whose hot keys it splits.
* ``spread`` keeps the rows whose key is NULL from meeting in a single task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.clean import _c
from subscope.functions.flags import differs

_KEY = "_lookup_key"


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, without running it.

    None on a Spark Connect session, whose DataFrames do not expose a plan.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _taking(take: Sequence[str] | Mapping[str, str | Column]) -> dict[str, str | Column]:
    return dict(take) if isinstance(take, Mapping) else {c: c for c in take}


def _spread_nulls(key: str, spread: str) -> Column:
    return F.coalesce(F.col(key), F.concat(F.lit("~"), F.col(spread).cast("string")))


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    take: Sequence[str] | Mapping[str, str | Column] = (),
    flag: str | None = None,
    spread: str | None = None,
    when: str | None = None,
) -> DataFrame:
    """Left join ``fact`` to ``dim`` on (fact column, dim key).

    ``take`` names the dim columns to add (``{new: old}`` to rename), ``flag`` adds a
    has-a-match column. With ``spread`` (a well-distributed fact column) rows with a NULL
    key hash by that column instead of all to one partition. With ``when`` (a flag of the fact) other rows
    match nothing; lookups on one column with one ``spread`` then share the fact's shuffle.

    A lookup that adds only the flag asks for existence, so it runs against the distinct
    keys; Catalyst then also drops the join from plans that never use the flag.
    """
    fk, pk = on
    right = dim.select(
        F.col(pk).alias(_KEY),
        *[_c(c).alias(name) for name, c in _taking(take).items()],
    )
    if not take:
        right = right.distinct()
    matched = F.col(fk) == F.col(_KEY)
    if spread is not None:
        # The first equality decides the match; this one only varies the hash of NULLs.
        matched &= _spread_nulls(fk, spread) == F.col(_KEY)
    if when is not None:
        matched &= F.col(when)
    out = fact.join(right, matched, "left")
    if flag is not None:
        out = out.withColumn(flag, F.col(_KEY).isNotNull())
    return out.drop(_KEY)


def inner_match(fact: DataFrame, dim: DataFrame, on: tuple[str, str], take: Sequence[str]) -> DataFrame:
    """Inner counterpart of :func:`enrich`, for join-then-aggregate."""
    right = dim.select(F.col(on[1]).alias(_KEY), *[F.col(c).alias(c) for c in take])
    return fact.join(right, F.col(on[0]) == F.col(_KEY), "inner").drop(_KEY)


def with_match_flag(df: DataFrame, right_key: str, name: str) -> DataFrame:
    """Existence flag from the key column of an already joined right side."""
    return df.withColumn(name, F.col(right_key).isNotNull())


def polymorphic_lookup(
    df: DataFrame,
    type_col: str,
    id_col: str,
    kinds: Mapping[str, tuple[DataFrame, str, str]],
    name: str,
    self_kind: str | None = None,
    spread: str | None = None,
) -> DataFrame:
    """Resolve an id whose target table depends on a type column.

    ``kinds`` maps a type to (table, key, value). The tables are stacked into one lookup
    keyed by (type, id) and joined once, instead of once per type. For ``self_kind`` the
    id is already the value.
    """
    kind = F.lower(F.trim(F.col(type_col)))
    lookup = None
    for label, (table, pk, value) in kinds.items():
        part = table.select(
            F.lit(label).alias("_kind"),
            F.col(pk).alias("_id"),
            F.col(value).alias("_value"),
        )
        lookup = part if lookup is None else lookup.unionByName(part)
    matched = (kind == F.col("_kind")) & (F.col(id_col) == F.col("_id"))
    if spread is not None:
        matched &= _spread_nulls(id_col, spread) == F.col("_id")
    out = df.join(lookup, matched, "left")
    value = F.col("_value")
    if self_kind is not None:
        value = F.coalesce(F.when(kind == self_kind, F.col(id_col)), value)
    return out.withColumn(name, value).drop("_kind", "_id", "_value")


def resolve_sku(
    items: DataFrame, program_skus: DataFrame, bridge: DataFrame, masters: DataFrame, spread: str
) -> DataFrame:
    """Find an item's catalog entry over three paths, the first that knows an attribute wins:

    its own program SKU; the program SKU of its partner SKU; the master of its partner SKU.
    ``program_skus`` carries the attributes of the program SKU's master.
    """
    attrs = ("brand", "model", "memory", "color", "device_sku_key", "master_sku_id")
    # The bridge entries are completed first: they are far fewer than the items, and the
    # item table is then joined twice instead of four times.
    bridged = enrich(
        bridge.select("cp_sku_id", "program_sku_id", "master_sku_id"),
        program_skus, ("program_sku_id", "program_sku_id"),
        {f"p_{a}": a for a in attrs}, spread="cp_sku_id",
    )
    bridged = enrich(
        bridged, masters, ("master_sku_id", "master_sku_id"),
        {f"m_{a}": a for a in attrs}, spread="cp_sku_id",
    )
    path2 = {f"_b_{a}": F.coalesce(f"p_{a}", f"m_{a}") for a in attrs if a != "master_sku_id"}
    path2["_b_master_sku_id"] = F.coalesce("p_master_sku_id", "master_sku_id")
    path2["_b_program_sku_id"] = F.col("program_sku_id")

    out = enrich(
        items, program_skus, ("program_sku_id", "program_sku_id"),
        {f"_a_{a}": a for a in attrs}, flag="has_valid_program_sku", spread=spread,
    )
    out = enrich(
        out, bridged, ("cp_sku_id", "cp_sku_id"), path2, flag="has_valid_cp_sku", spread=spread
    )
    resolved = F.coalesce("program_sku_id", "_b_program_sku_id")
    known = F.coalesce(
        F.when(F.col("has_valid_program_sku"), F.col("program_sku_id")),
        F.col("_b_program_sku_id"),
    )
    found = {a: F.coalesce(f"_a_{a}", f"_b_{a}") for a in attrs}
    found["device_sku_key"] = F.coalesce(found["device_sku_key"], F.lit("sku_unknown"))
    out = out.withColumns({
        "resolved_program_sku_id": resolved,
        "has_valid_resolved_sku": resolved.isNotNull() & known.isNotNull(),
        **found,
    })
    return out.drop(*[c for c in out.columns if c.startswith(("_a_", "_b_"))])


def with_rollup(
    dim: DataFrame,
    facts: DataFrame,
    on: tuple[str, str],
    aggs: Mapping[str, Column],
    fill: Mapping[str, int] | None = None,
) -> DataFrame:
    """Aggregate the facts by key, then left join the rollup to the dimension.

    ``on`` is (dim key, fact key); NULL fact keys are dropped before the shuffle. ``fill``
    gives the value for dimension rows without facts.
    """
    fk = on[1]
    rolled = facts.where(F.col(fk).isNotNull()).groupBy(fk).agg(
        *[a.alias(n) for n, a in aggs.items()]
    )
    filled = {n: F.coalesce(F.col(n), F.lit(v)) for n, v in (fill or {}).items()}
    return enrich(dim, rolled, on, list(aggs)).withColumns(filled)


def merge_by_key(key: str, parts: Sequence[tuple[DataFrame, Mapping[str, int]]]) -> DataFrame:
    """Merge aggregates of several sources on one key: every key that occurs anywhere.

    Each part is (aggregate with unique keys, {value column: default}). The parts are
    stacked and grouped once, which replaces a distinct union plus a join per part. A NULL
    key keeps its row but matches nothing, so all of its values are defaults.
    """
    values = {c: d for _, cols in parts for c, d in cols.items()}
    stacked = None
    for df, cols in parts:
        types = {f.name: f.dataType for p, _ in parts for f in p.schema.fields}
        row = df.select(key, *[
            (F.col(c) if c in cols else F.lit(None).cast(types[c])).alias(c) for c in values
        ])
        stacked = row if stacked is None else stacked.unionByName(row)
    merged = stacked.groupBy(key).agg(*[F.max(c).alias(c) for c in values])
    return merged.select(key, *[
        F.coalesce(F.when(F.col(key).isNotNull(), F.col(c)), F.lit(d)).alias(c)
        for c, d in values.items()
    ])


RECONCILIATION = {  # status -> reason; fixed values
    "no_psp_reference": "CRM payment has no PSP payment_id reference",
    "missing_in_psp": "PSP payment record not found for CRM payment_id",
    "amount_mismatch": "CRM collected amount differs from PSP payment amount",
    "reconciled": None,
}


def reconcile(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    amounts: tuple[str, str],
    take: Sequence[str] | Mapping[str, str | Column],
    matched: str,
    status: str,
    reason: str,
    spread: str | None = None,
) -> DataFrame:
    """Match two systems on a reference, left grain; say how and why they disagree.

    ``amounts`` is (left amount, taken right amount); two NULL amounts agree.
    """
    out = enrich(left, right, on, take, flag=matched, spread=spread)
    names = list(RECONCILIATION)
    verdict = (
        F.when(F.col(on[0]).isNull() | (F.trim(F.col(on[0])) == ""), names[0])
        .when(~F.col(matched), names[1])
        .when(differs(*amounts), names[2])
        .otherwise(names[3])
    )
    why = F.create_map(*[
        F.lit(x) for n, r in RECONCILIATION.items() if r is not None for x in (n, r)
    ])
    return out.withColumn(status, verdict).withColumn(reason, F.try_element_at(why, F.col(status)))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows behind each.

    Counting per key comes first, so a hot key crosses the shuffle as one row per task.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("fk")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return keys.join(parent.select(F.col(pk).alias("pk")), F.col("fk") == F.col("pk"), "left_anti")


def slice_by(df: DataFrame, dim: DataFrame, predicate: Column, on: tuple[str, str]) -> DataFrame:
    """Restrict facts to the dimension rows a slicer selects."""
    chosen = dim.where(predicate).select(F.col(on[1]).alias(_KEY))
    return df.join(chosen, F.col(on[0]) == F.col(_KEY), "left_semi")


def match_rate(left: DataFrame, right: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Share of left references that exist on the right."""
    hit = enrich(
        left.where(F.col(on[0]).isNotNull()).select(on[0]),
        right, on, flag="_hit",
    )
    return hit.agg(
        F.count(F.lit(1)).alias("reference_count"),
        F.count_if("_hit").alias("matched_count"),
        F.try_divide(F.count_if("_hit").cast("double"), F.count(F.lit(1)).cast("double"))
        .alias("match_rate"),
    )
