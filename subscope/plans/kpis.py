"""The 29 named KPIs of the report layer.

Several carry the same title as a metric and are defined differently on purpose (see the
README); nothing here reuses the metric definitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.dates import whole_days
from subscope.functions.ratios import ratio, ratio_or_zero
from subscope.operators.aggs import count_rows, count_where, distinct_where, exact_median, mean, sum_where
from subscope.operators.distinct_states import count_state, dictionary, distinct_state
from subscope.plans.metrics import SNAPSHOTS, apply_slicers, counted_snapshots, join_keys, resolve_keys
from subscope.plans.semantics import MODELS

Aggregate = Callable[[], Column]


@dataclass(frozen=True)
class Kpi:
    """A KPI that is one aggregate expression over the rows of one mart."""

    model: str
    value: Aggregate


def _c(name: str) -> Column:
    return F.col(name)



_ELIGIBLE, _LIMITED = "is_gmv_eligible", "subscription_limit"

KPIS: dict[str, Kpi] = {
    "orders": Kpi("orders", lambda: count_where(_ELIGIBLE)),
    "gmv_sar": Kpi("orders", lambda: sum_where("gmv_amount_sar", _ELIGIBLE)),
    "preorder_share": Kpi("orders", lambda: ratio_or_zero(
        count_where(_c(_ELIGIBLE) & _c("is_preorder")), count_where(_ELIGIBLE)
    )),
    "avg_days_payment_to_delivery": Kpi("orders", lambda: mean(F.when(
        _c(_ELIGIBLE), whole_days("first_paid_at", "delivered_at")
    ))),
    "order_items": Kpi("order_items", count_rows),
    "subscriptions": Kpi("subscriptions", count_rows),
    "active_subscriptions": Kpi("subscriptions", lambda: count_where("is_active_subscription")),
    "mrr_sar": Kpi("subscriptions", lambda: sum_where(
        "monthly_recurring_amount_sar", "is_mrr_eligible"
    )),
    "avg_subscription_term_months": Kpi("subscriptions", lambda: mean(
        F.when(_c("is_mrr_eligible"), _c("subscription_term_months"))
    )),
    "collected_revenue_sar": Kpi("payments", lambda: sum_where(
        "collected_amount_sar", "is_collected"
    )),
    "invoiced_revenue_sar": Kpi("invoices", lambda: sum_where("invoice_amount_sar", "is_paid")),
    "finance_variance_sar": Kpi(
        "finance_reconciliation_monthly", lambda: F.sum("finance_variance_sar")
    ),
    "payment_failure_rate": Kpi("payment_attempts", lambda: ratio_or_zero(
        count_where(_c("is_recurring_installment") & _c("is_failed_attempt")),
        count_where("is_recurring_installment"),
    )),
    "customers_on_retry": Kpi("payment_attempts", lambda: distinct_where(
        "customer_id", "is_outstanding_retry_failure"
    )),
    "refund_amount_sar": Kpi("refunds", lambda: F.sum("refund_amount_sar")),
    "credit_notes": Kpi("credit_notes", count_rows),
    "credit_note_value_sar": Kpi("credit_notes", lambda: F.sum("credit_value_sar")),
    "verified_customers": Kpi("customers", lambda: count_where("is_fully_verified")),
    # customers without a device count as 0
    "avg_devices_per_customer": Kpi("customers", lambda: mean("device_count")),
    # mean of the programs' ratios, not the ratio of their sums
    "program_subscription_utilization": Kpi("programs", lambda: mean_of_ratios(
        "utilization_subscription_count", _LIMITED
    )),
    "expired_payment_methods": Kpi("payment_methods", lambda: count_where("is_expired")),
    "partner_api_failure_rate": Kpi("partner_api_events", lambda: ratio_or_zero(
        count_where("is_failure"), count_rows()
    )),
    "partner_api_failures": Kpi("partner_api_events", lambda: sum_where(
        "failure_count", "is_failure"
    )),
    "programs_over_limit": Kpi("programs", lambda: count_where("is_over_subscription_limit")),
    "disabled_programs": Kpi("programs", lambda: count_where("is_disabled_program")),
}


def mean_of_ratios(num: str, den: str) -> Column:
    """Average of num/den over the rows where den is positive.

    The ratios are summed in decimal, so the result does not depend on row order.
    """
    each = F.when(_c(den) > 0, F.try_divide(
        _c(num).cast("decimal(18,0)"), _c(den).cast("decimal(18,0)")
    ).cast("decimal(28,9)"))
    return F.try_divide(F.sum(each).cast("double"), F.count(each).cast("double"))


def _rows(w, model_name: str, group_by: Sequence[str], slicers) -> tuple[DataFrame, list[str]]:
    model = MODELS[model_name]
    keys = resolve_keys(model, group_by, None)
    df = apply_slicers(w, model, w[model.mart], slicers or {})
    df = df.withColumns({n: c for n, c in keys.own.items() if n not in df.columns})
    return join_keys(w, df, keys), keys.names


def kpi(
    w: Mapping[str, DataFrame],
    name: str,
    group_by: Sequence[str] = (),
    slicers: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """A KPI, optionally by dimension and under slicers; the column carries its name."""
    if name in SPECIAL:
        return SPECIAL[name](w, name, group_by, slicers)
    return kpis(w, [name], group_by, slicers)


def kpis(
    w: Mapping[str, DataFrame],
    names: Sequence[str],
    group_by: Sequence[str] = (),
    slicers: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """Several KPIs of one mart in one pass."""
    models = {KPIS[n].model for n in names}
    if len(models) > 1:
        raise ValueError(f"the KPIs {list(names)} come from different marts: {sorted(models)}")
    df, keys = _rows(w, models.pop(), group_by, slicers)
    return df.groupBy(*keys).agg(*[KPIS[n].value().alias(n) for n in names])


def _median_delivery(w, name, group_by, slicers) -> DataFrame:
    """Median whole days from order to delivery, over all delivered orders."""
    df, keys = _rows(w, "orders", group_by, slicers)
    return exact_median(df, keys, whole_days("order_date", "delivered_at"), name)


QUARTER = "snapshot_quarter"


def _quarter_rate(happened: Callable[[], Column], flag: str):
    def evaluate(w, name, group_by, slicers) -> DataFrame:
        """Events of one quarter over subscriptions active at its start.

        The quarter is the one selected, by slicer or by grouping; otherwise the latest
        that the remaining selection has. Counting per quarter and keeping the latest
        takes one pass, over counts by month where no snapshots are written (``flag`` is the
        count of ``happened``).
        """
        chosen = dict(slicers or {})
        selected = chosen.pop(QUARTER, ())
        if len(selected) == 1:
            chosen[QUARTER] = selected
        resolved = resolve_keys(MODELS[SNAPSHOTS], group_by, None)
        counts = counted_snapshots(w, resolved, chosen, {flag, "is_active_at_quarter_start"})
        if counts is not None:
            keys, level = resolved.names, dict.fromkeys([*resolved.first_level, QUARTER])
            partial = counts.groupBy(*level).agg(
                F.sum(flag).alias("_events"), F.sum("is_active_at_quarter_start").alias("_base"))
            per_quarter = join_keys(w, partial, resolved).groupBy(*dict.fromkeys([*keys, QUARTER])).agg(
                F.sum("_events").alias("_events"), F.sum("_base").alias("_base"))
        else:
            df, keys = _rows(w, SNAPSHOTS, group_by, chosen)
            per_quarter = df.groupBy(*dict.fromkeys([*keys, QUARTER])).agg(
                count_where(happened()).alias("_events"),
                count_where("is_active_at_quarter_start").alias("_base"),
            )
        latest = [F.max_by(c, QUARTER).alias(c) for c in ("_events", "_base")]
        if QUARTER in keys:
            scoped = per_quarter
        else:
            scoped = per_quarter.groupBy(*keys).agg(*latest)
        return scoped.select(*keys, ratio_or_zero("_events", "_base").alias(name))

    return evaluate


def _outstanding(w, name, group_by, slicers) -> DataFrame:
    """Distinct customers with an unpaid invoice or an outstanding retry failure.

    An invoice without a known payment state counts as unpaid here.
    """
    owing, keys = _rows(w, "invoices", group_by, slicers)
    owing = owing.where(~F.coalesce("is_paid", F.lit(False)))
    retry, _ = _rows(w, "payment_attempts", group_by, slicers)
    retry = retry.where("is_outstanding_retry_failure")
    cols = [*keys, "customer_id"]
    both = owing.select(*cols).union(retry.select(*cols)).where(F.col("customer_id").isNotNull())
    return both.groupBy(*keys).agg(F.count_distinct("customer_id").alias(name))


def outstanding_state(
    w: Mapping[str, DataFrame], keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """Which customers owe, per channel partner, as mergeable bitmaps.

    ``outstanding_from`` answers any roll-up of partners from it; the invoices and attempts are read once.
    """
    cols = ("channel_partner_id", "customer_id")
    owing = w["fct_invoices"].where(~F.coalesce("is_paid", F.lit(False))).select(*cols)
    retry = w["fct_payment_attempts"].where("is_outstanding_retry_failure").select(*cols)
    facts = keep(owing.union(retry).where(F.col("customer_id").isNotNull()).distinct())
    return keep(distinct_state(facts, ["channel_partner_id"], "customer_id", dictionary(facts, "customer_id", keep)))


def outstanding_from(
    w: Mapping[str, DataFrame], state: DataFrame, group_by: Sequence[str] = ()
) -> DataFrame:
    """``customers_with_outstanding_payments`` by dimensions of the channel partner, from states alone."""
    keys = resolve_keys(MODELS["invoices"], group_by, None)
    if keys.own or not set(keys.links) <= {"channel_partner_id"}:
        raise KeyError(f"the state knows partners only, not {list(group_by)}")
    return count_state(join_keys(w, state, keys), keys.names, "customers_with_outstanding_payments")


SPECIAL = {
    "median_order_to_delivery_days": _median_delivery,
    "churn_rate": _quarter_rate(lambda: _c("is_churned"), "is_churned"),
    "upgrade_rate": _quarter_rate(
        lambda: _c("is_upgraded") | _c("is_kifed"), "is_upgraded_or_kifed"),
    "customers_with_outstanding_payments": _outstanding,
}

ALL_KPIS = (*KPIS, *SPECIAL)


def share_of_total(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Each group's share of the total, one row that is joined to the finished aggregate."""
    total = df.agg(F.sum(measure).alias("_total"))  # one row
    return df.crossJoin(F.broadcast(total)).withColumn(name, ratio(measure, "_total")).drop("_total")
