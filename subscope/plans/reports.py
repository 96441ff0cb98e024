"""Datasets behind the report visuals: a KPI by dimension, in display order.

Facts that match no partner, program or company stay as one group with NULL.
Slicers are passed through to the KPI.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.operators.aggs import count_rows, date_rollup, distinct_values, sum_where
from subscope.operators.joins import enrich
from subscope.operators.sets import ranked, top_k_per_group
from subscope.plans.kpis import kpi, kpis, share_of_total
from subscope.plans.metrics import simple_metrics
from subscope.plans.semantics import METRICS

Marts = Mapping[str, DataFrame]
Slicers = Mapping[str, Sequence[object]] | None

PARTNER = "channel_partner__partner_name"
PROGRAM = "program__program_name"
COMPANY = "corporate_company__company_name"
NAMES = {PARTNER: "partner_name", PROGRAM: "program_name", COMPANY: "company_name"}


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in NAMES.items() if k in df.columns})


def _by(w: Marts, names: Sequence[str], key: str, slicers: Slicers) -> DataFrame:
    df = kpi(w, names[0], [key], slicers) if len(names) == 1 else kpis(w, names, [key], slicers)
    return ranked(_named(df), names[0], NAMES.get(key, key))


def gmv_by_partner(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["gmv_sar"], PARTNER, slicers)


def gmv_by_date(w: Marts, slicers: Slicers = None) -> DataFrame:
    return kpi(w, "gmv_sar", ["order_date"], slicers).orderBy("order_date")


def gmv_date_drill(w: Marts) -> DataFrame:
    """GMV on every level of the date hierarchy (level 0 total to 4 day)."""
    return date_rollup(
        w["fct_orders"], "order_date",
        {"orders": F.count_if("is_gmv_eligible"),
         "gmv_sar": sum_where("gmv_amount_sar", "is_gmv_eligible")},
    )


def items_by_brand(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["order_items"], "brand", slicers)


def items_by_partner_and_device(w: Marts, slicers: Slicers = None) -> DataFrame:
    keys = ["partner_name", "brand", "memory", "color"]
    df = _named(kpi(w, "order_items", [PARTNER, *keys[1:]], slicers))
    return ranked(df, "order_items", *keys)


def top_models_by_partner(w: Marts, k: int = 3) -> DataFrame:
    """The k best-selling device models of each partner."""
    items = enrich(
        w["fct_order_items"], w["dim_channel_partners"],
        ("channel_partner_id", "channel_partner_id"), ["partner_name"],
    )
    return top_k_per_group(items, ["partner_name"], ["brand", "model"], count_rows(), "order_items", k)


def mrr_by_program(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["mrr_sar"], PROGRAM, slicers)


def subscriptions_by_status(w: Marts, slicers: Slicers = None) -> DataFrame:
    df = kpi(w, "subscriptions", ["subscription_status"], slicers)
    return ranked(share_of_total(df, "subscriptions", "share"), "subscriptions", "subscription_status")


def subscriptions_by_partner(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["subscriptions"], PARTNER, slicers)


def finance_by_month(w: Marts, variance: bool = True) -> DataFrame:
    """Collected and invoiced revenue per month; the executive page leaves out the variance."""
    cols = ["collected_revenue_sar", "invoiced_revenue_sar"]
    cols += ["finance_variance_sar"] if variance else []
    month = "reconciliation_month"
    return w["fct_finance_reconciliation_monthly"].select(month, *cols).orderBy(month)


def refunds_by_partner(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["refund_amount_sar"], PARTNER, slicers)


def credit_notes_by_partner(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["credit_notes", "credit_note_value_sar"], PARTNER, slicers)


def verified_customers_by_company(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["verified_customers"], COMPANY, slicers)


def utilization_by_program(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["program_subscription_utilization"], "program_name", slicers)


def delivery_days_by_partner(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["median_order_to_delivery_days"], PARTNER, slicers)


def api_failure_rate_by_partner(w: Marts, slicers: Slicers = None) -> DataFrame:
    return _by(w, ["partner_api_failure_rate"], PARTNER, slicers)


def program_limits(w: Marts) -> DataFrame:
    return w["dim_programs"].groupBy(
        "program_name", "partner_name", "is_over_subscription_limit"
    ).agg(
        F.sum("subscription_limit").alias("subscription_limit"),
        F.sum("utilization_subscription_count").alias("utilization_subscription_count"),
    )


SLICERS = {
    "partner": ("dim_channel_partners", "partner_name"),
    "program": ("dim_programs", "program_name"),
    "subscription_status": ("fct_subscriptions", "subscription_status"),
    "quarter": ("fct_subscription_monthly_snapshots", "snapshot_quarter"),
    "company": ("dim_corporate_companies", "company_name"),
}


def slicer_values(w: Marts, slicer: str) -> DataFrame:
    """Values to choose from, in order."""
    mart, col = SLICERS[slicer]
    return distinct_values(w[mart], [col]).orderBy(F.asc_nulls_first(col))


def orders_by_partner_program_month(w: Marts) -> DataFrame:
    """Eligible orders and GMV by partner, program and month: the flagship dataset."""
    names = ("order_count", "gmv_sar")
    df = simple_metrics(w, {n: METRICS[n] for n in names}, [PARTNER, PROGRAM], "month")
    return _named(df)
