"""Metrics, KPIs, report datasets, quality and profiling."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from subscope.operators.joins import match_rate
from subscope.plans import kpis, metrics, reports
from subscope.plans.semantics import METRICS, MODELS, Simple
from subscope.quality import checks, contracts, profile
from subscope.schemas import RAW_TABLES, TableSpec, raw_schema
from subscope.sources.calendar import spine_of
from workload.base import query

PARTNER, PROGRAM = reports.PARTNER, reports.PROGRAM

# How each model's metrics are grouped when registered: dimensions and time grain.
METRIC_VIEWS: dict[str, tuple[tuple[str, ...], str | None]] = {
    "orders": ((PARTNER, "sales_channel"), "quarter"),
    "order_items": (("brand", PROGRAM), None),
    "customers": (("customer_verification_segment", "corporate_company__company_name"), None),
    "programs": ((PARTNER,), None),
    "subscriptions": ((PROGRAM,), "quarter"),
    "subscription_monthly_snapshots": ((PARTNER,), "quarter"),
    "payments": ((PROGRAM,), "month"),
    "payment_attempts": ((PARTNER, "customer__customer_verification_segment"), None),
    "psp_transactions": (("transaction_outcome_segment",), "week"),
    "payment_methods": (("payment_method_source",), "year"),
    "invoices": ((PARTNER,), "quarter"),
    "credit_notes": ((PROGRAM,), None),
    "finance_reconciliation_monthly": ((), "month"),
    "devices": (("brand", PARTNER), None),
    "partner_api_events": ((PARTNER,), "day"),
    "refunds": ((PARTNER,), "year"),
}
# Input metrics from two models: only what both can be grouped by.
CROSS_MODEL = {"customers_with_outstanding_payments": ((PARTNER,), "quarter")}


def model_of(name: str) -> str:
    spec = METRICS[name]
    if isinstance(spec, Simple):
        return spec.model
    first = getattr(spec, "numerator", None) or spec.inputs[0]
    return model_of(first)


def view_of(name: str) -> tuple[tuple[str, ...], str | None]:
    return CROSS_MODEL.get(name) or METRIC_VIEWS[model_of(name)]


for _i, _name in enumerate(METRICS, 1):
    _by, _grain = view_of(_name)
    query(f"metric_{_name}", f"ME{_i}")(
        lambda w, n=_name, by=_by, grain=_grain: metrics.metric(w, n, by, grain)
    )


@query("metrics_in_one_pass", "M1", "M4", "M6", "M8")
def _(w):
    names = ("orders_total_count", "preorder_order_count")
    return metrics.simple_metrics(w, {n: METRICS[n] for n in names}, ["order_status"], "month")


@query("metric_ratio_unsliced", "M2")
def _(w):
    return metrics.metric(w, "preorder_order_share")


@query("metric_derived_by_time", "M3", "J12")
def _(w):
    return metrics.metric(w, "customers_with_outstanding_payments", grain="month")


@query("metric_by_linked_dimension", "M5")
def _(w):
    return metrics.metric(w, "gmv_sar", ["customer__customer_verification_segment"])


@query("metric_filled_periods", "M7")
def _(w):
    gmv = metrics.metric(w, "gmv_sar", grain="day")
    span = w["fct_orders"].agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    spine = spine_of(span, F.col("lo"), F.date_add("hi", 1))
    return metrics.fill_periods(gmv, spine, ["gmv_sar"])


@query("metric_filtered_and_sliced", "M9")
def _(w):
    return metrics.metric(
        w, "order_count", ["order_type"], where=F.col("gmv_amount_sar") > 50000,
        slicers={PARTNER: ["ASIA", "AMERICA"]},
    )


UNUSED_MEASURES = {
    "customers_total_count": "customers", "total_device_count": "customers",
    "programs_total_count": "programs", "avg_program_utilization_pct": "programs",
    "snapshot_subscriptions_count": "subscription_monthly_snapshots",
    "duration_term_months_avg": "subscription_durations",
    "payment_methods_total_count": "payment_methods",
    "collected_revenue_monthly_total": "finance_reconciliation_monthly",
    "invoiced_revenue_monthly_total": "finance_reconciliation_monthly",
}
for _name, _model in UNUSED_MEASURES.items():
    query(f"measure_{_name}", "M1")(
        lambda w, n=_name, m=_model: metrics.measure(w, m, n, grain="year")
    )

# Inventory order, which numbers the KPIs.
KPI_IDS = (
    "orders gmv_sar preorder_share avg_days_payment_to_delivery median_order_to_delivery_days "
    "order_items subscriptions active_subscriptions mrr_sar avg_subscription_term_months "
    "churn_rate upgrade_rate collected_revenue_sar invoiced_revenue_sar finance_variance_sar "
    "payment_failure_rate customers_on_retry refund_amount_sar credit_notes "
    "credit_note_value_sar verified_customers avg_devices_per_customer "
    "program_subscription_utilization customers_with_outstanding_payments "
    "expired_payment_methods partner_api_failure_rate partner_api_failures "
    "programs_over_limit disabled_programs"
).split()
assert set(KPI_IDS) == set(kpis.ALL_KPIS)
for _i, _name in enumerate(KPI_IDS, 1):
    query(f"kpi_{_name}", f"KP{_i}", "A14")(lambda w, n=_name: kpis.kpi(w, n))


@query("kpi_churn_rate_by_quarter", "KP11")
def _(w):
    return kpis.kpi(w, "churn_rate", ["snapshot_quarter"])


@query("kpi_upgrade_rate_by_partner", "KP12")
def _(w):
    return kpis.kpi(w, "upgrade_rate", [PARTNER])


@query("kpi_outstanding_by_partner", "KP24")
def _(w):
    return kpis.kpi(w, "customers_with_outstanding_payments", [PARTNER])


REPORTS = {
    "report_sales_gmv_by_partner": (reports.gmv_by_partner, "R1"),
    "report_sales_gmv_by_date": (reports.gmv_by_date, "R2"),
    "report_sales_gmv_date_drill": (reports.gmv_date_drill, "R2"),
    "report_sales_items_by_brand": (reports.items_by_brand, "R3"),
    "report_sales_items_by_partner_device": (reports.items_by_partner_and_device, "R4"),
    "report_sales_top_models_by_partner": (reports.top_models_by_partner, "O2"),
    "report_subscriptions_mrr_by_program": (reports.mrr_by_program, "R5"),
    "report_subscriptions_by_status": (reports.subscriptions_by_status, "R6"),
    "report_subscriptions_by_partner": (reports.subscriptions_by_partner, "R7"),
    "report_finance_by_month": (reports.finance_by_month, "R8"),
    "report_executive_finance": (lambda w: reports.finance_by_month(w, variance=False), "R8"),
    "report_finance_refunds_by_partner": (reports.refunds_by_partner, "R9"),
    "report_finance_credit_notes_by_partner": (reports.credit_notes_by_partner, "R10"),
    "report_customers_verified_by_company": (reports.verified_customers_by_company, "R11"),
    "report_customers_utilization_by_program": (reports.utilization_by_program, "R12"),
    "report_operations_delivery_days_by_partner": (reports.delivery_days_by_partner, "R13"),
    "report_operations_api_failures_by_partner": (reports.api_failure_rate_by_partner, "R14"),
    "report_operations_program_limits": (reports.program_limits, "R15"),
    "orders_by_partner_program_month": (reports.orders_by_partner_program_month, "M1"),
}
for _name, (_build, _id) in REPORTS.items():
    query(_name, _id)(lambda w, b=_build: b(w))

for _slicer in reports.SLICERS:
    query(f"report_slicer_{_slicer}", "R16")(lambda w, s=_slicer: reports.slicer_values(w, s))


@query("report_sales_sliced", "R16", "J14")
def _(w):
    return reports.gmv_by_partner(w, {PROGRAM: ["NATION_1", "NATION_7"]})


# --- quality --------------------------------------------------------------------------


def raw_tables(w):
    """Raw tables as their database compares them: trailing blanks of CHAR columns do not count."""
    def char(df):
        return df.withColumns({c: F.rtrim(c) for c, kind in df.dtypes if kind == "string"})

    return {t: char(w.raw(t)) for t in RAW_TABLES}


def _raw_checks(kind):
    return [c for c in contracts.raw_checks() if c.kind == kind]


for _kind, _id in (
    (checks.NOT_NULL, "Q1"), (checks.UNIQUE, "Q2"), (checks.RELATIONSHIPS, "Q3"),
    (checks.ACCEPTED, "Q4"),
):
    query(f"quality_{_kind}", _id, "Q8")(
        lambda w, k=_kind: checks.run_checks(raw_tables(w), _raw_checks(k))
    )


@query("quality_unique_combination", "Q5")
def _(w):
    return checks.dq_unique_combination(
        w["fct_subscription_monthly_snapshots"], ["subscription_id", "snapshot_month"]
    )


@query("quality_duplicates_found", "Q5")
def _(w):
    """A combination that does repeat."""
    return checks.dq_unique_combination(w["stg_order_items"], ["order_id", "product_type"])


@query("quality_conditional", "Q6", "Q7")
def _(w):
    lots = [
        c for c in contracts.checks_of(contracts.STAGED)
        if c.table in ("stg_psp_transactions", "stg_orders", "stg_payment_history")
    ]
    return checks.run_checks(w, lots)


@query("quality_from_contract", "Q9")
def _(w):
    spec = TableSpec(
        "stg_subscriptions", ("subscription_id",),
        (("order_id", "stg_orders", "order_id"), ("customer_id", "stg_accounts", "customer_id")),
        (("subscription_status", ("active", "cancelled", "upgraded")),),
        ("channel_partner_id",), warn=("order_id",),
    )
    return checks.run_checks(w, checks.checks_from_spec(spec))


@query("quality_sales_marts", "Q2", "Q3")
def _(w):
    lots = [c for c in contracts.checks_of(contracts.MARTS) if c.table in ("fct_orders", "dim_programs")]
    return checks.run_checks(w, lots)


for _layer, _specs in (("staged", contracts.STAGED), ("conformed", contracts.CONFORMED), ("marts", contracts.MARTS)):
    query(f"quality_{_layer}", "Q1", "Q2", "Q3", "Q4", "Q5")(
        lambda w, s=_specs: checks.run_checks(w, contracts.checks_of(s))
    )


@query("quality_tolerated_orphans", "Q3", "Q7")
def _(w):
    """Orphans up to a tolerated share: one check passes, one does not."""
    lost = checks.Check(checks.RELATIONSHIPS, "stg_orders", ("customer_id",), parent="stg_accounts",
                        parent_key="customer_id", max_ratio=0.5)
    return checks.run_checks(w, [lost, replace(lost, table="stg_payments", columns=("order_id",), parent="stg_orders",
                                               parent_key="order_id", max_ratio=0.0001)])


@query("kpi_upgrade_rate_by_quarter", "KP12")
def _(w):
    return kpis.kpi(w, "upgrade_rate", ["snapshot_quarter"])


# --- profiling ------------------------------------------------------------------------


@query("profile_tables", "D1")
def _(w):
    out = None
    for t in RAW_TABLES:
        at = next((f.name for f in raw_schema(t) if f.name.endswith("deleted_at")), None)
        one = profile.profile_table(w.raw(t), "id", deleted_at=at).withColumn("table_name", F.lit(t))
        out = one if out is None else out.unionByName(one)
    return out


@query("profile_status_values", "D2")
def _(w):
    return profile.value_counts(w.raw("crm_subscriptions"), "subscription_status")


@query("profile_orphans", "D3")
def _(w):
    s = w
    return profile.orphan_report([
        ("orders -> customers", s["stg_orders"], "customer_id", s["stg_accounts"], "customer_id"),
        ("items -> orders", s["stg_order_items"], "order_id", s["stg_orders"], "order_id"),
        ("items -> program skus", s["stg_order_items"], "program_sku_id",
         s["stg_program_skus"], "program_sku_id"),
        ("subscriptions -> customers", s["stg_subscriptions"], "customer_id",
         s["stg_accounts"], "customer_id"),
        ("payments -> orders", s["stg_payments"], "order_id", s["stg_orders"], "order_id"),
        ("payments -> psp", s["stg_payments"], "psp_payment_id",
         s["stg_psp_payments"], "psp_payment_id"),
    ])


@query("profile_null_rates", "D4")
def _(w):
    return profile.null_rates(w["stg_payment_history"].drop("_etl_synced_at", "_etl_source_system"))


@query("profile_match_rate", "D5")
def _(w):
    return match_rate(w["stg_payments"], w["stg_psp_payments"], ("psp_payment_id", "psp_payment_id"))


assert set(METRIC_VIEWS) <= set(MODELS)
