"""The semantic layer as plain data: 24 models over the marts and 45 metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

from subscope.functions.ratios import ratio


@dataclass(frozen=True)
class Measure:
    """``agg`` is sum, count, count_if, average, median or count_distinct."""

    agg: str
    expr: str = "1"


@dataclass(frozen=True)
class SemanticModel:
    mart: str
    primary: str
    key: str
    time: str
    dimensions: tuple[str, ...]
    foreign: Mapping[str, str] = field(default_factory=dict)
    measures: Mapping[str, Measure] = field(default_factory=dict)


@dataclass(frozen=True)
class Simple:
    model: str
    measure: str
    where: str | None = None


@dataclass(frozen=True)
class Ratio:
    numerator: str
    denominator: str


@dataclass(frozen=True)
class Derived:
    inputs: tuple[str, ...]
    combine: Callable[..., Column]


Metric = Simple | Ratio | Derived

ROWS = Measure("count")


def _if(p: str) -> Measure:
    return Measure("count_if", p)


def _fk(*entities: str, **named: str) -> dict[str, str]:
    return {**{e: f"{e}_id" for e in entities}, **named}


# Delivery days count from the order date in this layer (the KPI layer starts at payment).
DELIVERY_DAYS = "datediff(delivered_at, order_date)"

MODELS: dict[str, SemanticModel] = {
    "orders": SemanticModel(
        "fct_orders", "order", "order_id", "order_date",
        ("order_status", "order_type", "sales_channel", "is_preorder", "is_voided",
         "is_gmv_eligible", "has_valid_customer", "delivered_at"),
        _fk("customer", "program", "channel_partner"),
        {
            "orders_total_count": ROWS,
            "gmv_eligible_order_count": _if("is_gmv_eligible"),
            "preorder_order_count": _if("is_preorder"),
            "gmv_amount_total": Measure("sum", "gmv_amount_sar"),
            "days_order_to_delivery": Measure("average", DELIVERY_DAYS),
            "median_days_order_to_delivery": Measure("median", DELIVERY_DAYS),
        },
    ),
    "order_items": SemanticModel(
        "fct_order_items", "order_item", "order_item_id", "order_item_date",
        ("brand", "model", "memory", "color", "product_type"),
        _fk("order", "customer", "program", "channel_partner", device_sku="master_sku_id"),
        {"order_items_total_count": ROWS},
    ),
    "customers": SemanticModel(
        "dim_customers", "customer", "customer_id", "created_at",
        ("is_nafath_verified", "is_mobile_verified", "is_fully_verified",
         "customer_verification_segment", "corporate_company_id"),
        _fk("corporate_company", "channel_partner", "program"),
        {
            "customers_total_count": ROWS,
            "verified_customers_count": _if("is_fully_verified"),
            "total_device_count": Measure("sum", "device_count"),
        },
    ),
    "channel_partners": SemanticModel(
        "dim_channel_partners", "channel_partner", "channel_partner_id", "created_at",
        ("partner_name", "partner_type", "partner_status"),
    ),
    "programs": SemanticModel(
        "dim_programs", "program", "program_id", "created_at",
        ("program_name", "program_status", "is_fnf_program", "is_over_subscription_limit",
         "is_disabled_program", "program_limit_segment"),
        _fk("channel_partner"),
        {
            "programs_total_count": ROWS,
            "programs_over_limit_count_measure": _if("is_over_subscription_limit"),
            "utilization_subscription_total": Measure("sum", "utilization_subscription_count"),
            "subscription_limit_total": Measure("sum", "subscription_limit"),
            "avg_program_utilization_pct":
                Measure("average", "program_subscription_utilization_pct"),
        },
    ),
    "corporate_companies": SemanticModel(
        "dim_corporate_companies", "corporate_company", "corporate_company_id", "created_at",
        ("company_name", "cep_verification_segment"),
    ),
    "device_skus": SemanticModel(
        "dim_device_skus", "device_sku", "master_sku_id", "created_at",
        ("brand", "model", "memory", "color"),
    ),
    "dates": SemanticModel(
        "dim_dates", "date", "date_key", "full_date",
        ("year_month", "year_quarter", "is_weekend"),
    ),
    "subscriptions": SemanticModel(
        "fct_subscriptions", "subscription", "subscription_id", "subscription_date",
        ("subscription_status", "is_active_subscription", "is_mrr_eligible", "is_churned",
         "is_upgraded", "is_kifed", "is_upgraded_or_kifed"),
        _fk("customer", "order", "channel_partner", "program"),
        {
            "subscriptions_total_count": ROWS,
            "active_subscriptions_count": _if("is_active_subscription"),
            "upgraded_subscriptions_count": _if("is_upgraded_or_kifed"),
            "mrr_amount_total": Measure("sum", "monthly_recurring_amount_sar"),
            "subscription_term_months_avg": Measure("average", "subscription_term_months"),
        },
    ),
    "subscription_monthly_snapshots": SemanticModel(
        "fct_subscription_monthly_snapshots", "subscription_snapshot",
        "concat(subscription_id, '-', cast(snapshot_month as string))", "snapshot_month",
        ("snapshot_quarter", "subscription_status", "is_active", "is_active_at_quarter_start",
         "is_churned", "is_upgraded", "is_kifed"),
        _fk("subscription", "channel_partner", "program"),
        {
            "snapshot_subscriptions_count": ROWS,
            "churned_in_month_count": _if("is_churned"),
            "active_at_month_end_count": _if("is_active"),
            "active_at_quarter_start_count": _if("is_active_at_quarter_start"),
        },
    ),
    "subscription_pricing": SemanticModel(
        "dim_subscription_pricing", "subscription_pricing", "subscription_pricing_id",
        "created_at", ("subscription_pricing_status",),
    ),
    "subscription_durations": SemanticModel(
        "dim_subscription_durations", "subscription_duration", "subscription_duration_id",
        "created_at", ("duration_months",), _fk("program", "channel_partner"),
        {"duration_term_months_avg": Measure("average", "duration_months")},
    ),
    "payments": SemanticModel(
        "fct_payments", "payment", "payment_id", "payment_date",
        ("payment_status", "is_collected", "is_failed", "is_refunded", "is_psp_reconciled"),
        _fk("order", "customer", "invoice", "subscription", "program", "channel_partner"),
        {"collected_amount_total": Measure("sum", "collected_amount_sar")},
    ),
    "payment_attempts": SemanticModel(
        "fct_payment_attempts", "payment_attempt", "payment_history_id", "attempt_date",
        ("payment_attempt_status", "is_successful_attempt", "is_failed_attempt",
         "is_recurring_installment"),
        _fk("payment", "order", "customer", "program", "channel_partner"),
        {
            "payment_attempts_total_count": ROWS,
            "failed_payment_attempts_count": _if("is_failed_attempt"),
            "recurring_payment_attempts_total_count": _if("is_recurring_installment"),
            "recurring_failed_payment_attempts_count":
                _if("is_recurring_installment and is_failed_attempt"),
            # no failure condition here: every customer with an attempt counts
            "customers_with_failed_attempts_count": Measure("count_distinct", "customer_id"),
        },
    ),
    "psp_transactions": SemanticModel(
        "fct_psp_transactions", "psp_transaction", "transaction_id", "transaction_date",
        ("is_retry_queue", "is_successful", "transaction_outcome_segment"),
        _fk("subscriber"),
        {
            "subscribers_on_retry_count":
                Measure("count_distinct", "case when is_retry_queue then subscriber_id end"),
        },
    ),
    "payment_methods": SemanticModel(
        "dim_payment_methods", "payment_method", "payment_method_key", "created_at",
        ("payment_method_source", "is_expired", "payment_method_health_segment"),
        _fk("customer", "subscriber"),
        {
            "payment_methods_total_count": ROWS,
            "expired_payment_methods_count": _if("is_expired"),
        },
    ),
    "invoices": SemanticModel(
        "fct_invoices", "invoice", "invoice_id", "invoice_date",
        ("invoice_status", "is_paid"), _fk("customer", "program", "channel_partner"),
        {
            "invoice_amount_total": Measure("sum", "invoice_amount_sar"),
            "customers_with_unpaid_invoices_count":
                Measure("count_distinct", "case when not is_paid then customer_id end"),
        },
    ),
    "invoice_line_items": SemanticModel(
        "fct_invoice_line_items", "invoice_line_item", "invoice_line_item_id", "invoice_date",
        ("product_type",), _fk("invoice", "subscription", "customer"),
    ),
    "credit_notes": SemanticModel(
        "fct_credit_notes", "credit_note", "credit_note_id", "credit_note_date",
        ("zoho_status",), _fk("invoice", "customer", "channel_partner", "program"),
        {"credit_notes_total_count": ROWS},
    ),
    "finance_reconciliation_monthly": SemanticModel(
        "fct_finance_reconciliation_monthly", "reconciliation_month_entity",
        "reconciliation_month", "reconciliation_month", (), {},
        {
            "collected_revenue_monthly_total": Measure("sum", "collected_revenue_sar"),
            "invoiced_revenue_monthly_total": Measure("sum", "invoiced_revenue_sar"),
            "finance_variance_monthly_total": Measure("sum", "finance_variance_sar"),
        },
    ),
    "devices": SemanticModel(
        "fct_devices", "device", "device_id", "purchase_date", ("brand", "model"),
        _fk("order_item", "order", "customer", "subscription", "program", "channel_partner"),
        {
            "devices_total_count": ROWS,
            "customers_with_devices_count": Measure("count_distinct", "customer_id"),
        },
    ),
    "device_journey_events": SemanticModel(
        "fct_device_journey_events", "device_journey_event", "device_journey_id",
        "movement_date", ("device_movement",), _fk("device", "order", "customer"),
    ),
    "partner_api_events": SemanticModel(
        "fct_partner_api_events", "api_event", "api_log_id", "event_date",
        ("api_status", "is_failure"), _fk("channel_partner"),
        {
            "api_events_total_count": ROWS,
            "api_failure_events_count": _if("is_failure"),
        },
    ),
    "refunds": SemanticModel(
        "fct_refunds", "refund", "refund_id", "refund_date", ("refund_source",),
        _fk("customer", "order", "channel_partner", "program"),
        {"refund_amount_total": Measure("sum", "refund_amount_sar")},
    ),
}

_O, _S, _SN = "orders", "subscriptions", "subscription_monthly_snapshots"
_PA, _PR, _API = "payment_attempts", "programs", "partner_api_events"

METRICS: dict[str, Metric] = {
    "order_count": Simple(_O, "gmv_eligible_order_count", "is_gmv_eligible"),
    "gmv_sar": Simple(_O, "gmv_amount_total", "is_gmv_eligible"),
    "preorder_order_share": Ratio("preorder_order_count", "orders_total_count"),
    "preorder_order_count": Simple(_O, "preorder_order_count"),
    "orders_total_count": Simple(_O, "orders_total_count"),
    "avg_days_payment_to_delivery": Simple(
        _O, "days_order_to_delivery", "is_gmv_eligible and delivered_at is not null"
    ),
    "median_order_to_delivery_days": Simple(
        _O, "median_days_order_to_delivery", "delivered_at is not null"
    ),
    "order_item_count": Simple("order_items", "order_items_total_count"),
    "subscription_count": Simple(_S, "subscriptions_total_count"),
    "active_subscription_count": Simple(
        _S, "active_subscriptions_count", "is_active_subscription"
    ),
    "mrr_sar": Simple(_S, "mrr_amount_total", "is_mrr_eligible"),
    "avg_subscription_term_months": Simple(
        _S, "subscription_term_months_avg", "is_mrr_eligible"
    ),
    "churn_rate": Derived(
        ("churned_subscriptions_in_quarter", "active_subscriptions_at_quarter_start"), ratio
    ),
    "churned_subscriptions_in_quarter": Simple(_SN, "churned_in_month_count"),
    "active_subscriptions_at_quarter_start": Simple(_SN, "active_at_quarter_start_count"),
    "churned_subscriptions_in_month": Simple(_SN, "churned_in_month_count"),
    "active_subscriptions_at_month_end": Simple(_SN, "active_at_month_end_count"),
    "upgrade_rate": Ratio("upgraded_subscription_count", "subscription_count"),
    "upgraded_subscription_count": Simple(_S, "upgraded_subscriptions_count"),
    "collected_revenue_sar": Simple("payments", "collected_amount_total", "is_collected"),
    "invoiced_revenue_sar": Simple("invoices", "invoice_amount_total", "is_paid"),
    "finance_variance_sar": Simple(
        "finance_reconciliation_monthly", "finance_variance_monthly_total"
    ),
    "payment_failure_rate": Ratio(
        "recurring_failed_payment_attempts", "recurring_payment_attempts_total"
    ),
    "recurring_failed_payment_attempts": Simple(_PA, "recurring_failed_payment_attempts_count"),
    "recurring_payment_attempts_total": Simple(_PA, "recurring_payment_attempts_total_count"),
    "failed_payment_attempts": Simple(_PA, "failed_payment_attempts_count"),
    "payment_attempts_total": Simple(_PA, "payment_attempts_total_count"),
    "customers_on_retry_count": Simple("psp_transactions", "subscribers_on_retry_count"),
    "refund_amount_sar": Simple("refunds", "refund_amount_total"),
    "credit_note_count": Simple("credit_notes", "credit_notes_total_count"),
    "verified_customer_count": Simple(
        "customers", "verified_customers_count", "is_fully_verified"
    ),
    "avg_devices_per_customer": Derived(("devices_total", "customers_with_devices"), ratio),
    "devices_total": Simple("devices", "devices_total_count"),
    "customers_with_devices": Simple("devices", "customers_with_devices_count"),
    "program_subscription_utilization_pct": Ratio(
        "program_utilization_subscriptions", "program_subscription_limits"
    ),
    "program_utilization_subscriptions": Simple(_PR, "utilization_subscription_total"),
    "program_subscription_limits": Simple(_PR, "subscription_limit_total"),
    "expired_payment_method_count": Simple(
        "payment_methods", "expired_payment_methods_count", "is_expired"
    ),
    # Sums two distinct counts, so a customer in both counts twice.
    "customers_with_outstanding_payments": Derived(
        ("customers_unpaid_invoices", "customers_failed_payment_attempts"), lambda a, b: a + b
    ),
    "customers_unpaid_invoices": Simple("invoices", "customers_with_unpaid_invoices_count"),
    "customers_failed_payment_attempts": Simple(_PA, "customers_with_failed_attempts_count"),
    "partner_api_failure_rate": Ratio("partner_api_failures", "partner_api_calls_total"),
    "partner_api_failures": Simple(_API, "api_failure_events_count"),
    "partner_api_calls_total": Simple(_API, "api_events_total_count"),
    "programs_over_limit_count": Simple(
        _PR, "programs_over_limit_count_measure", "is_over_subscription_limit"
    ),
}


def model_of_entity(entity: str) -> str:
    """The semantic model whose primary entity this is."""
    for name, model in MODELS.items():
        if model.primary == entity:
            return name
    raise KeyError(f"no semantic model has the primary entity {entity!r}")
