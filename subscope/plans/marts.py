"""Marts: 14 facts, 10 dimensions and a bridge, each a projection or rollup of the
conformed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.functions.dates import calendar_columns
from subscope.functions.flags import all_flags, indicator, segment
from subscope.functions.ratios import rate
from subscope.operators.aggs import count_rows, count_where, mean, sum_where
from subscope.operators.joins import enrich, with_rollup
from subscope.operators.sets import conform_union, dedup_first
from subscope.plans.conform import _without


def _day(c: str):
    return F.to_date(F.col(c))


# --- sales ---------------------------------------------------------------------------


def fct_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", _day("created_at").alias("order_date"), "customer_id", "program_id",
        "channel_partner_id", "order_number", "order_status", "order_type", "sales_channel",
        "delivered_at", "first_paid_at", "is_preorder", "is_voided", "is_gmv_eligible",
        "has_valid_customer", "has_valid_program", "gmv_amount_sar", "total_discount_amount",
        "total_amount_incl_vat",
    )


def fct_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        "order_item_id", "order_id", "customer_id", "program_id", "channel_partner_id",
        "master_sku_id", F.col("resolved_program_sku_id").alias("program_sku_id"),
        "device_sku_key", _day("created_at").alias("order_item_date"), "quantity",
        "unit_price_vat_inclusive", "total_price_vat_inclusive",
        "device_purchase_price_vat_inclusive", "discount_amount", "product_type",
        "order_line_item_type", "brand", "model", "memory", "color", "has_valid_order",
        "has_valid_resolved_sku",
    )


def dim_customers(customers: DataFrame, device_counts: DataFrame) -> DataFrame:
    out = enrich(
        customers, device_counts, ("customer_id", "customer_id"),
        ["device_count", "first_device_purchase_date", "latest_device_delivery_date"],
    )
    nafath, mobile = F.col("is_nafath_verified"), F.col("is_mobile_verified")
    return out.withColumns({
        "device_count": F.coalesce("device_count", F.lit(0)),
        "customer_verification_segment": segment([
            (F.col("is_fully_verified"), "fully_verified"),
            (nafath & ~mobile, "nafath_only"),
            (mobile & ~nafath, "mobile_only"),
        ], "unverified"),
    })


def dim_channel_partners(partners: DataFrame, api_events: DataFrame) -> DataFrame:
    out = with_rollup(
        partners, api_events, ("channel_partner_id", "channel_partner_id"),
        {
            "api_call_count": count_rows(),
            "api_failure_count": count_where("is_failure"),
            "partner_api_failure_rate": rate(count_where("is_failure"), count_rows()),
        },
        fill={"api_call_count": 0, "api_failure_count": 0},
    )
    return out.withColumn("partner_operations_segment", segment([
        (F.col("partner_api_failure_rate") > 0, "elevated_api_failures"),
        (F.col("api_call_count") == 0, "no_api_activity"),
    ], "healthy_api_performance"))


def dim_programs(programs: DataFrame) -> DataFrame:
    return programs.withColumn("program_limit_segment", segment([
        (F.col("is_disabled_program"), "disabled"),
        (F.col("is_over_subscription_limit"), "over_subscription_limit"),
        (F.col("is_fnf_program"), "fnf_pending_rules"),
    ], "within_limit"))


def dim_corporate_companies(companies: DataFrame, customers: DataFrame) -> DataFrame:
    out = with_rollup(
        _without(companies), customers, ("corporate_company_id", "corporate_company_id"),
        {
            "verified_customer_count": count_where("is_fully_verified"),
            "customer_count": count_rows(),
        },
        fill={"verified_customer_count": 0, "customer_count": 0},
    )
    return out.withColumn("cep_verification_segment", segment([
        (F.col("verified_customer_count") > 0, "has_verified_customers"),
        (F.col("customer_count") > 0, "has_unverified_customers"),
    ], "no_customers"))


def dim_device_skus(masters: DataFrame, items: DataFrame) -> DataFrame:
    out = with_rollup(
        _without(masters), items, ("master_sku_id", "master_sku_id"),
        {
            "order_item_count": count_rows(),
            "units_ordered": F.sum("quantity"),
            "order_item_revenue_sar": F.sum("total_price_vat_inclusive"),
        },
        fill={"order_item_count": 0, "units_ordered": 0, "order_item_revenue_sar": 0},
    )
    return out.withColumn(
        "sku_sales_segment", segment([(F.col("order_item_count") > 0, "sold")], "not_sold")
    )


def dim_dates(spine: DataFrame, weekend: tuple[int, ...] = (0, 6)) -> DataFrame:
    day = F.col("date_day")
    return spine.select(
        day.alias("date_key"),
        day.alias("full_date"),
        *[c.alias(n) for n, c in calendar_columns(day, weekend).items()],
    )


# --- subscriptions -------------------------------------------------------------------


def fct_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select(
        "subscription_id", "customer_id", "order_id", "order_item_id", "channel_partner_id",
        "program_id", "subscription_pricing_id", _day("created_at").alias("subscription_date"),
        "subscription_status", "service_started_at", "service_ended_at",
        "subscription_close_date", "is_active_subscription", "is_mrr_eligible", "is_churned",
        "is_upgraded", "is_kifed", "is_upgraded_or_kifed", "has_valid_subscription_pricing",
        "has_valid_order", "has_valid_customer",
        F.col("monthly_subscription_amount_sar").alias("monthly_recurring_amount_sar"),
        "subscription_term_months",
    )


def fct_subscription_monthly_snapshots(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        "subscription_id", "snapshot_month", "snapshot_quarter", "channel_partner_id",
        "program_id", "subscription_status", "service_started_at", "service_ended_at",
        "subscription_close_date", "monthly_subscription_amount_sar", "is_mrr_eligible",
        F.col("is_active_at_month_end").alias("is_active"), "is_active_at_quarter_start",
        F.col("is_churned_in_month").alias("is_churned"),
        F.col("is_upgraded_in_month").alias("is_upgraded"),
        F.col("is_kifed_in_month").alias("is_kifed"),
    )


def dim_subscription_pricing(pricing: DataFrame, subscriptions: DataFrame) -> DataFrame:
    out = with_rollup(
        _without(pricing),
        subscriptions.select(
            "subscription_pricing_id", "is_mrr_eligible",
            F.col("monthly_subscription_amount_sar").alias("_amount"),
        ),
        ("subscription_pricing_id", "subscription_pricing_id"),
        {
            "mrr_eligible_subscription_count": count_where("is_mrr_eligible"),
            "total_mrr_sar": sum_where("_amount", "is_mrr_eligible"),
        },
        fill={"mrr_eligible_subscription_count": 0, "total_mrr_sar": 0},
    )
    return out.withColumn("pricing_utilization_segment", segment([
        (F.col("mrr_eligible_subscription_count") > 0, "active_pricing"),
        (F.col("subscription_pricing_status") == "active", "active_unused"),
    ], "inactive"))


def dim_subscription_durations(durations: DataFrame, subscriptions: DataFrame) -> DataFrame:
    out = with_rollup(
        _without(durations), subscriptions,
        ("subscription_duration_id", "subscription_duration_id"),
        {
            "subscription_count": count_rows(),
            "mrr_eligible_subscription_count": count_where("is_mrr_eligible"),
            "avg_subscription_term_months": mean("subscription_term_months"),
        },
        fill={"subscription_count": 0, "mrr_eligible_subscription_count": 0},
    )
    return out.withColumn("duration_utilization_segment", segment([
        (F.col("mrr_eligible_subscription_count") > 0, "in_use"),
        (F.col("duration_status") == "active", "available"),
    ], "inactive"))


# --- payments ------------------------------------------------------------------------


def fct_payments(unified: DataFrame) -> DataFrame:
    return unified.select(
        "payment_id", "order_id", "invoice_id", "customer_id", "subscription_id", "program_id",
        "channel_partner_id", "psp_payment_id", _day("created_at").alias("payment_date"),
        "payment_timestamp", "paid_at", "payment_status", "payment_type", "refund_status",
        "is_collected", "is_failed", "is_refunded", "has_valid_order", "has_valid_customer",
        "is_psp_reconciled", "psp_reconciliation_status", "reconciliation_gap_reason",
        "collected_amount_sar", "refund_amount_sar", "psp_payment_amount",
    )


def fct_payment_attempts(attempts: DataFrame) -> DataFrame:
    return attempts.select(
        "payment_history_id", "payment_id", "payment_method_id", "order_id", "customer_id",
        "program_id", "channel_partner_id", _day("attempted_at").alias("attempt_date"),
        "payment_attempt_status", "error_code", "error_reason", "card_last_four",
        "expiry_month", "expiry_year", "action", "funding_type", "is_successful_attempt",
        "is_failed_attempt", "is_recurring_installment", "has_valid_payment",
        "psp_reconciliation_status", "psp_is_retry_queue",
        all_flags("is_failed_attempt", "psp_is_retry_queue")
        .alias("is_outstanding_retry_failure"),
    )


def fct_psp_transactions(transactions: DataFrame, psp_payments: DataFrame) -> DataFrame:
    """Transaction with the first of the payments that claim it."""
    claimed = dedup_first(
        psp_payments.where(F.col("transaction_id").isNotNull()).select(
            "transaction_id", "psp_payment_id", "payment_amount", "psp_subscription_id"
        ),
        ["transaction_id"], ["psp_payment_id"],
    )
    out = enrich(
        transactions.select(
            "transaction_id", "subscriber_id", "payment_intent_id",
            _day("created_at").alias("transaction_date"), "process_status", "request_status",
            "transaction_type", "is_scheduled", "is_successful", "is_retry_queue",
        ),
        claimed, ("transaction_id", "transaction_id"),
        ["psp_payment_id", "payment_amount", "psp_subscription_id"],
    )
    return out.withColumn("transaction_outcome_segment", segment([
        (F.col("is_successful"), "successful"),
        (F.col("is_retry_queue"), "retry_queue"),
    ], "failed"))


PAYMENT_METHOD_SCHEMA = {
    "payment_method_key": "string", "payment_method_id": "string",
    "psp_payment_method_id": "string", "customer_id": "string", "subscriber_id": "string",
    "payment_method_name": "string", "payment_method_status": "string",
    "payment_method_type": "string", "card_last_four": "string", "expiry_year": "int",
    "expiry_month": "int", "is_default": "boolean", "card_brand": "string",
    "funding_type": "string", "is_expired": "boolean", "created_at": "timestamp",
    "updated_at": "timestamp",
}


def dim_payment_methods(crm: DataFrame, psp: DataFrame) -> DataFrame:
    out = conform_union(
        {
            "crm": crm.withColumn("payment_method_key", F.col("payment_method_id")),
            "psp": psp.withColumns({
                "payment_method_key": F.col("psp_payment_method_id"),
                "payment_method_status": segment([(F.col("is_enabled"), "active")], "disabled"),
                "payment_method_type": F.col("payment_gateway"),
                "card_brand": F.col("payment_gateway"),
                "is_default": F.lit(False),
            }),
        },
        PAYMENT_METHOD_SCHEMA, "payment_method_source",
    )
    return out.withColumn("payment_method_health_segment", segment([
        (F.col("is_expired"), "expired"),
        (F.col("payment_method_status").isin("active", "enabled"), "active"),
    ], "inactive"))


# --- finance -------------------------------------------------------------------------


def fct_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        "invoice_id", "customer_id", "channel_partner_id", "program_id", "billing_account_id",
        "invoice_date", "invoice_due_date", "settlement_date", "invoice_status",
        "zoho_invoice_number", "is_paid", "has_valid_customer", "invoice_amount_sar",
        "vat_amount_sar", "amount_ex_vat_sar",
    )


def fct_invoice_line_items(lines: DataFrame) -> DataFrame:
    return lines.select(
        "invoice_line_item_id", "invoice_id", "subscription_id", "order_item_id", "customer_id",
        "invoice_date", "invoice_status", "is_paid", "has_valid_invoice",
        "has_valid_subscription", "quantity", "product_type", "line_amount_sar",
        "line_amount_ex_vat_sar", "vat_amount_sar", "line_amount_incl_vat_sar",
    )


def fct_credit_notes(notes: DataFrame) -> DataFrame:
    """A credit note has no amount of its own: its value is the whole invoice."""
    amount = F.col("invoice_amount_sar")
    return notes.select(
        "credit_note_id", "invoice_id", "customer_id", "channel_partner_id", "program_id",
        _day("created_at").alias("credit_note_date"), "zoho_credit_note_id", "zoho_status",
        "credit_note_zoho_url", "has_valid_invoice",
        amount.alias("related_invoice_amount_sar"), amount.alias("credit_value_sar"),
    )


def fct_refunds(refunds: DataFrame) -> DataFrame:
    return refunds.select(
        F.col("refund_dedup_key").alias("refund_id"), "refund_event_id", "refund_source",
        "refund_amount_sar", _day("refunded_at").alias("refund_date"), "refunded_at",
        "customer_id", "order_id", "channel_partner_id", "program_id", "partner_name",
    )


def fct_finance_reconciliation_monthly(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.select(
        "reconciliation_month", "collected_revenue_sar", "invoiced_revenue_sar",
        "finance_variance_sar", "collected_payment_count", "paid_invoice_count",
        "unpaid_invoice_amount_sar", "crm_refund_amount_sar", "credit_note_count",
    )


# --- fulfillment and operations --------------------------------------------------------


def fct_devices(devices: DataFrame) -> DataFrame:
    return devices.select(
        "device_id", "order_item_id", "order_id", "customer_id", "subscription_id",
        "program_id", "channel_partner_id", "program_sku_id", "purchase_date", "delivery_date",
        "brand", "model", "device_memory", "color", "device_type", "device_condition",
        "has_valid_order_item", "has_valid_subscription", "is_active_subscription",
        "purchase_price",
    )


def fct_device_journey_events(journey: DataFrame, devices: DataFrame) -> DataFrame:
    return enrich(
        journey.select(
            "device_journey_id", "device_id", "movement_date", "device_movement",
            F.col("created_at").alias("event_recorded_at"),
        ),
        devices, ("device_id", "device_id"),
        [
            "order_item_id", "order_id", "customer_id", "subscription_id", "program_id",
            "channel_partner_id",
        ],
        flag="has_valid_device", spread="device_journey_id",
    )


def fct_partner_api_events(events: DataFrame) -> DataFrame:
    return events.select(
        "api_log_id", "channel_partner_id", _day("created_at").alias("event_date"),
        "api_status", "api_source", "parent_type", "parent_id", "error_details", "is_failure",
        "has_partner_attribution", indicator("is_failure").alias("failure_count"),
    )


def bridge_cp_skus(cp_skus: DataFrame, device_skus: DataFrame, partners: DataFrame) -> DataFrame:
    out = enrich(
        _without(cp_skus), partners, ("channel_partner_id", "channel_partner_id"),
        ["partner_name", "partner_type"], flag="has_valid_channel_partner", spread="cp_sku_id",
    )
    return enrich(
        out, device_skus, ("program_sku_id", "program_sku_id"),
        ["brand", "model", "memory", "color", "device_sku_key", "master_sku_name"],
        flag="has_valid_program_sku", spread="cp_sku_id",
    )
