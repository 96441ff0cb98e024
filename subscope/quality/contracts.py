"""Declared contracts of the raw, staged, conformed and mart tables."""

from __future__ import annotations

from subscope.quality.checks import ACCEPTED, ERROR, NOT_NULL, RELATIONSHIPS, Check, checks_from_spec, relax
from subscope.schemas import TableSpec


def _spec(
    name: str, pk: str, fks: str = "", accepted: dict[str, str] | None = None,
    not_null: str = "", where: dict[str, str] | None = None, warn: str = "",
) -> TableSpec:
    """``fks`` lists ``column>table`` or ``column>table.key``; the key defaults to the
    column. ``accepted`` maps a column to its values, comma-separated."""
    links = []
    for link in fks.split():
        col, parent = link.split(">")
        table, _, key = parent.partition(".")
        links.append((col, table, key or col))
    return TableSpec(
        name, tuple(pk.split()), tuple(links),
        tuple((c, tuple(v.split(","))) for c, v in (accepted or {}).items()),
        tuple(not_null.split()), tuple((where or {}).items()), tuple(warn.split()),
    )


_ORDER_STATUS = "cancelled,delivered,expired,rejected,waiting_for_delivery"
_PAYMENT_STATUS = "cancelled,failed,not_invoiced,paid,refunded"
_PROCESS = "completed,failed,in_progress,queued"
_REQUEST = "authorized,failed,internal_error,required_authentication,success,voided"

RAW = [
    _spec("crm_accounts", "id", "corporate_company_id>crm_corporate_company.id"),
    _spec("crm_channel_partners", "id", accepted={"channel_partner_type": "ecommerce,Retailer"}),
    _spec("crm_programs", "id", "channel_partner_id>crm_channel_partners.id",
          {"program_status": "ACTIVE"}, "channel_partner_id"),
    _spec("crm_orders", "id",
          "customer_id>crm_accounts.id programs_order_id>crm_programs.id "
          "payment_method_id>crm_payment_methods.id",
          {"order_status": _ORDER_STATUS, "order_type": "order,pre-order"}, "programs_order_id",
          {"order_type": "order_type is not null"}),
    _spec("crm_order_items", "id",
          "order_id>crm_orders.id program_sku_id>crm_program_skus.id customer_id>crm_accounts.id",
          not_null="order_id"),
    _spec("crm_subscriptions", "id",
          "order_item_id>crm_order_items.id subscription_pricing_id>crm_subscription_pricing.id "
          "channel_partner_id>crm_channel_partners.id order_id>crm_orders.id "
          "customer_id>crm_accounts.id",
          {"subscription_status": "Active,Cancelled,Upgraded,Waiting_For_Delivery"},
          "channel_partner_id order_id"),
    _spec("crm_devices", "id", "order_item_id>crm_order_items.id"),
    _spec("crm_payments", "id", "payment_id>payments_payments.id order_id>crm_orders.id",
          {"payment_status": _PAYMENT_STATUS}, "order_id"),
    _spec("crm_payment_history", "id", "payment_id>crm_payments.id",
          {"status": "Approved,failed,paid,Paid,success"}),
    _spec("crm_cp_skus", "id",
          "channel_partner_id>crm_channel_partners.id program_sku_id>crm_program_skus.id",
          not_null="channel_partner_id"),
    _spec("crm_subscription_pricing", "id",
          "program_sku_id>crm_program_skus.id "
          "subscription_durations_id>crm_subscription_durations.id"),
    _spec("crm_subscription_durations", "id", "channel_partners_id>crm_channel_partners.id",
          not_null="channel_partners_id"),
    _spec("crm_corporate_company", "id"),
    _spec("crm_master_skus", "id"),
    _spec("crm_program_skus", "id", "master_skus_id>crm_master_skus.id", not_null="master_skus_id"),
    _spec("crm_aos_invoices", "id", "billing_account_id>crm_accounts.id",
          {"invoice_status": "paid,unpaid"}),
    _spec("crm_invoice_line_items", "id", "subscriptions_id>crm_subscriptions.id"),
    _spec("crm_credit_notes", "id"),
    _spec("crm_addresses", "id"),
    _spec("crm_payment_methods", "id"),
    _spec("crm_countries", "id"),
    _spec("crm_api_logs", "id", accepted={"status": "failure,success"}),
    _spec("crm_devices_journey", "id"),
    _spec("payments_payments", "id",
          "subscriber_id>payments_subscribers.id subscription_id>payments_subscriptions.id",
          not_null="subscriber_id"),
    _spec("payments_transactions", "id", "subscriber_id>payments_subscribers.id",
          {"process_status": _PROCESS, "request_status": _REQUEST}, "subscriber_id",
          {"request_status": "request_status is not null"}),
    _spec("payments_refunds", "id", accepted={"status": "Approved"}),
    _spec("payments_subscribers", "id"),
    _spec("payments_subscriptions", "id"),
    _spec("payments_payment_methods", "id"),
]

_CUST, _CP, _PG = "customer_id>stg_accounts", "channel_partner_id>stg_channel_partners", "program_id>stg_programs"

STAGED = [
    _spec("stg_accounts", "customer_id",
          f"corporate_company_id>stg_corporate_companies {_CP} {_PG}"),
    _spec("stg_invoices", "invoice_id",
          f"billing_account_id>stg_accounts.customer_id {_CUST} {_CP} {_PG}",
          {"invoice_status": "paid,unpaid"}),
    _spec("stg_addresses", "address_id", _CUST),
    _spec("stg_api_logs", "api_log_id", accepted={"api_status": "failure,success"}),
    _spec("stg_channel_partners", "channel_partner_id", "country_id>stg_countries",
          {"partner_type": "ecommerce,retailer"}),
    _spec("stg_corporate_companies", "corporate_company_id", _CP),
    _spec("stg_countries", "country_id"),
    _spec("stg_cp_skus", "cp_sku_id",
          f"{_CP} program_sku_id>stg_program_skus master_sku_id>stg_master_skus"),
    _spec("stg_credit_notes", "credit_note_id", "invoice_id>stg_invoices"),
    _spec("stg_devices", "device_id",
          "order_item_id>stg_order_items program_sku_id>stg_program_skus"),
    _spec("stg_devices_journey", "device_journey_id", "device_id>stg_devices"),
    _spec("stg_invoice_line_items", "invoice_line_item_id",
          "subscription_id>stg_subscriptions order_item_id>stg_order_items", warn="order_item_id"),
    _spec("stg_master_skus", "master_sku_id"),
    _spec("stg_order_items", "order_item_id",
          f"order_id>stg_orders program_sku_id>stg_program_skus cp_sku_id>stg_cp_skus {_CUST}"),
    _spec("stg_orders", "order_id", f"{_CUST} {_PG} payment_method_id>stg_payment_methods",
          {"order_status": _ORDER_STATUS, "order_type": "order,pre-order,unknown"}),
    _spec("stg_payment_history", "payment_history_id",
          "payment_id>stg_payments payment_method_id>stg_payment_methods",
          {"payment_attempt_status": "approved,failed,paid,success"},
          warn="payment_id payment_method_id"),
    _spec("stg_payment_methods", "payment_method_id", _CUST, warn="customer_id"),
    _spec("stg_payments", "payment_id",
          "psp_payment_id>stg_psp_payments order_id>stg_orders invoice_id>stg_invoices "
          f"{_CUST} subscription_id>stg_subscriptions",
          {"payment_status": _PAYMENT_STATUS}, warn="psp_payment_id"),
    _spec("stg_programs", "program_id", _CP, {"program_status": "active"}),
    _spec("stg_subscription_durations", "subscription_duration_id", f"{_PG} {_CP}"),
    _spec("stg_subscription_pricing", "subscription_pricing_id",
          "program_sku_id>stg_program_skus subscription_duration_id>stg_subscription_durations"),
    _spec("stg_subscriptions", "subscription_id",
          f"subscription_pricing_id>stg_subscription_pricing {_CP} {_CUST} order_id>stg_orders "
          "order_item_id>stg_order_items "
          "upgraded_subscription_id>stg_subscriptions.subscription_id",
          {"subscription_status": "active,cancelled,upgraded,waiting_for_delivery"},
          warn="order_id"),
    _spec("stg_program_skus", "program_sku_id", "master_sku_id>stg_master_skus"),
    _spec("stg_psp_payment_methods", "psp_payment_method_id",
          "subscriber_id>stg_psp_subscribers", warn="subscriber_id"),
    _spec("stg_psp_payments", "psp_payment_id",
          "subscriber_id>stg_psp_subscribers psp_subscription_id>stg_psp_subscriptions",
          warn="subscriber_id psp_subscription_id"),
    _spec("stg_psp_refunds", "refund_record_id", accepted={"refund_status": "approved"}),
    _spec("stg_psp_subscribers", "subscriber_id",
          "default_payment_method_id>stg_psp_payment_methods.psp_payment_method_id",
          warn="default_payment_method_id"),
    _spec("stg_psp_subscriptions", "psp_subscription_id",
          "subscriber_id>stg_psp_subscribers", warn="subscriber_id"),
    _spec("stg_psp_transactions", "transaction_id", "subscriber_id>stg_psp_subscribers",
          {"process_status": _PROCESS, "request_status": _REQUEST},
          where={"request_status": "request_status is not null and request_status != ''"},
          warn="subscriber_id"),
]

CONFORMED = [
    _spec("int_channel_partners", "channel_partner_id"),
    _spec("int_customers", "customer_id"),
    _spec("int_device_skus", "program_sku_id"),
    _spec("int_programs", "program_id"),
    _spec("int_orders", "order_id"),
    _spec("int_order_items", "order_item_id"),
    _spec("int_subscriptions", "subscription_id"),
    _spec("int_devices", "device_id"),
    _spec("int_subscription_snapshots_monthly", "subscription_id snapshot_month"),
    _spec("int_customer_device_counts", "customer_id"),
    _spec("int_payments_crm", "payment_id"),
    _spec("int_payments_psp", "psp_payment_id"),
    _spec("int_payments_unified", "payment_id", accepted={
        "psp_reconciliation_status": "no_psp_reference,missing_in_psp,amount_mismatch,reconciled"
    }),
    _spec("int_payment_attempts", "payment_history_id"),
    _spec("int_invoices", "invoice_id"),
    _spec("int_invoice_line_items", "invoice_line_item_id"),
    _spec("int_credit_notes", "credit_note_id"),
    _spec("int_refunds", "refund_dedup_key"),
    _spec("int_finance_reconciliation", "reconciliation_month"),
    _spec("int_partner_api_events", "api_log_id"),
]

_C, _P, _G = "customer_id>dim_customers", "channel_partner_id>dim_channel_partners", "program_id>dim_programs"
_ORD, _SUB = "order_id>fct_orders", "subscription_id>fct_subscriptions"

MARTS = [
    _spec("fct_orders", "order_id", f"{_C} {_G} {_P}"),
    _spec("fct_order_items", "order_item_id",
          f"{_ORD} {_C} {_G} {_P} master_sku_id>dim_device_skus"),
    _spec("dim_customers", "customer_id", "corporate_company_id>dim_corporate_companies"),
    _spec("dim_channel_partners", "channel_partner_id"),
    _spec("dim_programs", "program_id", _P),
    _spec("dim_corporate_companies", "corporate_company_id"),
    _spec("dim_device_skus", "master_sku_id"),
    _spec("dim_dates", "date_key"),
    _spec("fct_subscriptions", "subscription_id",
          f"{_C} {_ORD} {_P} {_G} subscription_pricing_id>dim_subscription_pricing",
          where={"order_id": "has_valid_order = true"}),
    _spec("fct_subscription_monthly_snapshots", "subscription_id snapshot_month",
          f"{_SUB} {_P} {_G}"),
    _spec("dim_subscription_pricing", "subscription_pricing_id"),
    _spec("dim_subscription_durations", "subscription_duration_id", f"{_G} {_P}"),
    _spec("fct_payments", "payment_id",
          f"{_ORD} invoice_id>fct_invoices {_C} {_SUB} {_G} {_P}"),
    _spec("fct_payment_attempts", "payment_history_id",
          f"payment_id>fct_payments {_ORD} {_C} {_G} {_P}",
          where={"payment_id": "has_valid_payment = true"}),
    _spec("fct_psp_transactions", "transaction_id"),
    _spec("dim_payment_methods", "payment_method_key"),
    _spec("fct_invoices", "invoice_id", f"{_C} {_P} {_G}"),
    _spec("fct_invoice_line_items", "invoice_line_item_id",
          f"invoice_id>fct_invoices {_SUB} {_C}"),
    _spec("fct_credit_notes", "credit_note_id", f"invoice_id>fct_invoices {_C} {_P} {_G}"),
    _spec("fct_finance_reconciliation_monthly", "reconciliation_month"),
    _spec("fct_devices", "device_id",
          f"order_item_id>fct_order_items {_ORD} {_C} {_SUB} {_G} {_P}"),
    _spec("fct_device_journey_events", "device_journey_id",
          f"device_id>fct_devices {_ORD} {_C} {_SUB}"),
    _spec("fct_partner_api_events", "api_log_id", _P),
    _spec("bridge_cp_skus", "cp_sku_id", f"{_P} master_sku_id>dim_device_skus"),
    _spec("fct_refunds", "refund_id", f"{_C} {_ORD} {_P} {_G}"),
]


def checks_of(specs: list[TableSpec]) -> list[Check]:
    return [c for s in specs for c in checks_from_spec(s)]


def raw_checks() -> list[Check]:
    """Source checks: only uniqueness is an error, the rest are known gaps of the source."""
    return relax(checks_of(RAW), (NOT_NULL, RELATIONSHIPS, ACCEPTED))


def all_checks() -> list[Check]:
    return [*raw_checks(), *checks_of(STAGED), *checks_of(CONFORMED), *checks_of(MARTS)]


def gate(checks: list[Check]) -> list[Check]:
    """The checks whose failure should stop a run."""
    return [c for c in checks if c.severity == ERROR]
