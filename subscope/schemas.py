"""Declared schemas of the 29 raw tables: only the columns the pipeline reads.

CRM tables share an identity/audit head and an ingestion tail; PSP (payment service)
tables share the tail. ``numeric`` arrives as decimal(18,4); ``double precision`` and
``real`` are read as double and cast to decimal when staged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

CRM_HEAD = (
    "id string, name string, date_entered timestamp, date_modified timestamp, deleted boolean"
)
INGEST_TAIL = "_etl_synced_at timestamp, _etl_source_system string"
MONEY = "decimal(18,4)"

# Physical columns between the head and the tail. They name the source data.
CRM_COLUMNS = {
    "crm_accounts": (
        "phone_number string, national_id string, zoho_customer_id string, "
        "mobile_number string, customer_status string, programs_customer_id string, "
        "channel_partner_id string, is_mobile_verified string, customer_uid string, "
        "personal_email_address string, corporate_company_id string, "
        "customer_verification_at timestamp, nafath_verified_at timestamp, "
        "nafath_verified boolean"
    ),
    "crm_aos_invoices": (
        "billing_account_id string, total_amount decimal(18,4), invoice_date date, "
        "settlement_date date, invoice_status string, invoice_due_date date, "
        "vat_amount double, customer_id string, channel_partner_id string, "
        "programs_id string, amount_ex_vat double, zoho_invoice_number string"
    ),
    "crm_addresses": (
        "addresses_city string, addresses_country string, addresses_street string, "
        "addresses_type string, addresses_area string, customer_id string, "
        "addresses_default_address boolean, district string, postal_code string"
    ),
    "crm_api_logs": (
        "parent_type string, parent_id string, error_details string, status string, source string"
    ),
    "crm_channel_partners": (
        "legal_name string, channel_partner_type string, vat_trn_number string, "
        "country_id string, channel_partner_uid string, status string"
    ),
    "crm_corporate_company": (
        "corporate_company_type string, allowed_email_domains string, status string, "
        "channel_partners_id string"
    ),
    "crm_countries": (
        "country_code string, country_currency string, vat_rate int, zoho_tax_id string"
    ),
    "crm_cp_skus": (
        "purchase_price double, category string, channel_partner_id string, "
        "program_sku_id string, master_sku_id string, cp_skus_uid string, cp_item_code string"
    ),
    "crm_credit_notes": (
        "invoice_id string, credit_note_zoho_url string, zoho_status string, "
        "zoho_credit_note_id string, credit_id string"
    ),
    "crm_devices": (
        "serial_number string, purchase_price decimal(18,4), purchase_date date, imei2 string, "
        "brand string, model string, device_memory string, color string, delivery_date date, "
        "devices_type string, order_item_id string, device_condition string, "
        "program_sku_id string, imei1 string"
    ),
    "crm_devices_journey": (
        "device_movement string, movement_date date, devices_journey_device_id string"
    ),
    "crm_invoice_line_items": (
        "amount double, line_item_id string, quantity int, amount_ex_vat decimal(18,4), "
        "vat_amount decimal(18,4), total_inc_vat decimal(18,4), invoice_line_item_id string, "
        "subscriptions_id string, product_type string, order_item_id string"
    ),
    "crm_master_skus": (
        "brand string, model string, memory string, color string, category string, "
        "sku_master_uid string"
    ),
    "crm_order_items": (
        "quantity int, product_type string, order_id string, program_sku_id string, "
        "cp_sku_id string, unit_price_vat_inclusive double, total_price_vat_inclusive double, "
        "device_purchase_price_vat_inclusive double, customer_id string, "
        "discount_amount double, imei_1 string, serial_no string, order_line_item_type string"
    ),
    "crm_orders": (
        "order_status string, customer_id string, programs_order_id string, "
        "payment_method_id string, order_type string, sales_channel string, delivered_on date, "
        "total_amount_incl_vat double, total_discount_amount double, "
        "total_gmv_amount_incl_vat double"
    ),
    "crm_payment_history": (
        "payment_method_id string, error_code string, error_reason string, last_four string, "
        "expiry_month int, expiry_year int, action string, status string, funding_type string, "
        "attempted_at timestamp, payment_id string, refund_id string"
    ),
    "crm_payment_methods": (
        "status string, is_default boolean, type string, ending_digits string, "
        "expiry_year int, expiry_month int, customer_id string, payment_method_brand string, "
        "funding_type string"
    ),
    "crm_payments": (
        "payment_status string, payment_due_date timestamp, "
        "payment_amount_tax_inclusive decimal(18,4), payment_type string, payment_id string, "
        "customer_payment_id string, subscription_payment_id string, order_id string, "
        "invoice_id string, payment_timestamp timestamp, refund_amount double, "
        "refund_status string"
    ),
    "crm_programs": (
        "program_start_date string, program_end_date string, program_status string, "
        "channel_partner_id string, program_uid string, payment_methods_limit int, "
        "subscription_limit int"
    ),
    "crm_subscription_durations": (
        "duration string, duration_status string, duration_start_date date, "
        "duration_end_date date, programs_id string, channel_partners_id string"
    ),
    "crm_subscription_pricing": (
        "monthly_subscription_amount double, subscription_pricing_status string, "
        "subscription_pricing_start_date date, subscription_pricing_end_date date, "
        "program_sku_id string, subscription_durations_id string"
    ),
    "crm_subscriptions": (
        "subscription_uid string, subscription_status string, service_start_date date, "
        "service_end_date date, subscription_close_date date, order_item_id string, "
        "subscription_pricing_id string, channel_partner_id string, order_id string, "
        "upgraded_subscription_id string, product_type string, customer_id string"
    ),
    "crm_program_skus": (
        "barcode string, launch_rrp double, master_skus_id string, program_skus_type string, "
        "category string, program_skus_uid string"
    ),
}

PSP_COLUMNS = {
    "payments_payment_methods": (
        "id string, is_enabled boolean, expiry_month int, expiry_year int, "
        "payment_gateway string, last4 string, subscriber_id string, created_at timestamp, "
        "updated_at timestamp, deleted_at timestamp, expired boolean"
    ),
    "payments_payments": (
        "id string, payment_type string, amount double, due_date timestamp, "
        "subscriber_id string, subscription_id string, transaction_id string, "
        "payment_intent_id string, created_at timestamp, updated_at timestamp, "
        "deleted_at timestamp"
    ),
    "payments_refunds": (
        "id string, refund_id string, payment_intent_id string, amount int, status string, "
        "currency string, created_at timestamp, updated_at timestamp, _etl_deleted_at timestamp"
    ),
    "payments_subscribers": (
        "id string, stripe_id string, default_payment_method_id string, disputed boolean, "
        "created_at timestamp, updated_at timestamp, deleted_at timestamp, collectible boolean"
    ),
    "payments_subscriptions": (
        "id string, currency string, locked boolean, subscriber_id string, "
        "created_at timestamp, updated_at timestamp, deleted_at timestamp"
    ),
    "payments_transactions": (
        "id string, payment_intent_id string, process_status string, request_status string, "
        "type string, subscriber_id string, is_scheduled boolean, due_date timestamp, "
        "created_at timestamp, updated_at timestamp, _etl_deleted_at timestamp"
    ),
}

RAW_DDL: dict[str, str] = {
    **{t: f"{CRM_HEAD}, {cols}, {INGEST_TAIL}" for t, cols in CRM_COLUMNS.items()},
    **{t: f"{cols}, {INGEST_TAIL}" for t, cols in PSP_COLUMNS.items()},
}
RAW_TABLES = tuple(RAW_DDL)


def raw_schema(table: str) -> StructType:
    return StructType.fromDDL(RAW_DDL[table])


@dataclass(frozen=True)
class TableSpec:
    """Grain and integrity contract of a table: what the quality jobs are generated from."""

    name: str
    pk: tuple[str, ...]
    fks: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent key)
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    not_null: tuple[str, ...] = ()
    where: tuple[tuple[str, str], ...] = ()  # column -> row condition of its check
    warn: tuple[str, ...] = ()  # columns whose checks only warn
