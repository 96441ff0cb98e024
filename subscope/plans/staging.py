"""Staging: one narrow operator per raw table (filter live rows, rename, clean).

No operator here shuffles; chained with a scan each is a single codegen stage.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.clean import business_key, code, code_or, key, money, text, whole
from subscope.functions.dates import expired_before
from subscope.functions.flags import ilike_flag, status_flag
from subscope.sources.raw import live_rows

VOIDED_ORDER = ("cancelled", "rejected", "expired")
SETTLED_ATTEMPT = ("paid", "approved")
KIFED = ("kifed", "auto_kifed")


def rename_project(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Project to business names: ``new_name=source`` with a column or a name."""
    return df.select([
        (F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()
    ])


_STAMP = {"_etl_synced_at": "_etl_synced_at", "_etl_source_system": "_etl_source_system"}


def _crm(raw: DataFrame, pk: str, label: str, **columns: Column | str) -> DataFrame:
    return rename_project(
        live_rows(raw),
        **{pk: "id", label: text("name"), "created_at": "date_entered",
           "updated_at": "date_modified"},
        **columns,
        **_STAMP,
    )


def _psp(
    raw: DataFrame, pk: str, deleted_at: str = "deleted_at", **columns: Column | str
) -> DataFrame:
    return rename_project(
        live_rows(raw, deleted_at=deleted_at),
        **{pk: "id"},
        **columns,
        created_at="created_at",
        updated_at="updated_at",
        **_STAMP,
    )


def stage_accounts(raw: DataFrame) -> DataFrame:
    nafath = F.coalesce("nafath_verified", F.lit(False))
    mobile = ilike_flag("is_mobile_verified", "yes")
    return _crm(
        raw, "customer_id", "customer_name",
        national_id=text("national_id"),
        is_nafath_verified=nafath,
        is_mobile_verified=mobile,
        is_fully_verified=nafath & mobile,
        corporate_company_id=key("corporate_company_id"),
        zoho_customer_id=key("zoho_customer_id"),
        channel_partner_id=key("channel_partner_id"),
        program_id=key("programs_customer_id"),
        customer_uid=text("customer_uid"),
        phone_number=text("phone_number"),
        mobile_number=text("mobile_number"),
        personal_email_address=text("personal_email_address"),
        customer_status=code("customer_status"),
        customer_verification_at="customer_verification_at",
        nafath_verified_at="nafath_verified_at",
    )


def stage_invoices(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "invoice_id", "invoice_name",
        invoice_status=code("invoice_status"),
        is_paid=status_flag("invoice_status", "paid"),
        invoice_amount_sar=money("total_amount"),
        vat_amount_sar=money("vat_amount"),
        amount_ex_vat_sar=money("amount_ex_vat"),
        zoho_invoice_number=text("zoho_invoice_number"),
        billing_account_id=key("billing_account_id"),
        customer_id=key("customer_id"),
        channel_partner_id=key("channel_partner_id"),
        program_id=key("programs_id"),
        invoice_date="invoice_date",
        invoice_due_date="invoice_due_date",
        settlement_date="settlement_date",
    )


def stage_addresses(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "address_id", "address_name",
        customer_id=key("customer_id"),
        address_type=code("addresses_type"),
        city=text("addresses_city"),
        area=text("addresses_area"),
        country=text("addresses_country"),
        street=text("addresses_street"),
        district=text("district"),
        postal_code=text("postal_code"),
        is_default_address="addresses_default_address",
    )


def stage_api_logs(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "api_log_id", "api_log_name",
        api_status=code("status"),
        is_failure=status_flag("status", "failure"),
        api_source=code("source"),
        parent_type=text("parent_type"),
        parent_id=key("parent_id"),
        error_details=text("error_details"),
    )


def stage_channel_partners(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "channel_partner_id", "partner_name",
        legal_name=text("legal_name"),
        partner_type=code("channel_partner_type"),
        vat_trn_number=text("vat_trn_number"),
        channel_partner_uid=text("channel_partner_uid"),
        partner_status=code("status"),
        country_id=key("country_id"),
    )


def stage_corporate_companies(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "corporate_company_id", "company_name",
        allowed_email_domains=text("allowed_email_domains"),
        company_status=code("status"),
        channel_partner_id=key("channel_partners_id"),
        company_type=code("corporate_company_type"),
    )


def stage_countries(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "country_id", "country_name",
        country_code=text("country_code"),
        country_currency=text("country_currency"),
        vat_rate=money("vat_rate"),
        zoho_tax_id=text("zoho_tax_id"),
    )


def stage_cp_skus(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "cp_sku_id", "cp_sku_name",
        channel_partner_id=key("channel_partner_id"),
        program_sku_id=key("program_sku_id"),
        master_sku_id=key("master_sku_id"),
        purchase_price=money("purchase_price"),
        category=code("category"),
        cp_item_code=text("cp_item_code"),
        cp_sku_uid=text("cp_skus_uid"),
    )


def stage_credit_notes(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "credit_note_id", "credit_note_name",
        zoho_credit_note_id=text("zoho_credit_note_id"),
        zoho_status=code("zoho_status"),
        credit_note_zoho_url=text("credit_note_zoho_url"),
        invoice_id=key("invoice_id"),
        credit_id=key("credit_id"),
    )


def stage_devices(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "device_id", "device_name",
        serial_number=text("serial_number"),
        purchase_price=money("purchase_price"),
        purchase_date="purchase_date",
        delivery_date="delivery_date",
        brand=text("brand"),
        model=text("model"),
        device_memory=text("device_memory"),
        color=text("color"),
        order_item_id=key("order_item_id"),
        program_sku_id=key("program_sku_id"),
        imei1=text("imei1"),
        imei2=text("imei2"),
        device_type=code("devices_type"),
        device_condition=code("device_condition"),
    )


def stage_devices_journey(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "device_journey_id", "device_journey_name",
        device_movement=code("device_movement"),
        movement_date="movement_date",
        device_id=key("devices_journey_device_id"),
    )


def stage_invoice_line_items(raw: DataFrame) -> DataFrame:
    # The source's invoice_line_item_id column holds the id of the parent invoice.
    return _crm(
        raw, "invoice_line_item_id", "invoice_line_item_name",
        subscription_id=key("subscriptions_id"),
        order_item_id=key("order_item_id"),
        line_item_id=key("line_item_id"),
        parent_invoice_line_item_id=key("invoice_line_item_id"),
        line_amount_sar=money("amount"),
        line_amount_ex_vat_sar=money("amount_ex_vat"),
        vat_amount_sar=money("vat_amount"),
        line_amount_incl_vat_sar=money("total_inc_vat"),
        quantity=money("quantity"),
        product_type=code("product_type"),
    )


def stage_master_skus(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "master_sku_id", "master_sku_name",
        brand=text("brand"),
        model=text("model"),
        memory=text("memory"),
        color=text("color"),
        category=code("category"),
        sku_master_uid=text("sku_master_uid"),
        device_sku_key=business_key("brand", "model", "memory", "color"),
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    amounts = (
        "quantity", "unit_price_vat_inclusive", "total_price_vat_inclusive",
        "device_purchase_price_vat_inclusive", "discount_amount",
    )
    return _crm(
        raw, "order_item_id", "order_item_name",
        order_id=key("order_id"),
        program_sku_id=key("program_sku_id"),
        cp_sku_id=key("cp_sku_id"),
        customer_id=key("customer_id"),
        **{a: money(a) for a in amounts},
        product_type=code("product_type"),
        order_line_item_type=code("order_line_item_type"),
        imei_1=text("imei_1"),
        serial_no=text("serial_no"),
    )


def stage_orders(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "order_id", "order_number",
        order_status=code("order_status"),
        order_type=code_or("order_type", "unknown"),
        gmv_amount_sar=money("total_gmv_amount_incl_vat"),
        customer_id=key("customer_id"),
        program_id=key("programs_order_id"),
        delivered_at="delivered_on",
        sales_channel=code("sales_channel"),
        payment_method_id=key("payment_method_id"),
        total_discount_amount=money("total_discount_amount"),
        total_amount_incl_vat=money("total_amount_incl_vat"),
        is_preorder=status_flag("order_type", "pre-order"),
        is_voided=status_flag("order_status", *VOIDED_ORDER),
        is_gmv_eligible=status_flag("order_status", *VOIDED_ORDER, negate=True),
    )


def stage_payment_history(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "payment_history_id", "payment_history_name",
        payment_attempt_status=code("status"),
        is_successful_attempt=status_flag("status", *SETTLED_ATTEMPT),
        is_failed_attempt=status_flag("status", "failed"),
        payment_id=key("payment_id"),
        payment_method_id=key("payment_method_id"),
        error_code=text("error_code"),
        error_reason=text("error_reason"),
        card_last_four=text("last_four"),
        expiry_month="expiry_month",
        expiry_year="expiry_year",
        action=code("action"),
        funding_type=code("funding_type"),
        attempted_at="attempted_at",
        refund_id=text("refund_id"),
    )


def stage_payment_methods(raw: DataFrame, as_of: date | str) -> DataFrame:
    today = F.lit(str(as_of)).cast("date")
    return _crm(
        raw, "payment_method_id", "payment_method_name",
        customer_id=key("customer_id"),
        payment_method_status=code("status"),
        payment_method_type=code("type"),
        card_last_four=text("ending_digits"),
        expiry_year=whole("expiry_year"),
        expiry_month=whole("expiry_month"),
        is_default="is_default",
        card_brand=code("payment_method_brand"),
        funding_type=code("funding_type"),
        is_expired=expired_before(whole("expiry_year"), whole("expiry_month"), today),
    )


def stage_payments(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "payment_id", "payment_name",
        payment_status=code("payment_status"),
        collected_amount_sar=money("payment_amount_tax_inclusive"),
        refund_amount_sar=money("refund_amount"),
        psp_payment_id=key("payment_id"),
        order_id=key("order_id"),
        invoice_id=key("invoice_id"),
        customer_id=key("customer_payment_id"),
        subscription_id=key("subscription_payment_id"),
        payment_timestamp="payment_timestamp",
        paid_at=F.coalesce("payment_timestamp", "date_entered"),
        payment_due_date="payment_due_date",
        payment_type=code("payment_type"),
        is_recurring_payment=status_flag("payment_type", "recurring"),
        refund_status=code("refund_status"),
        is_collected=status_flag("payment_status", "paid"),
        is_failed=status_flag("payment_status", "failed"),
        is_refunded=status_flag("payment_status", "refunded"),
    )


def stage_programs(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "program_id", "program_name",
        program_status=code("program_status"),
        channel_partner_id=key("channel_partner_id"),
        program_uid=text("program_uid"),
        subscription_limit=whole("subscription_limit"),
        payment_methods_limit=whole("payment_methods_limit"),
        program_start_date="program_start_date",
        program_end_date="program_end_date",
        is_fnf_program=ilike_flag("name", "%fnf%"),
    )


def stage_subscription_durations(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "subscription_duration_id", "subscription_duration_name",
        duration_months=whole("duration"),
        duration_status=code("duration_status"),
        program_id=key("programs_id"),
        channel_partner_id=key("channel_partners_id"),
        duration_start_date="duration_start_date",
        duration_end_date="duration_end_date",
    )


def stage_subscription_pricing(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "subscription_pricing_id", "subscription_pricing_name",
        monthly_subscription_amount_sar=money("monthly_subscription_amount"),
        program_sku_id=key("program_sku_id"),
        subscription_duration_id=key("subscription_durations_id"),
        subscription_pricing_status=code("subscription_pricing_status"),
        subscription_pricing_start_date="subscription_pricing_start_date",
        subscription_pricing_end_date="subscription_pricing_end_date",
    )


def stage_subscriptions(raw: DataFrame) -> DataFrame:
    # Lower-casing already maps 'Waiting_For_Delivery' to its cleaned spelling.
    return _crm(
        raw, "subscription_id", "subscription_name",
        subscription_status=code("subscription_status"),
        service_started_at="service_start_date",
        service_ended_at="service_end_date",
        subscription_close_date="subscription_close_date",
        subscription_pricing_id=key("subscription_pricing_id"),
        channel_partner_id=key("channel_partner_id"),
        customer_id=key("customer_id"),
        order_id=key("order_id"),
        order_item_id=key("order_item_id"),
        subscription_uid=text("subscription_uid"),
        product_type=code("product_type"),
        upgraded_subscription_id=key("upgraded_subscription_id"),
        is_active_subscription=(
            status_flag("subscription_status", "active") & F.col("service_start_date").isNotNull()
        ),
        is_churned=status_flag("subscription_status", "cancelled"),
        is_upgraded=status_flag("subscription_status", "upgraded"),
        is_kifed=status_flag("subscription_status", *KIFED),
    )


def stage_program_skus(raw: DataFrame) -> DataFrame:
    return _crm(
        raw, "program_sku_id", "program_sku_name",
        master_sku_id=key("master_skus_id"),
        barcode=text("barcode"),
        launch_rrp=money("launch_rrp"),
        program_sku_type=code("program_skus_type"),
        category=code("category"),
        program_sku_uid=text("program_skus_uid"),
    )


def stage_psp_payment_methods(raw: DataFrame) -> DataFrame:
    return _psp(
        raw, "psp_payment_method_id",
        subscriber_id=key("subscriber_id"),
        is_enabled="is_enabled",
        expiry_month=whole("expiry_month"),
        expiry_year=whole("expiry_year"),
        card_last_four=text("last4"),
        payment_gateway=code("payment_gateway"),
        is_expired=F.coalesce("expired", F.lit(False)),
    )


def stage_psp_payments(raw: DataFrame) -> DataFrame:
    return _psp(
        raw, "psp_payment_id",
        payment_type=code("payment_type"),
        payment_amount=money("amount"),
        subscriber_id="subscriber_id",
        psp_subscription_id="subscription_id",
        transaction_id="transaction_id",
        payment_intent_id="payment_intent_id",
        due_date="due_date",
    )


def stage_psp_refunds(raw: DataFrame) -> DataFrame:
    return _psp(
        raw, "refund_record_id", "_etl_deleted_at",
        psp_refund_id=text("refund_id"),
        payment_intent_id=key("payment_intent_id"),
        refund_amount=money("amount"),
        refund_status=code("status"),
        currency=code("currency"),
        is_approved=status_flag("status", "approved"),
    )


def stage_psp_subscribers(raw: DataFrame) -> DataFrame:
    return _psp(
        raw, "subscriber_id",
        stripe_id=text("stripe_id"),
        default_payment_method_id=key("default_payment_method_id"),
        disputed="disputed",
        collectible="collectible",
    )


def stage_psp_subscriptions(raw: DataFrame) -> DataFrame:
    return _psp(
        raw, "psp_subscription_id",
        currency=code("currency"),
        is_locked="locked",
        subscriber_id=key("subscriber_id"),
    )


def stage_psp_transactions(raw: DataFrame) -> DataFrame:
    return _psp(
        raw, "transaction_id", "_etl_deleted_at",
        process_status=code("process_status"),
        request_status=code("request_status"),
        subscriber_id=key("subscriber_id"),
        payment_intent_id=key("payment_intent_id"),
        transaction_type=code("type"),
        is_scheduled="is_scheduled",
        due_date="due_date",
        is_successful=(
            status_flag("process_status", "completed") & status_flag("request_status", "success")
        ),
        is_retry_queue=status_flag("process_status", "queued"),
    )
