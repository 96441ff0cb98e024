"""The warehouse once more, as DuckDB SQL: staged, conformed and mart tables.

Each entry is the body of one common table expression; ``with_query`` collects those a
query needs. Written by hand from the rules, not generated from the Spark code (only the
raw tables share their derivation, see ``subscope.sources.bindings``).
"""

from __future__ import annotations

import re

from subscope.sources.bindings import BINDINGS, bound_sql

AS_OF = "2001-11-20"
TODAY = f"date '{AS_OF}'"


def t(c: str) -> str:
    return f"trim({c})"


def lc(c: str) -> str:
    return f"lower(trim({c}))"


def k(c: str) -> str:
    return f"nullif(trim({c}), '')"


def n(c: str) -> str:
    return f"cast({c} as decimal(18,4))"


def month(c: str) -> str:
    return f"cast(date_trunc('month', {c}) as date)"


def half_up(num: str, den: str) -> str:
    """Exact num/den of non-negative integers, rounded half up to 4 digits."""
    return (
        f"case when {den} > 0 then "
        f"cast((20000 * cast({num} as hugeint) + {den}) // (2 * {den}) as double) / 10000 end"
    )


SQL: dict[str, str] = {table: bound_sql(table) for table in BINDINGS}


def _crm(raw: str, pk: str, label: str, **cols: str) -> str:
    listed = ", ".join(f"{e} as {c}" for c, e in cols.items())
    return (
        f"select id as {pk}, trim(name) as {label}, date_entered as created_at, "
        f"date_modified as updated_at, {listed} from {raw} where deleted is not distinct from false"
    )


def _psp(raw: str, pk: str, gone: str, **cols: str) -> str:
    listed = ", ".join(f"{e} as {c}" for c, e in cols.items())
    return f"select id as {pk}, created_at, updated_at, {listed} from {raw} where {gone} is null"


def same(*cols: str) -> dict[str, str]:
    return {c: c for c in cols}


def trims(*cols: str) -> dict[str, str]:
    return {c: t(c) for c in cols}


def keys(*cols: str) -> dict[str, str]:
    return {c: k(c) for c in cols}


VOID = "('cancelled', 'rejected', 'expired')"

SQL.update(
    stg_accounts=_crm(
        "crm_accounts", "customer_id", "customer_name",
        **trims("national_id", "customer_uid", "phone_number", "mobile_number", "personal_email_address"),
        is_nafath_verified="ifnull(nafath_verified, false)",
        is_mobile_verified=f"{lc('is_mobile_verified')} = 'yes'",
        is_fully_verified=f"ifnull(nafath_verified, false) and {lc('is_mobile_verified')} = 'yes'",
        **keys("corporate_company_id", "zoho_customer_id", "channel_partner_id"),
        program_id=k("programs_customer_id"), customer_status=lc("customer_status"),
        **same("customer_verification_at", "nafath_verified_at"),
    ),
    stg_invoices=_crm(
        "crm_aos_invoices", "invoice_id", "invoice_name",
        invoice_status=lc("invoice_status"), is_paid=f"{lc('invoice_status')} = 'paid'",
        invoice_amount_sar=n("total_amount"), vat_amount_sar=n("vat_amount"),
        amount_ex_vat_sar=n("amount_ex_vat"), zoho_invoice_number=t("zoho_invoice_number"),
        **keys("billing_account_id", "customer_id", "channel_partner_id"),
        program_id=k("programs_id"), **same("invoice_date", "invoice_due_date", "settlement_date"),
    ),
    stg_addresses=_crm(
        "crm_addresses", "address_id", "address_name",
        customer_id=k("customer_id"), address_type=lc("addresses_type"), city=t("addresses_city"),
        area=t("addresses_area"), country=t("addresses_country"), street=t("addresses_street"),
        **trims("district", "postal_code"), is_default_address="addresses_default_address",
    ),
    stg_api_logs=_crm(
        "crm_api_logs", "api_log_id", "api_log_name",
        api_status=lc("status"), is_failure=f"{lc('status')} = 'failure'", api_source=lc("source"),
        **trims("parent_type", "error_details"), parent_id=k("parent_id"),
    ),
    stg_channel_partners=_crm(
        "crm_channel_partners", "channel_partner_id", "partner_name",
        **trims("legal_name", "vat_trn_number", "channel_partner_uid"),
        partner_type=lc("channel_partner_type"), partner_status=lc("status"),
        country_id=k("country_id"),
    ),
    stg_corporate_companies=_crm(
        "crm_corporate_company", "corporate_company_id", "company_name",
        allowed_email_domains=t("allowed_email_domains"), company_status=lc("status"),
        channel_partner_id=k("channel_partners_id"), company_type=lc("corporate_company_type"),
    ),
    stg_countries=_crm(
        "crm_countries", "country_id", "country_name",
        **trims("country_code", "country_currency", "zoho_tax_id"), vat_rate=n("vat_rate"),
    ),
    stg_cp_skus=_crm(
        "crm_cp_skus", "cp_sku_id", "cp_sku_name",
        **keys("channel_partner_id", "program_sku_id", "master_sku_id"),
        purchase_price=n("purchase_price"), category=lc("category"),
        cp_item_code=t("cp_item_code"), cp_sku_uid=t("cp_skus_uid"),
    ),
    stg_credit_notes=_crm(
        "crm_credit_notes", "credit_note_id", "credit_note_name",
        **trims("zoho_credit_note_id", "credit_note_zoho_url"), zoho_status=lc("zoho_status"),
        **keys("invoice_id", "credit_id"),
    ),
    stg_devices=_crm(
        "crm_devices", "device_id", "device_name",
        **trims("serial_number", "brand", "model", "device_memory", "color", "imei1", "imei2"),
        purchase_price=n("purchase_price"), **same("purchase_date", "delivery_date"),
        **keys("order_item_id", "program_sku_id"),
        device_type=lc("devices_type"), device_condition=lc("device_condition"),
    ),
    stg_devices_journey=_crm(
        "crm_devices_journey", "device_journey_id", "device_journey_name",
        device_movement=lc("device_movement"), movement_date="movement_date",
        device_id=k("devices_journey_device_id"),
    ),
    stg_invoice_line_items=_crm(
        "crm_invoice_line_items", "invoice_line_item_id", "invoice_line_item_name",
        subscription_id=k("subscriptions_id"), **keys("order_item_id", "line_item_id"),
        parent_invoice_line_item_id=k("invoice_line_item_id"),
        line_amount_sar=n("amount"), line_amount_ex_vat_sar=n("amount_ex_vat"),
        vat_amount_sar=n("vat_amount"), line_amount_incl_vat_sar=n("total_inc_vat"),
        quantity=n("quantity"), product_type=lc("product_type"),
    ),
    stg_master_skus=_crm(
        "crm_master_skus", "master_sku_id", "master_sku_name",
        **trims("brand", "model", "memory", "color", "sku_master_uid"), category=lc("category"),
        device_sku_key="concat_ws('|', trim(brand), trim(model), trim(memory), trim(color))",
    ),
    stg_order_items=_crm(
        "crm_order_items", "order_item_id", "order_item_name",
        **keys("order_id", "program_sku_id", "cp_sku_id", "customer_id"),
        **{c: n(c) for c in (
            "quantity", "unit_price_vat_inclusive", "total_price_vat_inclusive",
            "device_purchase_price_vat_inclusive", "discount_amount")},
        product_type=lc("product_type"), order_line_item_type=lc("order_line_item_type"),
        **trims("imei_1", "serial_no"),
    ),
    stg_orders=_crm(
        "crm_orders", "order_id", "order_number",
        order_status=lc("order_status"), order_type=f"ifnull({lc('order_type')}, 'unknown')",
        gmv_amount_sar=n("total_gmv_amount_incl_vat"), **keys("customer_id", "payment_method_id"),
        program_id=k("programs_order_id"), delivered_at="delivered_on",
        sales_channel=lc("sales_channel"), total_discount_amount=n("total_discount_amount"),
        total_amount_incl_vat=n("total_amount_incl_vat"),
        is_preorder=f"{lc('order_type')} = 'pre-order'",
        is_voided=f"{lc('order_status')} in {VOID}",
        is_gmv_eligible=f"{lc('order_status')} not in {VOID}",
    ),
    stg_payment_history=_crm(
        "crm_payment_history", "payment_history_id", "payment_history_name",
        payment_attempt_status=lc("status"),
        is_successful_attempt=f"{lc('status')} in ('paid', 'approved')",
        is_failed_attempt=f"{lc('status')} = 'failed'",
        **keys("payment_id", "payment_method_id"), **trims("error_code", "error_reason", "refund_id"),
        card_last_four=t("last_four"), **same("expiry_month", "expiry_year", "attempted_at"),
        action=lc("action"), funding_type=lc("funding_type"),
    ),
    stg_payment_methods=_crm(
        "crm_payment_methods", "payment_method_id", "payment_method_name",
        customer_id=k("customer_id"), payment_method_status=lc("status"),
        payment_method_type=lc("type"), card_last_four=t("ending_digits"),
        **same("expiry_year", "expiry_month", "is_default"), card_brand=lc("payment_method_brand"),
        funding_type=lc("funding_type"),
        is_expired=(
            "case when expiry_year is null or expiry_month is null then false "
            "when expiry_month between 1 and 12 then "
            f"expiry_year * 12 + expiry_month < year({TODAY}) * 12 + month({TODAY}) end"
        ),
    ),
    stg_payments=_crm(
        "crm_payments", "payment_id", "payment_name",
        payment_status=lc("payment_status"), collected_amount_sar=n("payment_amount_tax_inclusive"),
        refund_amount_sar=n("refund_amount"), psp_payment_id=k("payment_id"),
        **keys("order_id", "invoice_id"), customer_id=k("customer_payment_id"),
        subscription_id=k("subscription_payment_id"),
        **same("payment_timestamp", "payment_due_date"),
        paid_at="ifnull(payment_timestamp, date_entered)", payment_type=lc("payment_type"),
        is_recurring_payment=f"{lc('payment_type')} = 'recurring'", refund_status=lc("refund_status"),
        is_collected=f"{lc('payment_status')} = 'paid'", is_failed=f"{lc('payment_status')} = 'failed'",
        is_refunded=f"{lc('payment_status')} = 'refunded'",
    ),
    stg_programs=_crm(
        "crm_programs", "program_id", "program_name",
        program_status=lc("program_status"), channel_partner_id=k("channel_partner_id"),
        program_uid=t("program_uid"),
        **same("subscription_limit", "payment_methods_limit", "program_start_date", "program_end_date"),
        is_fnf_program="contains(lower(name), 'fnf')",
    ),
    stg_subscription_durations=_crm(
        "crm_subscription_durations", "subscription_duration_id", "subscription_duration_name",
        duration_months="cast(trim(duration) as int)", duration_status=lc("duration_status"),
        program_id=k("programs_id"), channel_partner_id=k("channel_partners_id"),
        **same("duration_start_date", "duration_end_date"),
    ),
    stg_subscription_pricing=_crm(
        "crm_subscription_pricing", "subscription_pricing_id", "subscription_pricing_name",
        monthly_subscription_amount_sar=n("monthly_subscription_amount"),
        program_sku_id=k("program_sku_id"), subscription_duration_id=k("subscription_durations_id"),
        subscription_pricing_status=lc("subscription_pricing_status"),
        **same("subscription_pricing_start_date", "subscription_pricing_end_date"),
    ),
    stg_subscriptions=_crm(
        "crm_subscriptions", "subscription_id", "subscription_name",
        subscription_status=lc("subscription_status"), service_started_at="service_start_date",
        service_ended_at="service_end_date", subscription_close_date="subscription_close_date",
        **keys("subscription_pricing_id", "channel_partner_id", "customer_id", "order_id",
               "order_item_id", "upgraded_subscription_id"),
        subscription_uid=t("subscription_uid"), product_type=lc("product_type"),
        is_active_subscription=f"{lc('subscription_status')} = 'active' and service_start_date is not null",
        is_churned=f"{lc('subscription_status')} = 'cancelled'",
        is_upgraded=f"{lc('subscription_status')} = 'upgraded'",
        is_kifed=f"{lc('subscription_status')} in ('kifed', 'auto_kifed')",
    ),
    stg_program_skus=_crm(
        "crm_program_skus", "program_sku_id", "program_sku_name",
        master_sku_id=k("master_skus_id"), barcode=t("barcode"), launch_rrp=n("launch_rrp"),
        program_sku_type=lc("program_skus_type"), category=lc("category"),
        program_sku_uid=t("program_skus_uid"),
    ),
    stg_psp_payment_methods=_psp(
        "payments_payment_methods", "psp_payment_method_id", "deleted_at",
        subscriber_id=k("subscriber_id"), **same("is_enabled", "expiry_month", "expiry_year"),
        card_last_four=t("last4"), payment_gateway=lc("payment_gateway"),
        is_expired="ifnull(expired, false)",
    ),
    stg_psp_payments=_psp(
        "payments_payments", "psp_payment_id", "deleted_at",
        payment_type=lc("payment_type"), payment_amount=n("amount"),
        psp_subscription_id="subscription_id",
        **same("subscriber_id", "transaction_id", "payment_intent_id", "due_date"),
    ),
    stg_psp_refunds=_psp(
        "payments_refunds", "refund_record_id", "_etl_deleted_at",
        psp_refund_id=t("refund_id"), payment_intent_id=k("payment_intent_id"),
        refund_amount=n("amount"), refund_status=lc("status"), currency=lc("currency"),
        is_approved=f"{lc('status')} = 'approved'",
    ),
    stg_psp_subscribers=_psp(
        "payments_subscribers", "subscriber_id", "deleted_at",
        stripe_id=t("stripe_id"), default_payment_method_id=k("default_payment_method_id"),
        **same("disputed", "collectible"),
    ),
    stg_psp_subscriptions=_psp(
        "payments_subscriptions", "psp_subscription_id", "deleted_at",
        currency=lc("currency"), is_locked="locked", subscriber_id=k("subscriber_id"),
    ),
    stg_psp_transactions=_psp(
        "payments_transactions", "transaction_id", "_etl_deleted_at",
        process_status=lc("process_status"), request_status=lc("request_status"),
        **keys("subscriber_id", "payment_intent_id"), transaction_type=lc("type"),
        **same("is_scheduled", "due_date"),
        is_successful=f"{lc('process_status')} = 'completed' and {lc('request_status')} = 'success'",
        is_retry_queue=f"{lc('process_status')} = 'queued'",
    ),
)

SQL.update(
    int_channel_partners="select * from stg_channel_partners",
    int_customers="""
        select a.*, b.company_name as corporate_company_name, b.allowed_email_domains,
               b.company_status, b.company_type,
               b.corporate_company_id is not null as has_valid_corporate_company
        from stg_accounts a left join stg_corporate_companies b
          on b.corporate_company_id = a.corporate_company_id""",
    int_device_skus="""
        select p.* exclude (category), p.category as program_category, q.master_sku_name,
               q.brand, q.model, q.memory, q.color, q.category as master_category,
               q.device_sku_key, ifnull(q.device_sku_key, 'sku_unknown') as resolved_device_sku_key,
               q.master_sku_id is not null as has_valid_master_sku
        from stg_program_skus p left join stg_master_skus q on q.master_sku_id = p.master_sku_id""",
    program_usage="""
        select o.program_id,
               sum(case when s.subscription_status = 'active' then 1 else 0 end) as act,
               sum(case when s.subscription_status = 'waiting_for_delivery' then 1 else 0 end) as wait
        from stg_orders o, stg_subscriptions s where s.order_id = o.order_id group by o.program_id""",
    int_programs=f"""
        select p.*, cp.partner_name, cp.partner_type,
               cp.channel_partner_id is not null as has_valid_channel_partner,
               cast(ifnull(u.act, 0) as bigint) as active_subscription_count,
               cast(ifnull(u.wait, 0) as bigint) as waiting_for_delivery_subscription_count,
               cast(ifnull(u.act, 0) + ifnull(u.wait, 0) as bigint) as utilization_subscription_count,
               {half_up('(ifnull(u.act, 0) + ifnull(u.wait, 0))', 'p.subscription_limit')}
                   as program_subscription_utilization_pct,
               p.subscription_limit > 0
                   and ifnull(u.act, 0) + ifnull(u.wait, 0) > p.subscription_limit
                   as is_over_subscription_limit,
               p.program_status <> 'active' as is_disabled_program
        from stg_programs p
        left join stg_channel_partners cp on cp.channel_partner_id = p.channel_partner_id
        left join program_usage u on u.program_id = p.program_id""",
    int_orders="""
        select o.*, pay.first_paid_at, p.program_name, p.channel_partner_id, p.partner_name,
               p.partner_type, p.is_fnf_program, cu.customer_name,
               cu.is_fully_verified as customer_is_fully_verified, cu.corporate_company_id,
               cu.corporate_company_name, cu.customer_id is not null as has_valid_customer,
               p.program_id is not null as has_valid_program,
               p.channel_partner_id is not null as has_valid_channel_partner
        from stg_orders o
        left join int_programs p on p.program_id = o.program_id
        left join int_customers cu on cu.customer_id = o.customer_id
        left join (select order_id, min(paid_at) as first_paid_at from stg_payments
                   where is_collected group by order_id) pay on pay.order_id = o.order_id""",
    int_order_items="""
        select i.*, coalesce(i.program_sku_id, cs.program_sku_id) as resolved_program_sku_id,
               coalesce(d1.brand, d2.brand, ms.brand) as brand,
               coalesce(d1.model, d2.model, ms.model) as model,
               coalesce(d1.memory, d2.memory, ms.memory) as memory,
               coalesce(d1.color, d2.color, ms.color) as color,
               coalesce(d1.device_sku_key, d2.device_sku_key, ms.device_sku_key, 'sku_unknown')
                   as device_sku_key,
               coalesce(d1.master_sku_id, d2.master_sku_id, cs.master_sku_id) as master_sku_id,
               o.order_id is not null as has_valid_order,
               d1.program_sku_id is not null as has_valid_program_sku,
               cs.cp_sku_id is not null as has_valid_cp_sku,
               coalesce(d1.program_sku_id, cs.program_sku_id) is not null as has_valid_resolved_sku,
               o.program_id, o.channel_partner_id, o.partner_name, o.program_name, o.order_status,
               o.is_gmv_eligible, o.has_valid_customer
        from stg_order_items i
        left join int_orders o on o.order_id = i.order_id
        left join int_device_skus d1 on d1.program_sku_id = i.program_sku_id
        left join stg_cp_skus cs on cs.cp_sku_id = i.cp_sku_id
        left join int_device_skus d2 on d2.program_sku_id = cs.program_sku_id
        left join stg_master_skus ms on ms.master_sku_id = cs.master_sku_id""",
    int_subscriptions="""
        select s.*, s.is_upgraded or s.is_kifed as is_upgraded_or_kifed,
               pr.monthly_subscription_amount_sar, pr.subscription_duration_id,
               du.duration_months as subscription_term_months, o.program_id, o.program_name,
               o.channel_partner_id as order_channel_partner_id, o.partner_name, o.is_fnf_program,
               pr.subscription_pricing_id is not null as has_valid_subscription_pricing,
               s.is_active_subscription and pr.monthly_subscription_amount_sar is not null
                   as is_mrr_eligible,
               o.order_id is not null as has_valid_order,
               s.customer_id is not null and o.has_valid_customer as has_valid_customer
        from stg_subscriptions s
        left join stg_subscription_pricing pr on pr.subscription_pricing_id = s.subscription_pricing_id
        left join stg_subscription_durations du
          on du.subscription_duration_id = pr.subscription_duration_id
        left join int_orders o on o.order_id = s.order_id""",
    int_devices="""
        select d.*, i.order_id, i.program_id, i.channel_partner_id, i.partner_name,
               i.device_sku_key, i.customer_id, s.subscription_id, s.subscription_status,
               s.is_active_subscription, i.order_item_id is not null as has_valid_order_item,
               s.subscription_id is not null as has_valid_subscription
        from stg_devices d
        left join int_order_items i on i.order_item_id = d.order_item_id
        left join int_subscriptions s on s.order_item_id = i.order_item_id""",
    int_customer_device_counts="""
        select customer_id, count(*) as device_count,
               count(distinct order_id) as order_count_with_devices,
               min(purchase_date) as first_device_purchase_date,
               max(delivery_date) as latest_device_delivery_date
        from int_devices where customer_id is not null group by customer_id""",
    snapshot_months=f"""
        select s.*, cast(unnest(generate_series(
                   date_trunc('month', ifnull(s.service_started_at, cast(s.created_at as date))),
                   date_trunc('month', coalesce(s.service_ended_at, s.subscription_close_date, {TODAY})),
                   interval 1 month)) as date) as snapshot_month
        from int_subscriptions s""",
    int_subscription_snapshots_monthly=f"""
        select subscription_id, snapshot_month,
               cast(date_trunc('quarter', snapshot_month) as date) as snapshot_quarter,
               subscription_status, service_started_at, service_ended_at, subscription_close_date,
               channel_partner_id, program_id, partner_name, monthly_subscription_amount_sar,
               is_mrr_eligible, is_churned, is_upgraded, is_kifed,
               is_active_subscription and {month('service_started_at')} <= snapshot_month
                 and ifnull({month('service_ended_at')}, date '9999-01-01') > snapshot_month
                 and ifnull({month('subscription_close_date')}, date '9999-01-01') > snapshot_month
                 as is_active_at_month_end,
               month(snapshot_month) % 3 = 1 and is_active_subscription
                 and service_started_at <= snapshot_month
                 and ifnull(service_ended_at, date '9999-01-01') > snapshot_month
                 and ifnull(subscription_close_date, date '9999-01-01') > snapshot_month
                 as is_active_at_quarter_start,
               is_churned and service_ended_at is not null
                 and {month('service_ended_at')} = snapshot_month as is_churned_in_month,
               is_upgraded and updated_at is not null and {month('updated_at')} = snapshot_month
                 as is_upgraded_in_month,
               is_kifed and updated_at is not null and {month('updated_at')} = snapshot_month
                 as is_kifed_in_month
        from snapshot_months""",
    int_payments_crm="""
        select p.*, o.order_number, o.program_id, o.channel_partner_id, o.partner_name,
               o.program_name, o.is_gmv_eligible, cu.customer_name,
               cu.is_fully_verified as customer_is_fully_verified,
               o.order_id is not null as has_valid_order,
               cu.customer_id is not null as has_valid_customer
        from stg_payments p
        left join int_orders o on o.order_id = p.order_id
        left join int_customers cu on cu.customer_id = p.customer_id""",
    int_payments_psp="""
        select p.*, x.process_status, x.request_status, x.transaction_type, x.is_scheduled,
               x.is_successful, x.is_retry_queue, x.transaction_id is not null as has_transaction_outcome
        from stg_psp_payments p left join stg_psp_transactions x on x.transaction_id = p.transaction_id""",
    int_payments_unified="""
        select c.* exclude (is_gmv_eligible, customer_is_fully_verified),
               s.payment_amount as psp_payment_amount, s.payment_intent_id, s.subscriber_id,
               s.psp_subscription_id, s.process_status as psp_process_status,
               s.request_status as psp_request_status, s.is_successful as psp_is_successful,
               s.is_retry_queue as psp_is_retry_queue,
               s.psp_payment_id is not null as is_psp_reconciled,
               case when c.psp_payment_id is null then 'no_psp_reference'
                    when s.psp_payment_id is null then 'missing_in_psp'
                    when c.collected_amount_sar is not distinct from s.payment_amount then 'reconciled'
                    else 'amount_mismatch' end as psp_reconciliation_status,
               case when c.psp_payment_id is null then 'CRM payment has no PSP payment_id reference'
                    when s.psp_payment_id is null then 'PSP payment record not found for CRM payment_id'
                    when c.collected_amount_sar is not distinct from s.payment_amount then null
                    else 'CRM collected amount differs from PSP payment amount' end
                    as reconciliation_gap_reason
        from int_payments_crm c left join int_payments_psp s on s.psp_payment_id = c.psp_payment_id""",
    int_payment_attempts="""
        select h.*, ifnull(u.is_recurring_payment, false) as is_recurring_installment, u.order_id,
               u.customer_id, u.program_id, u.channel_partner_id, u.partner_name,
               u.psp_reconciliation_status, u.psp_is_retry_queue,
               u.payment_id is not null as has_valid_payment
        from stg_payment_history h left join int_payments_unified u on u.payment_id = h.payment_id""",
    int_invoices="""
        select i.*, cu.customer_name, cu.corporate_company_id, cu.corporate_company_name,
               cu.zoho_customer_id, cu.customer_id is not null as has_valid_customer
        from stg_invoices i left join int_customers cu on cu.customer_id = i.customer_id""",
    int_invoice_line_items="""
        select l.* exclude (parent_invoice_line_item_id), l.parent_invoice_line_item_id as invoice_id,
               s.subscription_status, s.program_id, s.channel_partner_id, s.partner_name,
               s.monthly_subscription_amount_sar, i.invoice_status, i.invoice_date,
               i.zoho_invoice_number, i.customer_id, i.is_paid,
               i.invoice_id is not null as has_valid_invoice,
               s.subscription_id is not null as has_valid_subscription
        from stg_invoice_line_items l
        left join int_subscriptions s on s.subscription_id = l.subscription_id
        left join int_invoices i on i.invoice_id = l.parent_invoice_line_item_id""",
    int_credit_notes="""
        select c.*, i.invoice_name, i.invoice_amount_sar, i.invoice_status, i.zoho_invoice_number,
               i.customer_id, i.customer_name, i.channel_partner_id, i.program_id,
               i.invoice_id is not null as has_valid_invoice
        from stg_credit_notes c left join int_invoices i on i.invoice_id = c.invoice_id""",
    int_refunds="""
        select payment_id as refund_event_id, 'crm' as refund_source, refund_amount_sar,
               paid_at as refunded_at, customer_id, order_id, channel_partner_id, program_id,
               partner_name, md5('crm' || payment_id) as refund_dedup_key
        from int_payments_crm where is_refunded and refund_amount_sar > 0""",
    month_collected=f"""
        select {month('paid_at')} as mon,
               sum(case when is_collected then collected_amount_sar end) as amt,
               sum(case when is_collected then 1 else 0 end) as cnt,
               sum(case when is_refunded then refund_amount_sar end) as ref
        from int_payments_unified where paid_at is not null group by 1""",
    month_invoiced=f"""
        select {month('coalesce(invoice_date, settlement_date, cast(created_at as date))')} as mon,
               sum(case when is_paid then invoice_amount_sar end) as amt,
               sum(case when is_paid then 1 else 0 end) as cnt,
               sum(case when is_paid = false then invoice_amount_sar end) as unpaid
        from int_invoices group by 1""",
    month_noted=f"select {month('created_at')} as mon, count(*) as cnt from int_credit_notes group by 1",
    int_finance_reconciliation="""
        select m.mon as reconciliation_month, ifnull(p.amt, 0) as collected_revenue_sar,
               ifnull(i.amt, 0) as invoiced_revenue_sar,
               ifnull(p.amt, 0) - ifnull(i.amt, 0) as finance_variance_sar,
               cast(ifnull(p.cnt, 0) as bigint) as collected_payment_count,
               cast(ifnull(i.cnt, 0) as bigint) as paid_invoice_count,
               ifnull(i.unpaid, 0) as unpaid_invoice_amount_sar,
               ifnull(p.ref, 0) as crm_refund_amount_sar, ifnull(c.cnt, 0) as credit_note_count
        from (select mon from month_collected union select mon from month_invoiced
              union select mon from month_noted) m
        left join month_collected p on p.mon = m.mon left join month_invoiced i on i.mon = m.mon
        left join month_noted c on c.mon = m.mon""",
    api_owner="""
        select a.*, case lower(trim(a.parent_type)) when 'channel_partners' then a.parent_id
                    when 'orders' then o.channel_partner_id
                    when 'subscriptions' then s.channel_partner_id
                    when 'accounts' then cu.channel_partner_id end as channel_partner_id
        from stg_api_logs a
        left join int_orders o on o.order_id = a.parent_id
        left join stg_subscriptions s on s.subscription_id = a.parent_id
        left join stg_accounts cu on cu.customer_id = a.parent_id""",
    int_partner_api_events="""
        select a.*, cp.partner_name, a.channel_partner_id is not null as has_partner_attribution
        from api_owner a left join stg_channel_partners cp
          on cp.channel_partner_id = a.channel_partner_id""",
)

SQL.update(
    fct_orders="""
        select order_id, cast(created_at as date) as order_date, customer_id, program_id,
               channel_partner_id, order_number, order_status, order_type, sales_channel,
               delivered_at, first_paid_at, is_preorder, is_voided, is_gmv_eligible,
               has_valid_customer, has_valid_program, gmv_amount_sar, total_discount_amount,
               total_amount_incl_vat from int_orders""",
    fct_order_items="""
        select * exclude (order_item_name, created_at, updated_at, program_sku_id, cp_sku_id,
                 imei_1, serial_no, resolved_program_sku_id, has_valid_program_sku,
                 has_valid_cp_sku, partner_name, program_name, order_status, is_gmv_eligible,
                 has_valid_customer),
               resolved_program_sku_id as program_sku_id, cast(created_at as date) as order_item_date
        from int_order_items""",
    dim_customers="""
        select c.*, ifnull(d.device_count, 0) as device_count, d.first_device_purchase_date,
               d.latest_device_delivery_date,
               case when is_nafath_verified and is_mobile_verified then 'fully_verified'
                    when is_nafath_verified and is_mobile_verified = false then 'nafath_only'
                    when is_mobile_verified and is_nafath_verified = false then 'mobile_only'
                    else 'unverified' end as customer_verification_segment
        from int_customers c left join int_customer_device_counts d on d.customer_id = c.customer_id""",
    partner_calls="""
        select channel_partner_id, count(*) as calls,
               cast(sum(case when is_failure then 1 else 0 end) as bigint) as fails
        from int_partner_api_events group by channel_partner_id""",
    dim_channel_partners=f"""
        select p.*, ifnull(e.calls, 0) as api_call_count, ifnull(e.fails, 0) as api_failure_count,
               {half_up('e.fails', 'e.calls')} as partner_api_failure_rate,
               case when {half_up('e.fails', 'e.calls')} > 0 then 'elevated_api_failures'
                    when e.calls is null then 'no_api_activity'
                    else 'healthy_api_performance' end as partner_operations_segment
        from stg_channel_partners p left join partner_calls e
          on e.channel_partner_id = p.channel_partner_id""",
    dim_programs="""
        select *, case when is_disabled_program then 'disabled'
                       when is_over_subscription_limit then 'over_subscription_limit'
                       when is_fnf_program then 'fnf_pending_rules' else 'within_limit' end
                  as program_limit_segment from int_programs""",
    dim_corporate_companies="""
        select b.*, cast(count(a.customer_id) filter (where a.is_fully_verified) as bigint)
                 as verified_customer_count, count(a.customer_id) as customer_count,
               case when bool_or(a.is_fully_verified) then 'has_verified_customers'
                    when count(a.customer_id) > 0 then 'has_unverified_customers'
                    else 'no_customers' end as cep_verification_segment
        from stg_corporate_companies b left join stg_accounts a
          on a.corporate_company_id = b.corporate_company_id group by all""",
    dim_device_skus="""
        select m.*, ifnull(r.cnt, 0) as order_item_count, ifnull(r.units, 0) as units_ordered,
               ifnull(r.rev, 0) as order_item_revenue_sar,
               if(r.cnt is null, 'not_sold', 'sold') as sku_sales_segment
        from stg_master_skus m left join
             (select master_sku_id, count(*) as cnt, sum(quantity) as units,
                     sum(total_price_vat_inclusive) as rev from int_order_items group by 1) r
          on r.master_sku_id = m.master_sku_id""",
    dim_dates=f"""
        select d as date_key, d as full_date, cast(year(d) as int) as year_number,
               cast(quarter(d) as int) as quarter_number, cast(month(d) as int) as month_number,
               cast(day(d) as int) as day_of_month, cast(dayofweek(d) as int) as day_of_week,
               strftime(d, '%Y-%m') as year_month,
               year(d) || '-Q' || quarter(d) as year_quarter, dayofweek(d) in (0, 6) as is_weekend
        from (select cast(unnest(generate_series(
                  (select min(cast(created_at as date)) from stg_orders),
                  {TODAY} + interval 1 year - interval 1 day, interval 1 day)) as date) as d)""",
    fct_subscriptions="""
        select subscription_id, customer_id, order_id, order_item_id, channel_partner_id,
               program_id, subscription_pricing_id, cast(created_at as date) as subscription_date,
               subscription_status, service_started_at, service_ended_at, subscription_close_date,
               is_active_subscription, is_mrr_eligible, is_churned, is_upgraded, is_kifed,
               is_upgraded_or_kifed, has_valid_subscription_pricing, has_valid_order,
               has_valid_customer, monthly_subscription_amount_sar as monthly_recurring_amount_sar,
               subscription_term_months from int_subscriptions""",
    fct_subscription_monthly_snapshots="""
        select * exclude (partner_name, is_churned, is_upgraded, is_kifed, is_active_at_month_end,
                          is_churned_in_month, is_upgraded_in_month, is_kifed_in_month),
               is_active_at_month_end as is_active, is_churned_in_month as is_churned,
               is_upgraded_in_month as is_upgraded, is_kifed_in_month as is_kifed
        from int_subscription_snapshots_monthly""",
    dim_subscription_pricing="""
        select p.*, ifnull(r.cnt, 0) as mrr_eligible_subscription_count,
               ifnull(r.mrr, 0) as total_mrr_sar,
               case when r.cnt > 0 then 'active_pricing'
                    when p.subscription_pricing_status = 'active' then 'active_unused'
                    else 'inactive' end as pricing_utilization_segment
        from stg_subscription_pricing p left join
             (select subscription_pricing_id, count(*) as cnt,
                     sum(monthly_subscription_amount_sar) as mrr
              from int_subscriptions where is_mrr_eligible group by 1) r
          on r.subscription_pricing_id = p.subscription_pricing_id""",
    dim_subscription_durations="""
        select d.*, ifnull(r.cnt, 0) as subscription_count,
               cast(ifnull(r.mrr, 0) as bigint) as mrr_eligible_subscription_count,
               r.term as avg_subscription_term_months,
               case when r.mrr > 0 then 'in_use' when d.duration_status = 'active' then 'available'
                    else 'inactive' end as duration_utilization_segment
        from stg_subscription_durations d left join
             (select subscription_duration_id, count(*) as cnt,
                     sum(case when is_mrr_eligible then 1 else 0 end) as mrr,
                     cast(sum(subscription_term_months) as double) / nullif(count(subscription_term_months), 0) as term
              from int_subscriptions group by 1) r
          on r.subscription_duration_id = d.subscription_duration_id""",
    fct_payments="""
        select payment_id, order_id, invoice_id, customer_id, subscription_id, program_id,
               channel_partner_id, psp_payment_id, cast(created_at as date) as payment_date,
               payment_timestamp, paid_at, payment_status, payment_type, refund_status,
               is_collected, is_failed, is_refunded, has_valid_order, has_valid_customer,
               is_psp_reconciled, psp_reconciliation_status, reconciliation_gap_reason,
               collected_amount_sar, refund_amount_sar, psp_payment_amount
        from int_payments_unified""",
    fct_payment_attempts="""
        select * exclude (payment_history_name, created_at, updated_at, attempted_at, refund_id,
                          partner_name), cast(attempted_at as date) as attempt_date,
               ifnull(is_failed_attempt and psp_is_retry_queue, false) as is_outstanding_retry_failure
        from int_payment_attempts""",
    fct_psp_transactions="""
        select x.transaction_id, x.subscriber_id, x.payment_intent_id,
               cast(x.created_at as date) as transaction_date, x.process_status, x.request_status,
               x.transaction_type, x.is_scheduled, x.is_successful, x.is_retry_queue,
               p.psp_payment_id, p.payment_amount, p.psp_subscription_id,
               case when x.is_successful then 'successful' when x.is_retry_queue then 'retry_queue'
                    else 'failed' end as transaction_outcome_segment
        from stg_psp_transactions x
        left join (select transaction_id, min(psp_payment_id) as pick from stg_psp_payments group by 1) f
          on f.transaction_id = x.transaction_id
        left join stg_psp_payments p on p.psp_payment_id = f.pick""",
    all_payment_methods="""
        select payment_method_id as payment_method_key, 'crm' as payment_method_source,
               payment_method_id, null as psp_payment_method_id, customer_id, null as subscriber_id,
               payment_method_name, payment_method_status, payment_method_type, card_last_four,
               expiry_year, expiry_month, is_default, card_brand, funding_type, is_expired,
               created_at, updated_at from stg_payment_methods
        union all by name
        select psp_payment_method_id as payment_method_key, 'psp' as payment_method_source,
               psp_payment_method_id, subscriber_id,
               if(is_enabled, 'active', 'disabled') as payment_method_status,
               payment_gateway as payment_method_type, payment_gateway as card_brand,
               card_last_four, expiry_year, expiry_month, false as is_default, is_expired,
               created_at, updated_at from stg_psp_payment_methods""",
    dim_payment_methods="""
        select *, case when is_expired then 'expired'
                       when payment_method_status in ('active', 'enabled') then 'active'
                       else 'inactive' end as payment_method_health_segment
        from all_payment_methods""",
    fct_invoices="""
        select * exclude (invoice_name, created_at, updated_at, customer_name, corporate_company_id,
                          corporate_company_name, zoho_customer_id) from int_invoices""",
    fct_invoice_line_items="""
        select * exclude (invoice_line_item_name, created_at, updated_at, line_item_id,
                          subscription_status, program_id, channel_partner_id, partner_name,
                          monthly_subscription_amount_sar, zoho_invoice_number)
        from int_invoice_line_items""",
    fct_credit_notes="""
        select credit_note_id, invoice_id, customer_id, channel_partner_id, program_id,
               cast(created_at as date) as credit_note_date, zoho_credit_note_id, zoho_status,
               credit_note_zoho_url, has_valid_invoice,
               invoice_amount_sar as related_invoice_amount_sar,
               invoice_amount_sar as credit_value_sar from int_credit_notes""",
    fct_refunds="""
        select * exclude (refund_dedup_key), refund_dedup_key as refund_id,
               cast(refunded_at as date) as refund_date from int_refunds""",
    fct_finance_reconciliation_monthly="select * from int_finance_reconciliation",
    fct_devices="""
        select * exclude (device_name, created_at, updated_at, serial_number, imei1, imei2,
                          partner_name, device_sku_key, subscription_status) from int_devices""",
    fct_device_journey_events="""
        select j.device_journey_id, j.device_id, d.order_item_id, d.order_id, d.customer_id,
               d.subscription_id, d.program_id, d.channel_partner_id, j.movement_date,
               j.device_movement, j.created_at as event_recorded_at,
               d.device_id is not null as has_valid_device
        from stg_devices_journey j left join int_devices d on d.device_id = j.device_id""",
    fct_partner_api_events="""
        select * exclude (api_log_name, created_at, updated_at, partner_name),
               cast(created_at as date) as event_date,
               cast(ifnull(is_failure, false) as int) as failure_count from int_partner_api_events""",
    bridge_cp_skus="""
        select c.*, cp.partner_name, cp.partner_type, d.brand, d.model, d.memory, d.color,
               d.device_sku_key, d.master_sku_name,
               cp.channel_partner_id is not null as has_valid_channel_partner,
               d.program_sku_id is not null as has_valid_program_sku
        from stg_cp_skus c
        left join stg_channel_partners cp on cp.channel_partner_id = c.channel_partner_id
        left join int_device_skus d on d.program_sku_id = c.program_sku_id""",
)

# Decimal columns by name: compared as doubles.
DECIMAL = re.compile(
    r"_sar$|_vat_inclusive$|^(purchase_price|launch_rrp|quantity|units_ordered|discount_amount|"
    r"total_discount_amount|total_amount_incl_vat|payment_amount|psp_payment_amount|vat_rate|"
    r"refund_amount)$"
)


def needed(sql: str, models: dict[str, str]) -> list[str]:
    """Names of the models a query reads, directly or not, in dependency order."""
    order: list[str] = []

    def visit(text: str, path: tuple[str, ...]) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_][a-z0-9_]*\b", text)):
            if word in models and word not in order and word not in path:
                visit(models[word], (*path, word))
                order.append(word)

    visit(sql, ())
    return order


def with_query(sql: str, models: dict[str, str] | None = None) -> str:
    """A query over the models as one self-contained statement."""
    models = SQL if models is None else models
    ctes = ",\n".join(f"{name} as ({models[name].strip()})" for name in needed(sql, models))
    return f"with {ctes}\n{sql.strip()}" if ctes else sql


def as_table(name: str, columns: list[str]) -> str:
    """A whole model, with the given columns and decimals as doubles."""
    cols = [f"cast({c} as double) as {c}" if DECIMAL.search(c) else c for c in columns]
    return with_query(f"select {', '.join(cols)} from {name}")
