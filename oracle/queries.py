"""Oracle SQL of every registered query."""

from __future__ import annotations

from oracle.models import DECIMAL, SQL, TODAY, half_up, k, lc, month, with_query
from subscope.quality import contracts
from subscope.schemas import RAW_DDL
from subscope.quality.checks import Check

ORACLE: dict[str, str] = {}


def put(name: str, sql: str) -> None:
    ORACLE[name] = with_query(sql)


def dbl(x: str) -> str:
    return f"cast({x} as double)"


def share(a: str, b: str) -> str:
    return f"{dbl(a)} / nullif({dbl(b)}, 0)"


def cnt(p: str) -> str:
    return f"count(case when {p} then 1 end)"


def total(x: str, p: str | None = None) -> str:
    return dbl(f"sum({x})" if p is None else f"sum(case when {p} then {x} end)")


def avg(x: str, p: str | None = None) -> str:
    e = x if p is None else f"case when {p} then {x} end"
    return share(f"sum({e})", f"count({e})")


def uniq(x: str, p: str | None = None) -> str:
    return f"count(distinct {x})" if p is None else f"count(distinct case when {p} then {x} end)"


# --- whole models ------------------------------------------------------------------------
# Their columns are listed by the model itself; decimals are compared as doubles.

MODEL_NAMES = [n for n in SQL if n.startswith(("stg_", "int_", "fct_", "dim_", "bridge_"))]
# Decimal columns of each model: the names that match DECIMAL in its own output.
MODEL_DECIMALS = {
    "stg_invoices": "invoice_amount_sar vat_amount_sar amount_ex_vat_sar",
    "stg_countries": "vat_rate",
    "stg_cp_skus": "purchase_price",
    "stg_devices": "purchase_price",
    "stg_invoice_line_items":
        "line_amount_sar line_amount_ex_vat_sar vat_amount_sar line_amount_incl_vat_sar quantity",
    "stg_order_items":
        "quantity unit_price_vat_inclusive total_price_vat_inclusive "
        "device_purchase_price_vat_inclusive discount_amount",
    "stg_orders": "gmv_amount_sar total_discount_amount total_amount_incl_vat",
    "stg_payments": "collected_amount_sar refund_amount_sar",
    "stg_subscription_pricing": "monthly_subscription_amount_sar",
    "stg_program_skus": "launch_rrp",
    "stg_psp_payments": "payment_amount",
    "stg_psp_refunds": "refund_amount",
    "int_device_skus": "launch_rrp",
    "int_orders": "gmv_amount_sar total_discount_amount total_amount_incl_vat",
    "int_order_items":
        "quantity unit_price_vat_inclusive total_price_vat_inclusive "
        "device_purchase_price_vat_inclusive discount_amount",
    "int_subscriptions": "monthly_subscription_amount_sar",
    "int_devices": "purchase_price",
    "int_subscription_snapshots_monthly": "monthly_subscription_amount_sar",
    "int_payments_crm": "collected_amount_sar refund_amount_sar",
    "int_payments_psp": "payment_amount",
    "int_payments_unified": "collected_amount_sar refund_amount_sar psp_payment_amount",
    "int_invoices": "invoice_amount_sar vat_amount_sar amount_ex_vat_sar",
    "int_invoice_line_items":
        "line_amount_sar line_amount_ex_vat_sar vat_amount_sar line_amount_incl_vat_sar quantity "
        "monthly_subscription_amount_sar",
    "int_credit_notes": "invoice_amount_sar",
    "int_refunds": "refund_amount_sar",
    "int_finance_reconciliation":
        "collected_revenue_sar invoiced_revenue_sar finance_variance_sar "
        "unpaid_invoice_amount_sar crm_refund_amount_sar",
    "fct_orders": "gmv_amount_sar total_discount_amount total_amount_incl_vat",
    "fct_order_items":
        "quantity unit_price_vat_inclusive total_price_vat_inclusive "
        "device_purchase_price_vat_inclusive discount_amount",
    "dim_device_skus": "units_ordered order_item_revenue_sar",
    "fct_subscriptions": "monthly_recurring_amount_sar",
    "fct_subscription_monthly_snapshots": "monthly_subscription_amount_sar",
    "dim_subscription_pricing": "monthly_subscription_amount_sar total_mrr_sar",
    "fct_payments": "collected_amount_sar refund_amount_sar psp_payment_amount",
    "fct_psp_transactions": "payment_amount",
    "fct_invoices": "invoice_amount_sar vat_amount_sar amount_ex_vat_sar",
    "fct_invoice_line_items":
        "line_amount_sar line_amount_ex_vat_sar vat_amount_sar line_amount_incl_vat_sar quantity",
    "fct_credit_notes": "related_invoice_amount_sar credit_value_sar",
    "fct_refunds": "refund_amount_sar",
    "fct_finance_reconciliation_monthly":
        "collected_revenue_sar invoiced_revenue_sar finance_variance_sar "
        "unpaid_invoice_amount_sar crm_refund_amount_sar",
    "fct_devices": "purchase_price",
    "bridge_cp_skus": "purchase_price",
}
for _name in MODEL_NAMES:
    _dec = MODEL_DECIMALS.get(_name, "").split()
    assert all(DECIMAL.search(c) for c in _dec)
    _swap = f" replace ({', '.join(f'{dbl(c)} as {c}' for c in _dec)})" if _dec else ""
    put(_name, f"select *{_swap} from {_name}")

# --- scans and sinks ------------------------------------------------------------------

_RAW = [t for t in SQL if t.startswith(("crm_", "payments_"))]
_GONE = {
    "payments_refunds": "_etl_deleted_at is null", "payments_transactions": "_etl_deleted_at is null",
}
put("scan_raw_tables", " union all ".join(
    f"select '{t}' as table_name, count(*) as row_count, "
    + cnt(_GONE.get(t, "deleted_at is null" if t.startswith("payments_") else "deleted = false"))
    + f" as live_count from {t}" for t in _RAW
))
put("live_rows_by_flag", "select id, deleted from crm_orders where deleted = false")
put("live_rows_by_deletion_time",
    "select id, transaction_id from payments_payments where deleted_at is null")
put("model_reference",
    "select partner_name, program_name, count(*) as orders from int_orders group by all")
put("date_spine", """
    select date_day, count(o.order_id) as orders from (
        select cast(unnest(generate_series(min(order_date), max(order_date) - 1, interval 1 day)) as date)
               as date_day from fct_orders) left join fct_orders o on o.order_date = date_day
    group by date_day""")
put("calendar_of_column", """
    select d as date, cast(year(d) as int) as year, cast(month(d) as int) as month_no,
           monthname(d) as month, cast(quarter(d) as int) as quarter_no,
           'Qtr ' || quarter(d) as quarter, cast(day(d) as int) as day
    from (select cast(unnest(generate_series(make_date(year(min(created_at)), 1, 1),
              make_date(year(max(created_at)), 12, 31), interval 1 day)) as date) as d
          from stg_orders)""")
put("mart_written_and_read", f"""
    select cast(year(subscription_date) as int) as year, subscription_status,
           count(*) as subscriptions, {total('monthly_recurring_amount_sar')} as amount_sar
    from fct_subscriptions group by 1, 2""")
put("mart_versions", """
    select cast(year(subscription_date) as int) as year, 'first' as version, count(*) as subscriptions
    from fct_subscriptions where is_active_subscription group by 1 union all
    select cast(year(subscription_date) as int), 'current', count(*) from fct_subscriptions group by 1""")
put("bucketed_fact_join", f"""
    select sales_channel, count(*) as items, {cnt('is_gmv_eligible')} as eligible_items
    from fct_order_items join (select order_id, sales_channel, is_gmv_eligible from fct_orders) using (order_id)
    group by 1""")
put("view_registered",
    "select payment_status, count(*) as payments from stg_payments group by payment_status")

# --- projections and predicates ----------------------------------------------------------

put("rename_and_project",
    "select id as order_id, trim(name) as order_number, date_entered as ordered_at from crm_orders")
put("status_flags", f"""
    select id, {lc('order_status')} = 'delivered' as is_delivered,
           {lc('order_status')} in ('expired', 'cancelled', 'rejected') as is_voided,
           {lc('order_status')} not in ('expired', 'cancelled', 'rejected') as is_kept
    from crm_orders""")
put("case_insensitive_match", f"""
    select id, {lc('is_mobile_verified')} = 'yes' as is_yes,
           contains(lower(name), 'customer#00000001') as is_low_number from crm_accounts""")
put("match_flag_after_join", """
    select o.order_id, o.customer_id, a.customer_id as known_id,
           a.customer_id is not null as has_valid_customer
    from stg_orders o left join stg_accounts a using (customer_id)""")
put("segment_labels", """
    select case when gmv_amount_sar is null then 'unknown' when gmv_amount_sar > 300000 then 'large'
                when gmv_amount_sar > 100000 then 'medium' else 'small' end as segment,
           count(*) as orders from stg_orders group by 1""")
put("over_limit", "select program_id, is_over_subscription_limit as is_over from int_programs")
put("indicator_of_flag", f"""
    select api_source, {cnt('is_failure')} as failures from stg_api_logs group by 1""")
put("flags_combined", """
    select payment_history_id, is_failed_attempt is true and psp_is_retry_queue is true
           as is_outstanding from int_payment_attempts""")
put("first_known_of_paths", """
    select order_item_id, coalesce(program_sku_id, resolved_program_sku_id, 'none') as catalog_id
    from int_order_items""")
put("typed_nulls_for_union", """
    select source, gateway, is_default, count(*) as methods from (
        select 'crm' as source, null as gateway, is_default from stg_payment_methods union all
        select 'psp', payment_gateway, null from stg_psp_payment_methods) group by all""")
put("star_plus_column", """
    select subscription_pricing_id,
           cast(monthly_subscription_amount_sar as double) as monthly_subscription_amount_sar,
           cast(monthly_subscription_amount_sar * 12 as double) as yearly_amount_sar
    from stg_subscription_pricing""")
put("filter_flag_and_amount", """
    select payment_id, cast(refund_amount_sar as double) as refund_amount_sar
    from stg_payments where is_refunded and refund_amount_sar > 0""")

# --- joins ----------------------------------------------------------------------------

put("lookup_join", """
    select i.invoice_id, i.customer_id, a.customer_name, a.customer_id is not null as has_valid_customer
    from stg_invoices i left join stg_accounts a on a.customer_id = i.customer_id""")
put("inner_join_then_count", """
    select program_id, count(*) as subscriptions
    from stg_subscriptions s join stg_orders o on s.order_id = o.order_id group by program_id""")
put("exploded_rows_keep_parent", """
    select subscription_id, subscription_status, count(*) as months
    from int_subscription_snapshots_monthly group by all""")
put("polymorphic_lookup", """
    select a.api_log_id, a.parent_type, a.parent_id,
           case lower(trim(parent_type)) when 'orders' then o.customer_id
                when 'subscriptions' then s.customer_id when 'accounts' then a.parent_id end as customer_id
    from stg_api_logs a left join stg_orders o on o.order_id = a.parent_id
    left join stg_subscriptions s on s.subscription_id = a.parent_id""")
put("role_playing_dimension", """
    select p1.partner_name as order_partner, p2.partner_name as customer_partner, count(*) as orders
    from int_orders o left join stg_accounts a on a.customer_id = o.customer_id
    left join stg_channel_partners p1 on p1.channel_partner_id = o.channel_partner_id
    left join stg_channel_partners p2 on p2.channel_partner_id = a.channel_partner_id group by all""")
put("sku_over_bridge", """
    select order_item_id, device_sku_key, master_sku_id, brand, resolved_program_sku_id,
           has_valid_resolved_sku from int_order_items""")
put("rollup_joined_to_dimension", f"""
    select a.customer_id, a.customer_name, count(o.order_id) as orders,
           {total('o.gmv_amount_sar')} as gmv_sar
    from stg_accounts a left join stg_orders o on o.customer_id = a.customer_id group by 1, 2""")
put("merge_aggregates_by_key", """
    select channel_partner_id, if(channel_partner_id is null, 0, sum(s)) ::bigint as subscriptions,
           if(channel_partner_id is null, 0, sum(i)) ::bigint as invoices,
           if(channel_partner_id is null, 0, sum(c)) ::bigint as customers
    from (select channel_partner_id, 1 as s, 0 as i, 0 as c from stg_subscriptions union all
          select channel_partner_id, 0, 1, 0 from stg_invoices union all
          select channel_partner_id, 0, 0, 1 from stg_accounts) group by channel_partner_id""")
put("reconcile_two_systems", f"""
    select psp_reconciliation_status, reconciliation_gap_reason, is_psp_reconciled,
           count(*) as payments, {total('collected_amount_sar')} as collected_sar,
           {total('psp_payment_amount')} as psp_sar from int_payments_unified group by 1, 2, 3""")
put("join_to_deduplicated", """
    select x.transaction_id, min(p.psp_payment_id) as psp_payment_id from stg_psp_transactions x
    left join stg_psp_payments p using (transaction_id) group by 1""")
put("fact_to_dimension_blank_member", """
    select p.program_name, count(*) as items from int_order_items i
    left join stg_programs p on p.program_id = i.program_id group by 1""")
put("orphan_keys", """
    select customer_id as fk, count(*) as n from stg_orders where customer_id is not null
    and customer_id not in (select customer_id from stg_accounts) group by 1""")
put("sliced_facts", """
    select channel_partner_id, order_status, count(*) as orders from int_orders
    where channel_partner_id in (select channel_partner_id from stg_channel_partners
                                 where partner_name in ('ASIA', 'EUROPE')) group by 1, 2""")

# --- aggregations ---------------------------------------------------------------------

put("count_by_key", "select product_type, count(*) as items from stg_order_items group by 1")
put("conditional_count", f"""
    select program_id, {cnt('is_preorder')} as preorders,
           {cnt("order_status = 'delivered'")} as delivered from stg_orders group by 1""")
put("conditional_sum", f"""
    select payment_type, {total('collected_amount_sar', 'is_collected')} as collected_sar,
           {total('refund_amount_sar', 'is_refunded')} as refunded_sar,
           cast(null as double) as nothing_sar from stg_payments group by 1""")
put("sum_by_key", f"""
    select program_sku_id, {total('quantity')} as units, {total('total_price_vat_inclusive')} as revenue
    from stg_order_items group by 1""")
put("distinct_count", f"select brand, {uniq('order_id')} as orders from int_devices group by 1")
put("conditional_distinct_count", f"""
    select transaction_type, {uniq('subscriber_id', 'is_retry_queue')} as subscribers_on_retry
    from stg_psp_transactions group by 1""")
put("first_and_last_dates", """
    select brand, min(purchase_date) as first_purchase, max(delivery_date) as last_delivery
    from stg_devices group by 1""")
put("first_event_per_key", """
    select order_id, min(paid_at) as first_paid_at from stg_payments
    where is_collected and order_id is not null group by 1""")
put("average", f"""
    select product_type, {avg('subscription_term_months')} as avg_term,
           {avg('monthly_subscription_amount_sar')} as avg_amount from int_subscriptions group by 1""")
put("exact_median", """
    select sales_channel, cast(median(date_diff('day', cast(created_at as date), delivered_at)) as double)
           as median_days from stg_orders where delivered_at is not null group by 1""")
put("median_by_ranks", """
    select sales_channel, (max(x) filter (where place = (n + 1) // 2) + max(x) filter (where place = n // 2 + 1)) / 2
           as median_gmv_sar
    from (select sales_channel, cast(gmv_amount_sar as double) as x,
                 row_number() over (partition by sales_channel order by gmv_amount_sar) as place,
                 count(*) over (partition by sales_channel) as n
          from fct_orders where gmv_amount_sar is not null)
    group by 1""")
put("failure_rate", f"""
    select parent_type, {half_up(cnt('is_failure'), 'count(*)')} as failure_rate
    from stg_api_logs group by 1""")
put("limit_utilization", f"""
    select program_id, {half_up('active_subscription_count', 'subscription_limit')} as used
    from int_programs""")
put("monthly_with_fallback_dates", f"""
    select {month('coalesce(settlement_date, invoice_date, cast(created_at as date))')} as month,
           count(*) as invoices, {total('invoice_amount_sar')} as amount_sar
    from stg_invoices group by 1""")
put("card_value", f"""
    select count(*) as orders, {total('gmv_amount_sar', 'is_gmv_eligible')} as gmv_sar from stg_orders""")

# ratios summed to 9 digits, each rounded half up, as exact integers
NINE = (
    "cast((2000000000 * cast(utilization_subscription_count as hugeint) + subscription_limit) "
    "// (2 * subscription_limit) as hugeint)"
)


def mean_of_ratios(p: str = "subscription_limit > 0") -> str:
    e = f"case when {p} then {NINE} end"
    return f"{dbl(f'sum({e})')} / 1e9 / nullif(count({e}), 0)"


put("average_of_ratios",
    f"select partner_name, {mean_of_ratios()} as mean_ratio from int_programs group by 1")
put("ratio_of_sums", f"""
    select partner_name, {share('sum(utilization_subscription_count)', 'sum(subscription_limit)')}
           as ratio from int_programs group by 1""")
put("distinct_tuples", "select distinct product_type, order_line_item_type from stg_order_items")
put("latest_period_only", """
    select snapshot_quarter, subscription_status, count(*) as rows
    from fct_subscription_monthly_snapshots
    where snapshot_quarter = (select max(snapshot_quarter) from fct_subscription_monthly_snapshots)
    group by 1, 2""")


def drill(frm: str, day: str, cols: str) -> str:
    return f"""
    select cast(year({day}) as int) as year, cast(quarter({day}) as int) as quarter_no,
           cast(month({day}) as int) as month_no, cast(day({day}) as int) as day,
           cast(4 - bit_count(grouping(year({day}), quarter({day}), month({day}), day({day}))) as int)
               as level, {cols}
    from {frm} group by rollup (year({day}), quarter({day}), month({day}), day({day}))"""


put("date_hierarchy_totals", drill(
    "stg_orders", "cast(created_at as date)",
    f"count(*) as orders, {total('gmv_amount_sar')} as gmv_sar",
))
put("dedup_first_per_key", """
    select transaction_id, min(psp_payment_id) as psp_payment_id,
           cast(arg_min_null(payment_amount, psp_payment_id) as double) as payment_amount
    from stg_psp_payments where transaction_id is not null group by 1""")
put("ranked_categories", f"""
    select product_type, {total('total_price_vat_inclusive')} as revenue
    from stg_order_items group by 1 order by 2 desc, 1""")
put("conformed_union", """
    select 'customer' as party_type, customer_id as party_id, created_at, card_last_four
    from stg_payment_methods union all
    select 'subscriber', subscriber_id, created_at, card_last_four from stg_psp_payment_methods""")
put("union_of_keys", """
    select customer_id from stg_orders union select customer_id from stg_invoices
    union select customer_id from stg_payments""")
put("distinct_customers_in_either", """
    select count(distinct customer_id) as customers from (
        select customer_id from stg_invoices where not is_paid union all
        select customer_id from stg_payments where is_failed)""")
put("monthly_merge_parts", f"""
    select mon as reconciliation_month,
           cast(if(mon is null, 0, sum(p)) as bigint) as collected_payment_count,
           cast(if(mon is null, 0, sum(i)) as bigint) as paid_invoice_count,
           cast(if(mon is null, 0, sum(c)) as bigint) as credit_note_count
    from (select {month('paid_at')} as mon, 0 as p, 0 as i, 0 as c from stg_payments where is_refunded
          union all
          select {month('coalesce(invoice_date, settlement_date, cast(created_at as date))')}, 0, 1, 0
          from stg_invoices where is_paid
          union all select {month('created_at')}, 0, 0, 1 from stg_credit_notes) group by mon""")

# --- scalar functions -------------------------------------------------------------------


def scalar(name: str, table: str, cols: str) -> None:
    put(name, f"select id, {cols} from {table}")


scalar("f_trim", "crm_accounts", "trim(phone_number) as phone")
scalar("f_status_normalization", "crm_orders", f"{lc('order_status')} as status")
scalar("f_blank_key_to_null", "crm_orders", f"{k('customer_id')} as customer")
scalar("f_code_with_default", "crm_orders", f"ifnull({lc('order_type')}, 'unknown') as kind")
scalar("f_business_key", "crm_master_skus",
       "array_to_string(list_filter([trim(brand), trim(model), trim(memory), trim(color)], "
       "lambda x: x is not null), '|') as sku_key")
scalar("f_surrogate_key", "crm_payments", "md5('crm' || id) as refund_key")
scalar("f_entity_key", "crm_subscriptions",
       f"id || '-' || cast({month('service_start_date')} as varchar) as entity")
scalar("f_to_money", "crm_order_items",
       "cast(cast(total_price_vat_inclusive as decimal(18,4)) as double) as total, "
       "cast(quantity as double) as units")
scalar("f_to_int", "crm_subscription_durations", "cast(trim(duration) as int) as months")
scalar("f_to_date", "crm_payments", "cast(payment_timestamp as date) as paid_on")
scalar("f_round_half_up", "crm_orders",
       "cast((cast(total_discount_amount * 20000 as bigint) + 8) // 16 as double) / 10000 as share")
scalar("f_guarded_division", "crm_programs",
       f"{share('payment_methods_limit', 'subscription_limit')} as per_limit")
scalar("f_month_start", "crm_payments", f"{month('date_entered')} as month")
scalar("f_quarter_start", "crm_payments",
       "cast(date_trunc('quarter', date_entered) as date) as quarter")
put("f_month_series", """
    select id, cast(unnest(generate_series(date_trunc('month', service_start_date),
                    date_trunc('month', subscription_close_date), interval 1 month)) as date) as month
    from crm_subscriptions""")
scalar("f_date_parts", "crm_orders",
       "cast(year(date_entered) as int) as y, cast(quarter(date_entered) as int) as q, "
       "cast(month(date_entered) as int) as m, cast(day(date_entered) as int) as d")
scalar("f_day_of_week", "crm_orders",
       "cast(dayofweek(date_entered) as int) as day_of_week, "
       "dayofweek(date_entered) in (5, 6) as is_weekend")
scalar("f_period_labels", "crm_orders",
       "strftime(date_entered, '%Y-%m') as year_month, "
       "year(date_entered) || '-Q' || quarter(date_entered) as year_quarter")
scalar("f_card_expired", "crm_payment_methods",
       "case when expiry_year is null or expiry_month is null then false "
       f"when expiry_month <= 12 then make_date(expiry_year, least(expiry_month, 12), 1) < "
       f"date_trunc('month', {TODAY}) end as is_expired")
scalar("f_whole_days", "crm_orders",
       "cast(delivered_on - cast(date_entered as date) as int) as days")
scalar("f_day_boundaries", "crm_payments",
       "cast(date_diff('day', date_entered, payment_timestamp) as int) as days")
scalar("f_first_timestamp", "crm_payments", "ifnull(payment_timestamp, date_entered) as paid_at")
scalar("f_division_or_zero", "crm_programs",
       f"ifnull({share('payment_methods_limit', 'subscription_limit')}, 0) as per_limit")
scalar("f_count_is_zero_not_blank", "crm_orders",
       "cast(ifnull(date_diff('day', cast(date_entered as date), delivered_on), 0) as int) as days")
scalar("f_hierarchy_labels", "crm_orders",
       "monthname(date_entered) as month, 'Qtr ' || quarter(date_entered) as quarter, "
       "cast(quarter(date_entered) as int) as quarter_no")

# --- metrics --------------------------------------------------------------------------

LINKS = {  # group-by name -> (expression, join)
    "channel_partner__partner_name": (
        "cp.partner_name",
        "left join stg_channel_partners cp on cp.channel_partner_id = f.channel_partner_id"),
    "program__program_name": (
        "pg.program_name", "left join stg_programs pg on pg.program_id = f.program_id"),
    "corporate_company__company_name": (
        "co.company_name",
        "left join stg_corporate_companies co on co.corporate_company_id = f.corporate_company_id"),
    "customer__customer_verification_segment": (
        "cu.customer_verification_segment",
        "left join dim_customers cu on cu.customer_id = f.customer_id"),
}
TIMES = {
    "fct_orders": "order_date", "fct_order_items": "order_item_date", "dim_customers": "created_at",
    "dim_programs": "created_at", "fct_subscriptions": "subscription_date",
    "fct_subscription_monthly_snapshots": "snapshot_month", "fct_payments": "payment_date",
    "fct_payment_attempts": "attempt_date", "fct_psp_transactions": "transaction_date",
    "dim_payment_methods": "created_at", "fct_invoices": "invoice_date",
    "fct_credit_notes": "credit_note_date", "fct_devices": "purchase_date",
    "fct_finance_reconciliation_monthly": "reconciliation_month",
    "fct_partner_api_events": "event_date", "fct_refunds": "refund_date",
    "dim_subscription_durations": "created_at",
}


def by(mart: str, value: str, name: str, keys=(), grain: str | None = None, where: str = "true") -> str:
    cols, joins = [], []
    if grain:
        cols.append(f"cast(date_trunc('{grain}', f.{TIMES[mart]}) as date) as metric_time")
    for key in keys:
        expr, join = LINKS.get(key, (f"f.{key}", ""))
        cols.append(f"{expr} as {key}")
        joins.append(join)
    group = f"group by {', '.join(str(i + 1) for i in range(len(cols)))}" if cols else ""
    select = ", ".join([*cols, f"{value} as {name}"])
    return f"select {select} from {mart} f {' '.join(joins)} where {where} {group}"


_DAYS = "date_diff('day', order_date, delivered_at)"
_REC = "is_recurring_installment"
_O, _S, _SN = "fct_orders", "fct_subscriptions", "fct_subscription_monthly_snapshots"
_PA, _PR, _API = "fct_payment_attempts", "dim_programs", "fct_partner_api_events"

METRIC_SQL: dict[str, tuple[str, ...]] = {  # mart, value, condition
    "order_count": (_O, "count(*)", "is_gmv_eligible"),
    "gmv_sar": (_O, total("gmv_amount_sar"), "is_gmv_eligible"),
    "preorder_order_share": (_O, share(cnt("is_preorder"), "count(*)")),
    "preorder_order_count": (_O, cnt("is_preorder")),
    "orders_total_count": (_O, "count(*)"),
    "avg_days_payment_to_delivery": (
        _O, avg(_DAYS), "is_gmv_eligible and delivered_at is not null"),
    "median_order_to_delivery_days": (_O, dbl(f"median({_DAYS})"), "delivered_at is not null"),
    "order_item_count": ("fct_order_items", "count(*)"),
    "subscription_count": (_S, "count(*)"),
    "active_subscription_count": (_S, "count(*)", "is_active_subscription"),
    "mrr_sar": (_S, total("monthly_recurring_amount_sar"), "is_mrr_eligible"),
    "avg_subscription_term_months": (_S, avg("subscription_term_months"), "is_mrr_eligible"),
    "churn_rate": (_SN, share(cnt("is_churned"), cnt("is_active_at_quarter_start"))),
    "churned_subscriptions_in_quarter": (_SN, cnt("is_churned")),
    "active_subscriptions_at_quarter_start": (_SN, cnt("is_active_at_quarter_start")),
    "churned_subscriptions_in_month": (_SN, cnt("is_churned")),
    "active_subscriptions_at_month_end": (_SN, cnt("is_active")),
    "upgrade_rate": (_S, share(cnt("is_upgraded_or_kifed"), "count(*)")),
    "upgraded_subscription_count": (_S, cnt("is_upgraded_or_kifed")),
    "collected_revenue_sar": ("fct_payments", total("collected_amount_sar"), "is_collected"),
    "invoiced_revenue_sar": ("fct_invoices", total("invoice_amount_sar"), "is_paid"),
    "finance_variance_sar": (
        "fct_finance_reconciliation_monthly", total("finance_variance_sar")),
    "payment_failure_rate": (_PA, share(cnt(f"{_REC} and is_failed_attempt"), cnt(_REC))),
    "recurring_failed_payment_attempts": (_PA, cnt(f"{_REC} and is_failed_attempt")),
    "recurring_payment_attempts_total": (_PA, cnt(_REC)),
    "failed_payment_attempts": (_PA, cnt("is_failed_attempt")),
    "payment_attempts_total": (_PA, "count(*)"),
    "customers_on_retry_count": (
        "fct_psp_transactions", uniq("subscriber_id", "is_retry_queue")),
    "refund_amount_sar": ("fct_refunds", total("refund_amount_sar")),
    "credit_note_count": ("fct_credit_notes", "count(*)"),
    "verified_customer_count": ("dim_customers", "count(*)", "is_fully_verified"),
    "avg_devices_per_customer": ("fct_devices", share("count(*)", uniq("f.customer_id"))),
    "devices_total": ("fct_devices", "count(*)"),
    "customers_with_devices": ("fct_devices", uniq("f.customer_id")),
    "program_subscription_utilization_pct": (
        _PR, share("sum(utilization_subscription_count)", "sum(subscription_limit)")),
    "program_utilization_subscriptions": (
        _PR, "cast(sum(utilization_subscription_count) as bigint)"),
    "program_subscription_limits": (_PR, "cast(sum(subscription_limit) as bigint)"),
    "expired_payment_method_count": ("dim_payment_methods", "count(*)", "is_expired"),
    "customers_unpaid_invoices": ("fct_invoices", uniq("f.customer_id", "not is_paid")),
    "customers_failed_payment_attempts": (_PA, uniq("f.customer_id")),
    "partner_api_failure_rate": (_API, share(cnt("is_failure"), "count(*)")),
    "partner_api_failures": (_API, cnt("is_failure")),
    "partner_api_calls_total": (_API, "count(*)"),
    "programs_over_limit_count": (_PR, "count(*)", "is_over_subscription_limit"),
}
_PARTNER, _PROGRAM = "channel_partner__partner_name", "program__program_name"
VIEWS: dict[str, tuple[tuple[str, ...], str | None]] = {
    _O: ((_PARTNER, "sales_channel"), "quarter"),
    "fct_order_items": (("brand", _PROGRAM), None),
    "dim_customers": (("customer_verification_segment", "corporate_company__company_name"), None),
    _PR: ((_PARTNER,), None),
    _S: ((_PROGRAM,), "quarter"),
    _SN: ((_PARTNER,), "quarter"),
    "fct_payments": ((_PROGRAM,), "month"),
    _PA: ((_PARTNER, "customer__customer_verification_segment"), None),
    "fct_psp_transactions": (("transaction_outcome_segment",), "week"),
    "dim_payment_methods": (("payment_method_source",), "year"),
    "fct_invoices": ((_PARTNER,), "quarter"),
    "fct_credit_notes": ((_PROGRAM,), None),
    "fct_finance_reconciliation_monthly": ((), "month"),
    "fct_devices": (("brand", _PARTNER), None),
    _API: ((_PARTNER,), "day"),
    "fct_refunds": ((_PARTNER,), "year"),
}
for _name, (_mart, _value, *_where) in METRIC_SQL.items():
    _keys, _grain = VIEWS[_mart]
    put(f"metric_{_name}", by(_mart, _value, _name, _keys, _grain, *_where))


def outstanding(keys: tuple[str, ...], grain: str) -> str:
    cols = ["metric_time", *keys]
    on = " and ".join(f"a.{c} is not distinct from b.{c}" for c in cols)
    picked = ", ".join(f"if(b.n is null, a.{c}, b.{c}) as {c}" for c in cols)
    return f"""
    select {picked}, a.m + b.n as customers_with_outstanding_payments
    from ({by('fct_invoices', uniq('f.customer_id', 'not is_paid'), 'm', keys, grain)}) a
    full join ({by(_PA, uniq('f.customer_id'), 'n', keys, grain)}) b on {on}"""


put("metric_customers_with_outstanding_payments", outstanding((_PARTNER,), "quarter"))
put("metric_derived_by_time", outstanding((), "month"))
put("metrics_in_one_pass", f"""
    select cast(date_trunc('month', order_date) as date) as metric_time, order_status,
           count(*) as orders_total_count, {cnt('is_preorder')} as preorder_order_count
    from fct_orders group by 1, 2""")
put("metric_ratio_unsliced",
    f"select {share(cnt('is_preorder'), 'count(*)')} as preorder_order_share from fct_orders")
put("metric_by_linked_dimension", by(
    _O, total("gmv_amount_sar"), "gmv_sar", ("customer__customer_verification_segment",),
    where="is_gmv_eligible"))
put("metric_filled_periods", f"""
    select d as metric_time, ifnull({total('o.gmv_amount_sar')}, 0) as gmv_sar from (
        select cast(unnest(generate_series(min(order_date), max(order_date), interval 1 day)) as date)
               as d from fct_orders)
    left join fct_orders o on o.order_date = d and o.is_gmv_eligible group by d""")
put("metric_filtered_and_sliced", """
    select o.order_type, count(*) as order_count from fct_orders o
    join stg_channel_partners p using (channel_partner_id)
    where is_gmv_eligible and gmv_amount_sar > 50000 and partner_name in ('AMERICA', 'ASIA')
    group by 1""")
MEASURE_SQL = {
    "customers_total_count": ("dim_customers", "count(*)"),
    "total_device_count": ("dim_customers", "cast(sum(device_count) as bigint)"),
    "programs_total_count": (_PR, "count(*)"),
    "avg_program_utilization_pct": (_PR, share(
        "sum(cast(program_subscription_utilization_pct as decimal(18,4)))",
        "count(program_subscription_utilization_pct)")),
    "snapshot_subscriptions_count": (_SN, "count(*)"),
    "duration_term_months_avg": ("dim_subscription_durations", avg("duration_months")),
    "payment_methods_total_count": ("dim_payment_methods", "count(*)"),
    "collected_revenue_monthly_total": (
        "fct_finance_reconciliation_monthly", total("collected_revenue_sar")),
    "invoiced_revenue_monthly_total": (
        "fct_finance_reconciliation_monthly", total("invoiced_revenue_sar")),
}
for _name, (_mart, _value) in MEASURE_SQL.items():
    put(f"measure_{_name}", by(_mart, _value, _name, (), "year"))

# --- KPIs -----------------------------------------------------------------------------

_EL = "is_gmv_eligible"
KPI_SQL: dict[str, tuple[str, str]] = {
    "orders": (_O, cnt(_EL)),
    "gmv_sar": (_O, total("gmv_amount_sar", _EL)),
    "preorder_share": (_O, f"ifnull({share(cnt(f'{_EL} and is_preorder'), cnt(_EL))}, 0)"),
    "avg_days_payment_to_delivery": (
        _O, avg("date_diff('day', cast(first_paid_at as date), delivered_at)", _EL)),
    "median_order_to_delivery_days": (_O, dbl(f"median({_DAYS})")),
    "order_items": ("fct_order_items", "count(*)"),
    "subscriptions": (_S, "count(*)"),
    "active_subscriptions": (_S, cnt("is_active_subscription")),
    "mrr_sar": (_S, total("monthly_recurring_amount_sar", "is_mrr_eligible")),
    "avg_subscription_term_months": (_S, avg("subscription_term_months", "is_mrr_eligible")),
    "collected_revenue_sar": ("fct_payments", total("collected_amount_sar", "is_collected")),
    "invoiced_revenue_sar": ("fct_invoices", total("invoice_amount_sar", "is_paid")),
    "finance_variance_sar": ("fct_finance_reconciliation_monthly", total("finance_variance_sar")),
    "payment_failure_rate": (
        _PA, f"ifnull({share(cnt(f'{_REC} and is_failed_attempt'), cnt(_REC))}, 0)"),
    "customers_on_retry": (_PA, uniq("customer_id", "is_outstanding_retry_failure")),
    "refund_amount_sar": ("fct_refunds", total("refund_amount_sar")),
    "credit_notes": ("fct_credit_notes", "count(*)"),
    "credit_note_value_sar": ("fct_credit_notes", total("credit_value_sar")),
    "verified_customers": ("dim_customers", cnt("is_fully_verified")),
    "avg_devices_per_customer": ("dim_customers", avg("device_count")),
    "program_subscription_utilization": (_PR, mean_of_ratios()),
    "expired_payment_methods": ("dim_payment_methods", cnt("is_expired")),
    "partner_api_failure_rate": (_API, f"ifnull({share(cnt('is_failure'), 'count(*)')}, 0)"),
    "partner_api_failures": (_API, "cast(sum(case when is_failure then failure_count end) as bigint)"),
    "programs_over_limit": (_PR, cnt("is_over_subscription_limit")),
    "disabled_programs": (_PR, cnt("is_disabled_program")),
}
for _name, (_mart, _value) in KPI_SQL.items():
    put(f"kpi_{_name}", f"select {_value} as {_name} from {_mart}")


def quarter_rate(event: str, name: str) -> str:
    return f"""
    select ifnull({share(cnt(event), cnt('is_active_at_quarter_start'))}, 0) as {name} from {_SN}
    where snapshot_quarter = (select max(snapshot_quarter) from {_SN})"""


put("kpi_churn_rate", quarter_rate("is_churned", "churn_rate"))
put("kpi_upgrade_rate", quarter_rate("is_upgraded or is_kifed", "upgrade_rate"))
put("kpi_churn_rate_by_quarter", f"""
    select snapshot_quarter,
           ifnull({share(cnt('is_churned'), cnt('is_active_at_quarter_start'))}, 0) as churn_rate
    from {_SN} group by 1""")
put("kpi_upgrade_rate_by_partner", f"""
    select partner as channel_partner__partner_name,
           ifnull({share(cnt('is_upgraded or is_kifed'), cnt('is_active_at_quarter_start'))}, 0)
               as upgrade_rate
    from (select s.*, p.partner_name as partner,
                 max(snapshot_quarter) over (partition by p.partner_name) as newest
          from {_SN} s left join stg_channel_partners p using (channel_partner_id))
    where snapshot_quarter = newest group by 1""")
_OWING = """
    select customer_id, channel_partner_id from fct_invoices where is_paid is not true union all
    select customer_id, channel_partner_id from fct_payment_attempts
    where is_outstanding_retry_failure"""
put("kpi_customers_with_outstanding_payments", f"""
    select count(distinct customer_id) as customers_with_outstanding_payments from ({_OWING})""")
put("kpi_outstanding_by_partner", f"""
    select p.partner_name as channel_partner__partner_name,
           count(distinct customer_id) as customers_with_outstanding_payments
    from ({_OWING}) o left join stg_channel_partners p using (channel_partner_id)
    where customer_id is not null group by 1""")

put("distinct_states_by_partner_and_total", f"""
    select 'partner' as level, p.partner_name as channel_partner__partner_name,
           count(distinct customer_id) as customers_with_outstanding_payments
    from ({_OWING}) o left join stg_channel_partners p using (channel_partner_id)
    where customer_id is not null group by all union all
    select 'total', null, count(distinct customer_id) from ({_OWING})""")

# --- report datasets --------------------------------------------------------------------


def report(name: str, mart: str, values: str, key: str) -> None:
    expr, join = {
        "partner_name": ("cp.partner_name", LINKS[_PARTNER][1]),
        "program_name": ("pg.program_name", LINKS[_PROGRAM][1]),
        "company_name": ("co.company_name", LINKS["corporate_company__company_name"][1]),
    }.get(key, (f"f.{key}", ""))
    put(name, f"select {expr} as {key}, {values} from {mart} f {join} group by 1")


report("report_sales_gmv_by_partner", _O, f"{total('gmv_amount_sar', _EL)} as gmv_sar", "partner_name")
report("report_sales_gmv_by_date", _O, f"{total('gmv_amount_sar', _EL)} as gmv_sar", "order_date")
put("report_sales_gmv_date_drill", drill(
    "fct_orders", "order_date",
    f"{cnt(_EL)} as orders, {total('gmv_amount_sar', _EL)} as gmv_sar"))
report("report_sales_items_by_brand", "fct_order_items", "count(*) as order_items", "brand")
put("report_sales_items_by_partner_device", f"""
    select cp.partner_name, brand, memory, color, count(*) as order_items
    from fct_order_items f {LINKS[_PARTNER][1]} group by all""")
put("report_sales_top_models_by_partner", f"""
    select * from (select *, cast(row_number() over (partition by partner_name
            order by order_items desc, brand nulls last, model nulls last) as int) as rank
        from (select cp.partner_name, brand, model, count(*) as order_items
              from fct_order_items f {LINKS[_PARTNER][1]} group by all)) where rank <= 3""")
report("report_subscriptions_mrr_by_program", _S,
       f"{total('monthly_recurring_amount_sar', 'is_mrr_eligible')} as mrr_sar", "program_name")
put("report_subscriptions_by_status", f"""
    select subscription_status, count(*) as subscriptions,
           {share('count(*)', 'sum(count(*)) over ()')} as share from {_S} group by 1""")
report("report_subscriptions_by_partner", _S, "count(*) as subscriptions", "partner_name")
put("report_finance_by_month", """
    select reconciliation_month, cast(collected_revenue_sar as double) as collected_revenue_sar,
           cast(invoiced_revenue_sar as double) as invoiced_revenue_sar,
           cast(finance_variance_sar as double) as finance_variance_sar
    from fct_finance_reconciliation_monthly""")
put("report_executive_finance", """
    select reconciliation_month, cast(collected_revenue_sar as double) as collected_revenue_sar,
           cast(invoiced_revenue_sar as double) as invoiced_revenue_sar
    from fct_finance_reconciliation_monthly""")
report("report_finance_refunds_by_partner", "(select * exclude (partner_name) from fct_refunds)",
       f"{total('refund_amount_sar')} as refund_amount_sar", "partner_name")
report("report_finance_credit_notes_by_partner", "fct_credit_notes",
       f"count(*) as credit_notes, {total('credit_value_sar')} as credit_note_value_sar",
       "partner_name")
report("report_customers_verified_by_company", "stg_accounts",
       f"{cnt('is_fully_verified')} as verified_customers", "company_name")
put("report_customers_utilization_by_program", f"""
    select program_name, {mean_of_ratios()} as program_subscription_utilization
    from dim_programs group by 1""")
put("report_operations_delivery_days_by_partner", by(
    _O, dbl(f"median({_DAYS})"), "median_order_to_delivery_days", (_PARTNER,),
    where="delivered_at is not null").replace(f"as {_PARTNER}", "as partner_name"))
report("report_operations_api_failures_by_partner", _API,
       f"ifnull({share(cnt('is_failure'), 'count(*)')}, 0) as partner_api_failure_rate",
       "partner_name")
put("report_operations_program_limits", """
    select program_name, partner_name, is_over_subscription_limit,
           cast(sum(subscription_limit) as bigint) as subscription_limit,
           cast(sum(utilization_subscription_count) as bigint) as utilization_subscription_count
    from dim_programs group by 1, 2, 3""")
put("orders_by_partner_program_month", f"""
    select cast(date_trunc('month', order_date) as date) as metric_time, cp.partner_name,
           pg.program_name, count(*) as order_count, {total('gmv_amount_sar')} as gmv_sar
    from fct_orders f {LINKS[_PARTNER][1]} {LINKS[_PROGRAM][1]}
    where is_gmv_eligible group by 1, 2, 3""")
for _slicer, (_table, _col) in {
    "partner": ("stg_channel_partners", "partner_name"),
    "program": ("stg_programs", "program_name"),
    "subscription_status": ("stg_subscriptions", "subscription_status"),
    "quarter": (_SN, "snapshot_quarter"),
    "company": ("stg_corporate_companies", "company_name"),
}.items():
    put(f"report_slicer_{_slicer}", f"select distinct {_col} from {_table}")
put("report_sales_sliced", f"""
    select cp.partner_name, {total('gmv_amount_sar', _EL)} as gmv_sar
    from fct_orders f join stg_programs pg using (program_id) {LINKS[_PARTNER][1]}
    where pg.program_name in ('NATION_1', 'NATION_7') group by 1""")

# --- quality --------------------------------------------------------------------------


def failures(c: Check) -> str:
    def blank_padded(table: str) -> str:  # raw CHAR columns compare without trailing blanks
        if table not in RAW_DDL:
            return table
        pairs = [x.strip().split(" ", 1) for x in RAW_DDL[table].split(", ")]
        texts = [n for n, kind in pairs if kind.startswith("string")]
        return f"(select * replace ({', '.join(f'rtrim({n}) as {n}' for n in texts)}) from {table})"

    col, rows = c.columns[0], f"(select * from {blank_padded(c.table)} where {c.where or 'true'})"
    if c.kind == "not_null":
        return f"select count(*) - count({col}) from {c.table}"
    if c.kind in ("unique", "unique_combination"):
        cols = ", ".join(c.columns)
        known = f"where {col} is not null" if c.kind == "unique" else ""
        return f"select count(*) from (select 1 from {rows} {known} group by {cols} having count(*) > 1)"
    if c.kind == "relationships":
        return (
            f"select count(*) from {rows} where {col} is not null and {col} not in "
            f"(select {c.parent_key} from {blank_padded(c.parent)} where {c.parent_key} is not null)"
        )
    listed = ", ".join(f"'{v}'" for v in c.values)
    return f"select count(distinct {col}) from {rows} where {col} not in ({listed})"


def audit(checks: list[Check]) -> str:
    bad = {"warn": "warn", "error": "fail"}
    return " union all ".join(
        f"select '{c.kind}' as \"check\", '{c.table}' as model, '{c.column}' as \"column\", "
        f"'{c.severity}' as severity, n as failures, if(n = 0, 'pass', '{bad[c.severity]}') as status "
        f"from (select ({failures(c)}) as n)" for c in checks
    )


for _kind in ("not_null", "unique", "relationships", "accepted_values"):
    put(f"quality_{_kind}", audit([c for c in contracts.raw_checks() if c.kind == _kind]))
put("quality_unique_combination", f"""
    select count(*) as failures from (select 1 from {_SN}
        group by subscription_id, snapshot_month having count(*) > 1)""")
put("quality_duplicates_found", """
    select count(*) as failures from (select 1 from stg_order_items
        group by order_id, product_type having count(*) > 1)""")
put("quality_conditional", audit([
    c for c in contracts.checks_of(contracts.STAGED)
    if c.table in ("stg_psp_transactions", "stg_orders", "stg_payment_history")
]))
put("quality_from_contract", audit([
    Check("unique", "stg_subscriptions", ("subscription_id",)),
    Check("not_null", "stg_subscriptions", ("subscription_id",)),
    Check("not_null", "stg_subscriptions", ("channel_partner_id",)),
    Check("relationships", "stg_subscriptions", ("order_id",), "warn",
          parent="stg_orders", parent_key="order_id"),
    Check("relationships", "stg_subscriptions", ("customer_id",),
          parent="stg_accounts", parent_key="customer_id"),
    Check("accepted_values", "stg_subscriptions", ("subscription_status",),
          values=("active", "cancelled", "upgraded")),
]))
put("quality_sales_marts", audit([
    c for c in contracts.checks_of(contracts.MARTS) if c.table in ("fct_orders", "dim_programs")
]))

for _layer, _specs in (("staged", contracts.STAGED), ("conformed", contracts.CONFORMED), ("marts", contracts.MARTS)):
    put(f"quality_{_layer}", audit(contracts.checks_of(_specs)))
put("quality_tolerated_orphans", " union all ".join(f"""
    select 'relationships' as "check", '{child}' as model, '{key}' as "column", 'error' as severity,
           count(*) filter (where lost) as failures,
           if(count(*) filter (where lost) <= {share_} * count(*), 'pass', 'fail') as status
    from (select {key} not in (select {key} from {parent} where {key} is not null) as lost
          from {child} where {key} is not null)"""
    for child, key, parent, share_ in (
        ("stg_orders", "customer_id", "stg_accounts", 0.5), ("stg_payments", "order_id", "stg_orders", 0.0001))))
put("kpi_upgrade_rate_by_quarter", f"""
    select snapshot_quarter,
           ifnull({share(cnt('is_upgraded or is_kifed'), cnt('is_active_at_quarter_start'))}, 0) as upgrade_rate
    from {_SN} group by 1""")

# --- profiling ------------------------------------------------------------------------

put("profile_tables", " union all ".join(
    f"select '{t}' as table_name, count(*) as row_count, count(distinct id) as distinct_keys, "
    f"(select count(*) from (select id from {t} where id is not null group by id having count(*) > 1)) "
    f"as duplicated_keys, {cnt(gone)} as deleted_rows from {t}"
    for t, gone in ((t, "deleted_at is not null" if "deleted_at" in RAW_DDL[t].replace("_etl_deleted_at", "") else
                     "_etl_deleted_at is not null" if "_etl_deleted_at" in RAW_DDL[t] else "deleted") for t in RAW_DDL)
))
put("profile_status_values", """
    select subscription_status, count(*) as rows from crm_subscriptions group by 1""")
put("profile_orphans", " union all ".join(
    f"select '{name}' as relation, count(*) as orphan_rows, count(distinct c.{fk}) as orphan_keys "
    f"from {child} c where c.{fk} is not null and not exists "
    f"(select 1 from {parent} p where p.{pk} = c.{fk})"
    for name, child, fk, parent, pk in (
        ("orders -> customers", "stg_orders", "customer_id", "stg_accounts", "customer_id"),
        ("items -> orders", "stg_order_items", "order_id", "stg_orders", "order_id"),
        ("items -> program skus", "stg_order_items", "program_sku_id", "stg_program_skus", "program_sku_id"),
        ("subscriptions -> customers", "stg_subscriptions", "customer_id", "stg_accounts", "customer_id"),
        ("payments -> orders", "stg_payments", "order_id", "stg_orders", "order_id"),
        ("payments -> psp", "stg_payments", "psp_payment_id", "stg_psp_payments", "psp_payment_id"),
    )
))
_HISTORY = (
    "payment_history_id payment_history_name created_at updated_at payment_attempt_status "
    "is_successful_attempt is_failed_attempt payment_id payment_method_id error_code error_reason "
    "card_last_four expiry_month expiry_year action funding_type attempted_at refund_id"
).split()
put("profile_null_rates", " union all ".join(
    f"select '{c}' as \"column\", count(*) - count({c}) as null_rows, "
    f"{share(f'(count(*) - count({c}))', 'count(*)')} as null_rate, count({c}) = 0 as is_all_null "
    f"from stg_payment_history" for c in _HISTORY
))
put("profile_match_rate", f"""
    select count(*) as reference_count, count(s.psp_payment_id) as matched_count,
           {share('count(s.psp_payment_id)', 'count(*)')} as match_rate
    from stg_payments p left join (select distinct psp_payment_id from stg_psp_payments) s
      using (psp_payment_id) where p.psp_payment_id is not null""")
