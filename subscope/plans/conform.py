"""Conformed (intermediate) operators: joins, business rules and snapshots.

Arguments are DataFrames of the grain the name says. Where a caller does not need the
columns of a joined table it may pass a slimmer DataFrame (or None where allowed): a join
that adds nothing is then never planned.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions.clean import surrogate_key
from subscope.functions.dates import month_of, month_series, quarter_of
from subscope.functions.flags import over_limit_flag
from subscope.functions.ratios import utilization
from subscope.operators.aggs import count_rows, count_where, first_event_at, monthly_agg, sum_where
from subscope.operators.deltas import monthly_counts
from subscope.operators.joins import (
    enrich,
    inner_match,
    merge_by_key,
    polymorphic_lookup,
    reconcile,
    resolve_sku,
    with_rollup,
)

IN_SERVICE = "active"
AWAITING = "waiting_for_delivery"
QUARTER_MONTHS = (1, 4, 7, 10)

# Values of an API log's parent type. They name CRM modules.
PARENT_PARTNER = "channel_partners"
PARENT_ORDER = "orders"
PARENT_SUBSCRIPTION = "subscriptions"
PARENT_CUSTOMER = "accounts"


def _without(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop("_etl_synced_at", "_etl_source_system", *cols)


def int_channel_partners(partners: DataFrame) -> DataFrame:
    return _without(partners)


def int_customers(accounts: DataFrame, companies: DataFrame) -> DataFrame:
    return enrich(
        _without(accounts), companies, ("corporate_company_id", "corporate_company_id"),
        {
            "corporate_company_name": "company_name",
            "allowed_email_domains": "allowed_email_domains",
            "company_status": "company_status",
            "company_type": "company_type",
        },
        flag="has_valid_corporate_company", spread="customer_id",
    )


def int_device_skus(program_skus: DataFrame, masters: DataFrame) -> DataFrame:
    out = enrich(
        _without(program_skus).withColumnRenamed("category", "program_category"),
        masters, ("master_sku_id", "master_sku_id"),
        {
            "master_sku_name": "master_sku_name", "brand": "brand", "model": "model",
            "memory": "memory", "color": "color", "master_category": "category",
            "device_sku_key": "device_sku_key",
        },
        flag="has_valid_master_sku", spread="program_sku_id",
    )
    return out.withColumn(
        "resolved_device_sku_key", F.coalesce("device_sku_key", F.lit("sku_unknown"))
    )


def program_directory(programs: DataFrame, partners: DataFrame) -> DataFrame:
    """Programs with their partner's name and type, without any usage figures."""
    return enrich(
        _without(programs), partners, ("channel_partner_id", "channel_partner_id"),
        ["partner_name", "partner_type"], flag="has_valid_channel_partner",
    )


def int_programs(
    programs: DataFrame, partners: DataFrame, subscriptions: DataFrame, orders: DataFrame
) -> DataFrame:
    """Program with partner, subscription usage and limit rules.

    A subscription counts for the program of its order.
    """
    sold = inner_match(
        subscriptions.where(F.col("order_id").isNotNull()).select("order_id", "subscription_status"),
        orders, ("order_id", "order_id"), ["program_id"],
    )
    status = F.col("subscription_status")
    used = {
        "active_subscription_count": count_where(status == IN_SERVICE),
        "waiting_for_delivery_subscription_count": count_where(status == AWAITING),
        "utilization_subscription_count": count_where(status.isin(IN_SERVICE, AWAITING)),
    }
    out = with_rollup(
        program_directory(programs, partners), sold, ("program_id", "program_id"),
        used, fill=dict.fromkeys(used, 0),
    )
    taken, limit = "utilization_subscription_count", "subscription_limit"
    return out.withColumns({
        "program_subscription_utilization_pct": utilization(taken, limit),
        "is_over_subscription_limit": over_limit_flag(taken, limit),
        "is_disabled_program": F.col("program_status") != IN_SERVICE,
    })


def order_context(orders: DataFrame, programs: DataFrame) -> DataFrame:
    """Order with its program and partner: what other facts need to know about an order."""
    out = enrich(
        _without(orders), programs, ("program_id", "program_id"),
        ["program_name", "channel_partner_id", "partner_name", "partner_type", "is_fnf_program"],
        flag="has_valid_program", spread="order_id",
    )
    return out.withColumn("has_valid_channel_partner", F.col("channel_partner_id").isNotNull())


def int_orders(
    orders: DataFrame, programs: DataFrame, customers: DataFrame, payments: DataFrame | None
) -> DataFrame:
    """Order with program, customer and the time of its first collected payment.

    ``customers`` may be bare keys, then only the match flag is added; ``payments`` may be
    None, then no payment time is.
    """
    named = "customer_name" in customers.columns
    out = enrich(
        order_context(orders, programs), customers, ("customer_id", "customer_id"),
        {
            "customer_name": "customer_name",
            "customer_is_fully_verified": "is_fully_verified",
            "corporate_company_id": "corporate_company_id",
            "corporate_company_name": "corporate_company_name",
        } if named else (),
        flag="has_valid_customer", spread="order_id",
    )
    if payments is not None:
        paid = first_event_at(payments, "order_id", "paid_at", "is_collected", "first_paid_at")
        out = enrich(out, paid, ("order_id", "order_id"), ["first_paid_at"])
    return out


def int_order_items(
    items: DataFrame,
    orders: DataFrame | None,
    device_skus: DataFrame,
    cp_skus: DataFrame,
    masters: DataFrame,
) -> DataFrame:
    """Order item with its catalog entry and its order's program and partner.

    ``orders`` None leaves out the order.
    """
    resolved = resolve_sku(_without(items), device_skus, cp_skus, masters, spread="order_item_id")
    return resolved if orders is None else item_context(resolved, orders)


def item_context(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order item with what its order knows."""
    context = [
        "program_id", "channel_partner_id", "partner_name", "program_name", "order_status",
        "is_gmv_eligible", "has_valid_customer",
    ]
    return enrich(
        items, orders, ("order_id", "order_id"),
        [c for c in context if c in orders.columns],
        flag="has_valid_order", spread="order_item_id",
    )


def int_subscriptions(
    subscriptions: DataFrame, pricing: DataFrame, durations: DataFrame, orders: DataFrame | None
) -> DataFrame:
    """Subscription with price, term and order; decides what counts for recurring revenue.

    ``orders`` None leaves out the order.
    """
    # The term is looked up on the price list first, which is much shorter.
    priced = enrich(
        pricing.select(
            "subscription_pricing_id", "monthly_subscription_amount_sar",
            "subscription_duration_id",
        ),
        durations, ("subscription_duration_id", "subscription_duration_id"),
        {"subscription_term_months": "duration_months"},
    )
    out = enrich(
        _without(subscriptions), priced, ("subscription_pricing_id", "subscription_pricing_id"),
        ["monthly_subscription_amount_sar", "subscription_duration_id", "subscription_term_months"],
        flag="has_valid_subscription_pricing", spread="subscription_id",
    )
    out = out.withColumns({
        "is_upgraded_or_kifed": F.col("is_upgraded") | F.col("is_kifed"),
        "is_mrr_eligible": (
            F.col("is_active_subscription")
            & F.col("has_valid_subscription_pricing")
            & F.col("monthly_subscription_amount_sar").isNotNull()
        ),
    })
    return out if orders is None else subscription_context(out, orders)


def subscription_context(subscriptions: DataFrame, orders: DataFrame) -> DataFrame:
    """Subscription with what its order knows."""
    take = {
        "program_id": "program_id",
        "program_name": "program_name",
        "order_channel_partner_id": "channel_partner_id",
        "partner_name": "partner_name",
        "is_fnf_program": "is_fnf_program",
    }
    if "has_valid_customer" in orders.columns:
        take["has_valid_customer"] = "has_valid_customer"
    out = enrich(
        subscriptions, orders, ("order_id", "order_id"), take,
        flag="has_valid_order", spread="subscription_id",
    )
    if "has_valid_customer" in take:
        known = F.col("customer_id").isNotNull() & F.col("has_valid_customer")
        out = out.withColumn("has_valid_customer", known)
    return out


def int_devices(devices: DataFrame, items: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Device with the item it was sold as and the subscription on that item.

    The catalog key is added if the items carry it. Both lookups go by the device's item, so the devices
    cross one shuffle for the two.
    """
    wanted = (
        "order_id", "program_id", "channel_partner_id", "partner_name", "device_sku_key",
        "customer_id",
    )
    out = enrich(
        _without(devices), items, ("order_item_id", "order_item_id"),
        [c for c in wanted if c in items.columns],
        flag="has_valid_order_item", spread="device_id",
    )
    return enrich(
        out, subscriptions, ("order_item_id", "order_item_id"),
        ["subscription_id", "subscription_status", "is_active_subscription"],
        flag="has_valid_subscription", spread="device_id", when="has_valid_order_item",
    )


def int_customer_device_counts(
    devices: DataFrame, items: DataFrame, subscriptions: DataFrame
) -> DataFrame:
    """Devices of each customer, counted as ``int_devices`` has them: once per subscription on their item.

    Only the item's customer and order are looked up, and subscriptions come as a number per item, so
    no order, program or catalog row is moved for it.
    """
    matches = subscriptions.where(F.col("order_item_id").isNotNull()).groupBy("order_item_id").agg(
        count_rows().alias("_matches"))
    sold = enrich(
        devices.select("device_id", "order_item_id", "purchase_date", "delivery_date"),
        items, ("order_item_id", "order_item_id"), ["customer_id", "order_id"], spread="device_id",
    ).where(F.col("customer_id").isNotNull())
    counted = enrich(sold, matches, ("order_item_id", "order_item_id"), ["_matches"])
    return counted.groupBy("customer_id").agg(
        F.sum(F.coalesce("_matches", F.lit(1))).alias("device_count"),
        F.count_distinct("order_id").alias("order_count_with_devices"),
        F.min("purchase_date").alias("first_device_purchase_date"),
        F.max("delivery_date").alias("latest_device_delivery_date"),
    )


def int_subscription_snapshots_monthly(
    subscriptions: DataFrame, as_of: date | str
) -> DataFrame:
    """One row per subscription and month of its life, with what happened in that month.

    The expansion is an ``explode`` in place: no join back and no shuffle. The status is
    the current one, so a subscription that ended later is in no earlier month's base.
    """
    today = F.lit(str(as_of)).cast("date")
    begin = F.coalesce(F.col("service_started_at"), F.to_date("created_at"))
    end = F.coalesce(F.col("service_ended_at"), F.col("subscription_close_date"), today)
    months = subscriptions.withColumn("snapshot_month", F.explode(month_series(begin, end)))

    m = F.col("snapshot_month")
    started = F.col("service_started_at")
    stops = [F.col("service_ended_at"), F.col("subscription_close_date")]
    running = (F.col("subscription_status") == IN_SERVICE) & started.isNotNull()

    def still(cut):
        left, right = (s.isNull() | (cut(s) > m) for s in stops)
        return left & right

    touched = F.col("updated_at").isNotNull() & (month_of("updated_at") == m)
    ended = F.col("service_ended_at")
    return months.select(
        "subscription_id",
        "snapshot_month",
        quarter_of(m).alias("snapshot_quarter"),
        "subscription_status",
        "service_started_at",
        "service_ended_at",
        "subscription_close_date",
        "channel_partner_id",
        "program_id",
        "partner_name",
        "monthly_subscription_amount_sar",
        "is_mrr_eligible",
        "is_churned",
        "is_upgraded",
        "is_kifed",
        (running & (month_of(started) <= m) & still(month_of)).alias("is_active_at_month_end"),
        (
            F.month(m).isin(*QUARTER_MONTHS) & running & (started <= m) & still(lambda d: d)
        ).alias("is_active_at_quarter_start"),
        (F.col("is_churned") & ended.isNotNull() & (month_of(ended) == m))
        .alias("is_churned_in_month"),
        (F.col("is_upgraded") & touched).alias("is_upgraded_in_month"),
        (F.col("is_kifed") & touched).alias("is_kifed_in_month"),
    )


def monthly_snapshot_counts(
    subscriptions: DataFrame, as_of: date | str, by: Sequence[str], flags: Collection[str]
) -> DataFrame:
    """How many monthly ``snapshots`` there are per group and month, and how many have each of some flags.

    The same rows and flags as ``int_subscription_snapshots_monthly`` without making them: every
    condition on the month is an interval of months, counted by its two ends.
    """
    today = F.lit(str(as_of)).cast("date")
    started, ended = F.col("service_started_at"), F.col("service_ended_at")
    stops = [ended, F.col("subscription_close_date")]
    first = month_of(F.coalesce(started, F.to_date("created_at")))
    last = month_of(F.coalesce(*stops, today))
    running = (F.col("subscription_status") == IN_SERVICE) & started.isNotNull()

    def open_between(begin: Column, ends: Sequence[Column]) -> tuple[Column, Column]:
        return F.when(running, F.greatest(first, begin)), F.least(last, *ends)

    def inside(when: Column, happened: Column) -> tuple[Column, Column]:
        return when, happened & when.between(first, last)

    # the first month that begins at the start or later; the last that begins before a stop
    after = F.when(started <= month_of(started), month_of(started)).otherwise(F.add_months(month_of(started), 1))
    before = [F.when(s > month_of(s), month_of(s)).otherwise(F.add_months(month_of(s), -1)) for s in stops]
    touched = month_of("updated_at")
    spans = {
        "is_active": open_between(month_of(started), [F.add_months(month_of(s), -1) for s in stops]),
        "is_active_at_quarter_start": open_between(after, before),
    }
    moments = {
        "is_churned": inside(month_of(ended), F.col("is_churned")),
        "is_upgraded": inside(touched, F.col("is_upgraded")),
        "is_kifed": inside(touched, F.col("is_kifed")),
        "is_upgraded_or_kifed": inside(touched, F.col("is_upgraded") | F.col("is_kifed")),
    }
    if unknown := set(flags) - {*spans, *moments}:
        raise KeyError(f"snapshots have no flags {sorted(unknown)}")
    counts = monthly_counts(
        subscriptions, by, "snapshot_month",
        {"snapshots": (first, last)} | {n: s for n, s in spans.items() if n in flags},
        {n: m for n, m in moments.items() if n in flags}, "snapshots",
    )
    m, at_start = F.col("snapshot_month"), "is_active_at_quarter_start"
    if at_start in flags:
        counts = counts.withColumn(at_start, F.when(F.month(m).isin(*QUARTER_MONTHS), F.col(at_start)).otherwise(0))
    return counts.withColumn("snapshot_quarter", quarter_of(m))


def int_payments_crm(
    payments: DataFrame, orders: DataFrame, customers: DataFrame | None
) -> DataFrame:
    """CRM payment with its order and customer; ``customers`` None skips the latter."""
    out = enrich(
        _without(payments), orders, ("order_id", "order_id"),
        [
            "order_number", "program_id", "channel_partner_id", "partner_name", "program_name",
            "is_gmv_eligible",
        ],
        flag="has_valid_order", spread="payment_id",
    )
    if customers is None:
        return out
    named = "customer_name" in customers.columns
    return enrich(
        out, customers, ("customer_id", "customer_id"),
        {
            "customer_name": "customer_name", "customer_is_fully_verified": "is_fully_verified",
        } if named else (),
        flag="has_valid_customer", spread="payment_id",
    )


def int_payments_psp(payments: DataFrame, transactions: DataFrame) -> DataFrame:
    return enrich(
        _without(payments), transactions, ("transaction_id", "transaction_id"),
        [
            "process_status", "request_status", "transaction_type", "is_scheduled",
            "is_successful", "is_retry_queue",
        ],
        flag="has_transaction_outcome", spread="psp_payment_id",
    )


def int_payments_unified(crm: DataFrame, psp: DataFrame) -> DataFrame:
    """CRM payments reconciled with the payment service."""
    unified = reconcile(
        crm.drop("is_gmv_eligible", "customer_is_fully_verified"), psp,
        on=("psp_payment_id", "psp_payment_id"),
        amounts=("collected_amount_sar", "psp_payment_amount"),
        take={
            "psp_payment_amount": "payment_amount",
            "payment_intent_id": "payment_intent_id",
            "subscriber_id": "subscriber_id",
            "psp_subscription_id": "psp_subscription_id",
            "psp_process_status": "process_status",
            "psp_request_status": "request_status",
            "psp_is_successful": "is_successful",
            "psp_is_retry_queue": "is_retry_queue",
        },
        matched="is_psp_reconciled",
        status="psp_reconciliation_status",
        reason="reconciliation_gap_reason",
        spread="payment_id",
    )
    return unified


def int_payment_attempts(history: DataFrame, unified: DataFrame) -> DataFrame:
    """Payment attempt with its payment; recurring is a property of the payment."""
    out = enrich(
        _without(history), unified, ("payment_id", "payment_id"),
        {
            "is_recurring_installment": "is_recurring_payment",
            "order_id": "order_id",
            "customer_id": "customer_id",
            "program_id": "program_id",
            "channel_partner_id": "channel_partner_id",
            "partner_name": "partner_name",
            "psp_reconciliation_status": "psp_reconciliation_status",
            "psp_is_retry_queue": "psp_is_retry_queue",
        },
        flag="has_valid_payment", spread="payment_history_id",
    )
    return out.withColumn(
        "is_recurring_installment", F.coalesce("is_recurring_installment", F.lit(False))
    )


def int_invoices(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """Invoice with its customer; of bare keys only the match flag is added."""
    take = ["customer_name", "corporate_company_id", "corporate_company_name", "zoho_customer_id"]
    return enrich(
        _without(invoices), customers, ("customer_id", "customer_id"),
        [c for c in take if c in customers.columns],
        flag="has_valid_customer", spread="invoice_id",
    )


def int_invoice_line_items(
    lines: DataFrame, subscriptions: DataFrame, invoices: DataFrame
) -> DataFrame:
    """Invoice line with its subscription and invoice; bare subscription keys give a flag."""
    take = [
        "subscription_status", "program_id", "channel_partner_id", "partner_name",
        "monthly_subscription_amount_sar",
    ]
    out = enrich(
        _without(lines).withColumnRenamed("parent_invoice_line_item_id", "invoice_id"),
        subscriptions, ("subscription_id", "subscription_id"),
        [c for c in take if c in subscriptions.columns],
        flag="has_valid_subscription", spread="invoice_line_item_id",
    )
    return enrich(
        out, invoices, ("invoice_id", "invoice_id"),
        ["invoice_status", "invoice_date", "zoho_invoice_number", "customer_id", "is_paid"],
        flag="has_valid_invoice", spread="invoice_line_item_id",
    )


def int_credit_notes(notes: DataFrame, invoices: DataFrame) -> DataFrame:
    take = [
        "invoice_name", "invoice_amount_sar", "invoice_status", "zoho_invoice_number",
        "customer_id", "customer_name", "channel_partner_id", "program_id",
    ]
    return enrich(
        _without(notes), invoices, ("invoice_id", "invoice_id"),
        [c for c in take if c in invoices.columns],
        flag="has_valid_invoice", spread="credit_note_id",
    )


def int_refunds(crm: DataFrame) -> DataFrame:
    """Refund events: refunded CRM payments with a positive refund amount."""
    refunded = crm.where(F.col("is_refunded") & (F.col("refund_amount_sar") > 0))
    return refunded.select(
        F.col("payment_id").alias("refund_event_id"),
        F.lit("crm").alias("refund_source"),
        "refund_amount_sar",
        F.col("paid_at").alias("refunded_at"),
        "customer_id",
        "order_id",
        "channel_partner_id",
        "program_id",
        "partner_name",
        surrogate_key("crm", F.col("payment_id")).alias("refund_dedup_key"),
    )


def int_finance_reconciliation(
    payments: DataFrame, invoices: DataFrame, credit_notes: DataFrame
) -> DataFrame:
    """Collected against invoiced revenue per month.

    Reads amounts, flags and dates only, so staged tables serve as well as the joined
    ones. What is shuffled is one row per month and task.
    """
    month = "reconciliation_month"
    collected = monthly_agg(
        payments, ["payment_timestamp", "created_at"],
        {
            "collected_revenue_sar": sum_where("collected_amount_sar", "is_collected"),
            "collected_payment_count": count_where("is_collected"),
            "crm_refund_amount_sar": sum_where("refund_amount_sar", "is_refunded"),
        }, month,
    )
    # a payment date is a timestamp and an invoice date a date: coalesce needs one type
    dated = invoices.withColumn("created_at", F.to_date("created_at"))
    invoiced = monthly_agg(
        dated, ["invoice_date", "settlement_date", "created_at"],
        {
            "invoiced_revenue_sar": sum_where("invoice_amount_sar", "is_paid"),
            "paid_invoice_count": count_where("is_paid"),
            "unpaid_invoice_amount_sar": sum_where("invoice_amount_sar", ~F.col("is_paid")),
        }, month,
    )
    noted = monthly_agg(
        credit_notes, ["created_at"], {"credit_note_count": count_rows()}, month,
        keep_undated=True,
    )
    zero = lambda df: {c: 0 for c in df.columns if c != month}
    merged = merge_by_key(month, [(d, zero(d)) for d in (collected, invoiced, noted)])
    return merged.withColumn(
        "finance_variance_sar", F.col("collected_revenue_sar") - F.col("invoiced_revenue_sar")
    )


def int_partner_api_events(
    logs: DataFrame,
    orders: DataFrame,
    subscriptions: DataFrame,
    customers: DataFrame,
    partners: DataFrame,
    parent_types: Mapping[str, str] | None = None,
) -> DataFrame:
    """API call attributed to a partner through whatever it was about.

    ``parent_types`` maps the four parent kinds to a site's own module names.
    """
    name = dict(parent_types or {})
    out = polymorphic_lookup(
        _without(logs), "parent_type", "parent_id",
        {
            name.get(PARENT_ORDER, PARENT_ORDER): (orders, "order_id", "channel_partner_id"),
            name.get(PARENT_SUBSCRIPTION, PARENT_SUBSCRIPTION):
                (subscriptions, "subscription_id", "channel_partner_id"),
            name.get(PARENT_CUSTOMER, PARENT_CUSTOMER):
                (customers, "customer_id", "channel_partner_id"),
        },
        "channel_partner_id",
        self_kind=name.get(PARENT_PARTNER, PARENT_PARTNER), spread="api_log_id",
    )
    out = out.withColumn("has_partner_attribution", F.col("channel_partner_id").isNotNull())
    return enrich(
        out, partners, ("channel_partner_id", "channel_partner_id"), ["partner_name"],
        spread="api_log_id",
    )
