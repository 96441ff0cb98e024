"""Generic operators, each shown on a table where its rule matters."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import functions as F

from subscope.functions import clean, dates, flags, ratios
from subscope.operators import aggs, joins, sets
from subscope.operators.medians import median_by_ranks
from subscope.plans import conform, kpis
from subscope.plans.staging import rename_project
from subscope.plans.warehouse import shared_folder
from subscope.schemas import RAW_TABLES
from subscope.session import scratch_root
from subscope.sources.calendar import calendar_for, spine_of
from subscope.sources.raw import live_rows
from subscope.sources.sinks import read_mart, register_view, write_bucketed, write_mart
from workload.base import AS_OF, query

# --- scans and sinks -------------------------------------------------------------------


@query("scan_raw_tables", "S1")
def _(w):
    """Rows and live rows of all 29 raw tables."""
    def one(table):
        raw = w.raw(table)
        gone = next(c for c in ("deleted", "deleted_at", "_etl_deleted_at") if c in raw.columns)
        live = F.col("deleted") == F.lit(False) if gone == "deleted" else F.col(gone).isNull()
        return raw.agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            F.count_if(live).alias("live_count"),
        )

    out = one(RAW_TABLES[0])
    for t in RAW_TABLES[1:]:
        out = out.unionByName(one(t))
    return out


@query("live_rows_by_flag", "S3")
def _(w):
    return live_rows(w.raw("crm_orders")).select("id", "deleted")


@query("live_rows_by_deletion_time", "S4")
def _(w):
    return live_rows(w.raw("payments_payments"), deleted_at="deleted_at").select("id", "transaction_id")


@query("model_reference", "S5")
def _(w):
    """A model read by another: the order context under the item table."""
    return w["ctx_orders"].groupBy("partner_name", "program_name").agg(
        aggs.count_rows().alias("orders")
    )


@query("date_spine", "S6")
def _(w):
    """Days on which orders can lie, end exclusive, with the orders of each day."""
    days = w["fct_orders"].select("order_date")
    span = days.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    spine = spine_of(span, F.col("lo"), F.col("hi"))
    return joins.with_rollup(
        spine, days, ("date_day", "order_date"), {"orders": aggs.count_rows()}, {"orders": 0}
    )


@query("calendar_of_column", "S7")
def _(w):
    """Report calendar over whole years of the order dates, with its hierarchy columns."""
    cal = calendar_for(w["stg_orders"], "created_at")
    return cal.withColumns(dates.hierarchy_columns(F.col("date")))


def _scratch(w) -> str:
    return shared_folder(w.spark, scratch_root(w.spark))


def _kept(w):
    """Writes a table to the shared folder and reads it back."""
    folder = _scratch(w)

    def keep(df):
        path = f"{folder}/{uuid4().hex}"
        df.write.parquet(path)
        return w.spark.read.schema(df.schema).parquet(path)

    return keep


@query("mart_written_and_read", "S8", "S10")
def _(w):
    folder = _scratch(w)
    path = write_mart(
        w["fct_subscriptions"].withColumn("year", F.year("subscription_date")),
        folder, "fct_subscriptions", ["year"],
    )
    back = w.spark.read.parquet(path)
    return back.groupBy("year", "subscription_status").agg(
        aggs.count_rows().alias("subscriptions"),
        F.sum("monthly_recurring_amount_sar").alias("amount_sar"),
    )


@query("mart_versions", "S8", "S10")
def _(w):
    """Two refreshes of a mart: what a reader of each version gets."""
    folder, rows = _scratch(w), w["fct_subscriptions"].withColumn("year", F.year("subscription_date"))
    write_mart(rows.where("is_active_subscription"), folder, "fct_subscriptions", ["year"])
    write_mart(rows, folder, "fct_subscriptions", ["year"])

    def counted(version, name):
        return read_mart(w.spark, folder, "fct_subscriptions", version).groupBy("year").agg(
            F.lit(name).alias("version"), aggs.count_rows().alias("subscriptions"))

    return counted(1, "first").union(counted(None, "current"))


@query("bucketed_fact_join", "J1", "J6", "S8")
def _(w):
    """Items met with their orders in tables bucketed on the order: neither side is shuffled for the join."""
    folder, run = _scratch(w), uuid4().hex
    orders, items = (
        w.spark.table(write_bucketed(df, f"subscope_{name}_{run}", ["order_id"], 8, f"{folder}/{name}"))
        for name, df in (
            ("orders", w["fct_orders"].select("order_id", "sales_channel", "is_gmv_eligible")),
            ("items", w["fct_order_items"].select("order_id", "order_item_id")),
        )
    )
    return bucketed_items(orders, items)


def bucketed_items(orders, items):
    met = items.hint("merge").join(orders, "order_id")
    return met.groupBy("sales_channel").agg(
        aggs.count_rows().alias("items"), aggs.count_where("is_gmv_eligible").alias("eligible_items"))


@query("view_registered", "S9")
def _(w):
    view = "subscope_stg_payments"
    register_view(w["stg_payments"], view)
    return w.spark.table(view).groupBy("payment_status").agg(aggs.count_rows().alias("payments"))


# --- projections and predicates ----------------------------------------------------------


@query("rename_and_project", "P1")
def _(w):
    return rename_project(
        w.raw("crm_orders"), order_id="id", order_number=clean.text("name"),
        ordered_at="date_entered",
    )


@query("status_flags", "P2")
def _(w):
    s = "order_status"
    return w.raw("crm_orders").select(
        "id",
        flags.status_flag(s, "delivered").alias("is_delivered"),
        flags.status_flag(s, "cancelled", "rejected", "expired").alias("is_voided"),
        flags.status_flag(s, "cancelled", "rejected", "expired", negate=True).alias("is_kept"),
    )


@query("case_insensitive_match", "P3")
def _(w):
    return w.raw("crm_accounts").select(
        "id",
        flags.ilike_flag("is_mobile_verified", "yes").alias("is_yes"),
        flags.ilike_flag("name", "%customer#00000001%").alias("is_low_number"),
    )


@query("match_flag_after_join", "P4")
def _(w):
    right = w["stg_accounts"].select(F.col("customer_id").alias("known_id"))
    out = w["stg_orders"].select("order_id", "customer_id").join(
        right, F.col("customer_id") == F.col("known_id"), "left"
    )
    return joins.with_match_flag(out, "known_id", "has_valid_customer")


@query("segment_labels", "P5")
def _(w):
    amount = F.col("gmv_amount_sar")
    label = flags.segment(
        [(amount.isNull(), "unknown"), (amount > 300000, "large"), (amount > 100000, "medium")],
        "small",
    )
    return w["stg_orders"].groupBy(label.alias("segment")).agg(aggs.count_rows().alias("orders"))


@query("over_limit", "P6")
def _(w):
    return w["int_programs"].select(
        "program_id",
        flags.over_limit_flag("utilization_subscription_count", "subscription_limit")
        .alias("is_over"),
    )


@query("indicator_of_flag", "P7")
def _(w):
    return w["stg_api_logs"].groupBy("api_source").agg(
        F.sum(flags.indicator("is_failure")).alias("failures")
    )


@query("flags_combined", "P8")
def _(w):
    return w["int_payment_attempts"].select(
        "payment_history_id",
        flags.all_flags("is_failed_attempt", "psp_is_retry_queue").alias("is_outstanding"),
    )


@query("first_known_of_paths", "P9")
def _(w):
    return w["int_order_items"].select(
        "order_item_id",
        flags.first_known("program_sku_id", "resolved_program_sku_id", default="none")
        .alias("catalog_id"),
    )


@query("typed_nulls_for_union", "P10")
def _(w):
    schema = {"method_id": "string", "gateway": "string", "is_default": "boolean"}
    return sets.conform_union({
        "crm": w["stg_payment_methods"].withColumnRenamed("payment_method_id", "method_id"),
        "psp": w["stg_psp_payment_methods"].withColumnsRenamed(
            {"psp_payment_method_id": "method_id", "payment_gateway": "gateway"}
        ),
    }, schema, "source").groupBy("source", "gateway", "is_default").agg(
        aggs.count_rows().alias("methods")
    )


@query("star_plus_column", "P11")
def _(w):
    return w["stg_subscription_pricing"].withColumn(
        "yearly_amount_sar", F.col("monthly_subscription_amount_sar") * 12
    ).select("subscription_pricing_id", "monthly_subscription_amount_sar", "yearly_amount_sar")


@query("filter_flag_and_amount", "P12")
def _(w):
    return w["stg_payments"].where(
        F.col("is_refunded") & (F.coalesce("refund_amount_sar", F.lit(0)) > 0)
    ).select("payment_id", "refund_amount_sar")


# --- joins ----------------------------------------------------------------------------


@query("lookup_join", "J1")
def _(w):
    return joins.enrich(
        w["stg_invoices"].select("invoice_id", "customer_id"), w["stg_accounts"],
        ("customer_id", "customer_id"), ["customer_name"], flag="has_valid_customer",
        spread="invoice_id",
    )


@query("inner_join_then_count", "J2")
def _(w):
    sold = joins.inner_match(
        w["stg_subscriptions"].select("subscription_id", "order_id"), w["stg_orders"],
        ("order_id", "order_id"), ["program_id"],
    )
    return sold.groupBy("program_id").agg(aggs.count_rows().alias("subscriptions"))


@query("exploded_rows_keep_parent", "J3")
def _(w):
    return w["int_subscription_snapshots_monthly"].groupBy(
        "subscription_id", "subscription_status"
    ).agg(aggs.count_rows().alias("months"))


@query("polymorphic_lookup", "J4")
def _(w):
    return joins.polymorphic_lookup(
        w["stg_api_logs"].select("api_log_id", "parent_type", "parent_id"),
        "parent_type", "parent_id",
        {
            "orders": (w["stg_orders"], "order_id", "customer_id"),
            "subscriptions": (w["stg_subscriptions"], "subscription_id", "customer_id"),
        },
        "customer_id", self_kind="accounts",
    )


@query("role_playing_dimension", "J5")
def _(w):
    """Country of the order's program partner and of the customer's own partner."""
    partners = w["stg_channel_partners"]
    both = joins.enrich(
        w["ctx_orders"].select("order_id", "customer_id", "channel_partner_id"),
        w["stg_accounts"], ("customer_id", "customer_id"),
        {"customer_partner_id": "channel_partner_id"}, spread="order_id",
    )
    both = joins.enrich(both, partners, ("channel_partner_id", "channel_partner_id"),
                        {"order_partner": "partner_name"})
    both = joins.enrich(both, partners, ("customer_partner_id", "channel_partner_id"),
                        {"customer_partner": "partner_name"})
    return both.groupBy("order_partner", "customer_partner").agg(aggs.count_rows().alias("orders"))


@query("sku_over_bridge", "J6")
def _(w):
    out = joins.resolve_sku(
        w["stg_order_items"].select("order_item_id", "program_sku_id", "cp_sku_id"),
        w["ctx_device_skus"], w["stg_cp_skus"], w["stg_master_skus"], spread="order_item_id",
    )
    return out.select("order_item_id", "device_sku_key", "master_sku_id", "brand",
                      "resolved_program_sku_id", "has_valid_resolved_sku")


@query("rollup_joined_to_dimension", "J7")
def _(w):
    return joins.with_rollup(
        w["stg_accounts"].select("customer_id", "customer_name"), w["stg_orders"],
        ("customer_id", "customer_id"),
        {"orders": aggs.count_rows(), "gmv_sar": F.sum("gmv_amount_sar")}, {"orders": 0},
    )


@query("merge_aggregates_by_key", "J8")
def _(w):
    def per_partner(df, name):
        return df.groupBy("channel_partner_id").agg(aggs.count_rows().alias(name))

    return joins.merge_by_key("channel_partner_id", [
        (per_partner(w["stg_subscriptions"], "subscriptions"), {"subscriptions": 0}),
        (per_partner(w["stg_invoices"], "invoices"), {"invoices": 0}),
        (per_partner(w["stg_accounts"], "customers"), {"customers": 0}),
    ])


@query("reconcile_two_systems", "J9", "F24")
def _(w):
    return w["int_payments_unified"].groupBy(
        "psp_reconciliation_status", "reconciliation_gap_reason", "is_psp_reconciled"
    ).agg(
        aggs.count_rows().alias("payments"),
        F.sum("collected_amount_sar").alias("collected_sar"),
        F.sum("psp_payment_amount").alias("psp_sar"),
    )


@query("join_to_deduplicated", "J10")
def _(w):
    first = sets.dedup_first(
        w["stg_psp_payments"].where("transaction_id is not null"),
        ["transaction_id"], ["psp_payment_id"],
    )
    return joins.enrich(
        w["stg_psp_transactions"].select("transaction_id"), first,
        ("transaction_id", "transaction_id"), ["psp_payment_id"],
    )


@query("fact_to_dimension_blank_member", "J11")
def _(w):
    out = joins.enrich(
        w["fct_order_items"], w["dim_programs"], ("program_id", "program_id"), ["program_name"]
    )
    return out.groupBy("program_name").agg(aggs.count_rows().alias("items"))


@query("orphan_keys", "J13")
def _(w):
    return joins.orphans(w["stg_orders"], "customer_id", w["stg_accounts"], "customer_id")


@query("sliced_facts", "J14")
def _(w):
    chosen = F.col("partner_name").isin("ASIA", "EUROPE")
    return joins.slice_by(
        w["fct_orders"], w["dim_channel_partners"], chosen,
        ("channel_partner_id", "channel_partner_id"),
    ).groupBy("channel_partner_id", "order_status").agg(aggs.count_rows().alias("orders"))


# --- aggregations ---------------------------------------------------------------------


@query("count_by_key", "A1")
def _(w):
    return w["stg_order_items"].groupBy("product_type").agg(aggs.count_rows().alias("items"))


@query("conditional_count", "A2")
def _(w):
    return w["stg_orders"].groupBy("program_id").agg(
        aggs.count_where("is_preorder").alias("preorders"),
        aggs.count_where(F.col("order_status") == "delivered").alias("delivered"),
    )


@query("conditional_sum", "A3")
def _(w):
    return w["stg_payments"].groupBy("payment_type").agg(
        aggs.sum_where("collected_amount_sar", "is_collected").alias("collected_sar"),
        aggs.sum_where("refund_amount_sar", "is_refunded").alias("refunded_sar"),
        aggs.sum_where("refund_amount_sar", F.lit(False)).alias("nothing_sar"),
    )


@query("sum_by_key", "A4")
def _(w):
    return w["stg_order_items"].groupBy("program_sku_id").agg(
        F.sum("quantity").alias("units"), F.sum("total_price_vat_inclusive").alias("revenue")
    )


@query("distinct_count", "A5")
def _(w):
    return w["int_devices"].groupBy("brand").agg(
        aggs.distinct_where("order_id").alias("orders"),
    )


@query("conditional_distinct_count", "A6")
def _(w):
    return w["stg_psp_transactions"].groupBy("transaction_type").agg(
        aggs.distinct_where("subscriber_id", "is_retry_queue").alias("subscribers_on_retry")
    )


@query("first_and_last_dates", "A7")
def _(w):
    return w["stg_devices"].groupBy("brand").agg(
        F.min("purchase_date").alias("first_purchase"),
        F.max("delivery_date").alias("last_delivery"),
    )


@query("first_event_per_key", "A8")
def _(w):
    return aggs.first_event_at(w["stg_payments"], "order_id", "paid_at", "is_collected", "first_paid_at")


@query("average", "A9")
def _(w):
    return w["ctx_subscriptions"].groupBy("product_type").agg(
        aggs.mean("subscription_term_months").alias("avg_term"),
        aggs.mean("monthly_subscription_amount_sar").alias("avg_amount"),
    )


@query("median_by_ranks", "A10", "ME7", "KP5")
def _(w):
    """Median of a measure with as many values as rows."""
    return median_by_ranks(
        w["fct_orders"], ["sales_channel"], F.col("gmv_amount_sar"), "median_gmv_sar", bound=1 << 12, keep=_kept(w))


@query("distinct_states_by_partner_and_total", "A5", "A6", "U3", "ME39", "KP24")
def _(w):
    """Customers that owe, by partner and in total, from one table of bitmaps."""
    state = kpis.outstanding_state(w, _kept(w))
    partner = "channel_partner__partner_name"
    return (
        kpis.outstanding_from(w, state, [partner]).withColumn("level", F.lit("partner"))
        .unionByName(kpis.outstanding_from(w, state).withColumns({"level": F.lit("total"), partner: F.lit(None).cast("string")}))
    )


@query("exact_median", "A10")
def _(w):
    days = dates.whole_days(F.to_date("created_at"), "delivered_at")
    return aggs.exact_median(w["stg_orders"], ["sales_channel"], days, "median_days")


@query("failure_rate", "A11")
def _(w):
    return w["stg_api_logs"].groupBy("parent_type").agg(
        ratios.rate(aggs.count_where("is_failure"), aggs.count_rows()).alias("failure_rate")
    )


@query("limit_utilization", "A12")
def _(w):
    return w["int_programs"].select(
        "program_id",
        ratios.utilization("active_subscription_count", "subscription_limit").alias("used"),
    )


@query("monthly_with_fallback_dates", "A13")
def _(w):
    dated = w["stg_invoices"].withColumn("created_at", F.to_date("created_at"))
    return aggs.monthly_agg(
        dated, ["settlement_date", "invoice_date", "created_at"],
        {"invoices": aggs.count_rows(), "amount_sar": F.sum("invoice_amount_sar")}, "month",
    )


@query("card_value", "A14")
def _(w):
    return w["stg_orders"].agg(
        aggs.count_rows().alias("orders"),
        aggs.sum_where("gmv_amount_sar", "is_gmv_eligible").alias("gmv_sar"),
    )


@query("average_of_ratios", "A15")
def _(w):
    from subscope.plans.kpis import mean_of_ratios

    return w["int_programs"].groupBy("partner_name").agg(
        mean_of_ratios("utilization_subscription_count", "subscription_limit").alias("mean_ratio")
    )


@query("ratio_of_sums", "A16")
def _(w):
    return w["int_programs"].groupBy("partner_name").agg(
        ratios.ratio(
            F.sum("utilization_subscription_count"), F.sum("subscription_limit")
        ).alias("ratio")
    )


@query("distinct_tuples", "A17")
def _(w):
    return aggs.distinct_values(w["stg_order_items"], ["product_type", "order_line_item_type"])


@query("latest_period_only", "A18")
def _(w):
    snaps = w["fct_subscription_monthly_snapshots"]
    counted = snaps.groupBy("snapshot_quarter", "subscription_status").agg(aggs.count_rows().alias("rows"))
    return aggs.of_latest_period(counted, "snapshot_quarter")


@query("date_hierarchy_totals", "A19")
def _(w):
    return aggs.date_rollup(
        w["stg_orders"].withColumn("d", F.to_date("created_at")), "d",
        {"orders": aggs.count_rows(), "gmv_sar": F.sum("gmv_amount_sar")},
    )


# --- windows, ranking, sets -------------------------------------------------------------


@query("dedup_first_per_key", "W1")
def _(w):
    return sets.dedup_first(
        w["stg_psp_payments"].where("transaction_id is not null"),
        ["transaction_id"], ["psp_payment_id"],
    ).select("transaction_id", "psp_payment_id", "payment_amount")


@query("ranked_categories", "O1")
def _(w):
    totals = w["stg_order_items"].groupBy("product_type").agg(
        F.sum("total_price_vat_inclusive").alias("revenue")
    )
    return sets.ranked(totals, "revenue", "product_type")


@query("conformed_union", "U1")
def _(w):
    schema = {"party_id": "string", "created_at": "timestamp", "card_last_four": "string"}
    return sets.conform_union({
        "customer": w["stg_payment_methods"].withColumnRenamed("customer_id", "party_id"),
        "subscriber": w["stg_psp_payment_methods"].withColumnRenamed("subscriber_id", "party_id"),
    }, schema, "party_type")


@query("union_of_keys", "U2")
def _(w):
    return sets.union_keys(*[
        w[t].select("customer_id") for t in ("stg_orders", "stg_invoices", "stg_payments")
    ])


@query("distinct_customers_in_either", "U3")
def _(w):
    return sets.union_distinct_count(
        w["stg_invoices"].where("is_paid = false"), w["stg_payments"].where("is_failed"),
        "customer_id", "customers",
    )


@query("monthly_merge_parts", "N9")
def _(w):
    """Months on which only some of the systems have something, the undated month too."""
    return conform.int_finance_reconciliation(
        w["stg_payments"].where("is_refunded"), w["stg_invoices"].where("is_paid"),
        w["stg_credit_notes"],
    ).select("reconciliation_month", "collected_payment_count", "paid_invoice_count",
             "credit_note_count")


# --- scalar functions -------------------------------------------------------------------

def _scalar(name, ids, table, cols):
    """Columns are built when the query runs: they need an active session."""
    query(name, *ids)(
        lambda w: w.raw(table).select("id", *[c.alias(n) for n, c in cols().items()])
    )


def _some(columns, *names):
    return {n: c for n, c in columns.items() if n in names}


_scalar("f_trim", ["F1"], "crm_accounts", lambda: dict(phone=clean.text("phone_number")))
_scalar(
    "f_status_normalization", ["F2"], "crm_orders",
    lambda: dict(status=clean.code("order_status")),
)
_scalar(
    "f_blank_key_to_null", ["F3"], "crm_orders",
    lambda: dict(customer=clean.key("customer_id")),
)
_scalar(
    "f_code_with_default", ["F4"], "crm_orders",
    lambda: dict(kind=clean.code_or("order_type", "unknown")),
)
_scalar(
    "f_business_key", ["F5"], "crm_master_skus",
    lambda: dict(sku_key=clean.business_key("brand", "model", "memory", "color")),
)
_scalar(
    "f_surrogate_key", ["F6"], "crm_payments",
    lambda: dict(refund_key=clean.surrogate_key("crm", F.col("id"))),
)
_scalar(
    "f_entity_key", ["F7"], "crm_subscriptions",
    lambda: dict(entity=clean.entity_key("id", dates.month_of("service_start_date"))),
)
_scalar(
    "f_to_money", ["F8"], "crm_order_items",
    lambda: dict(total=clean.money("total_price_vat_inclusive"), units=clean.money("quantity")),
)
_scalar(
    "f_to_int", ["F9"], "crm_subscription_durations",
    lambda: dict(months=clean.whole("duration")),
)
_scalar("f_to_date", ["F10"], "crm_payments", lambda: dict(paid_on=F.to_date("payment_timestamp")))
_scalar(
    "f_round_half_up", ["F11"], "crm_orders",
    lambda: dict(share=F.round(clean.money("total_discount_amount") / F.lit(8).cast("decimal(5,0)"), 4)),
)
_scalar(
    "f_guarded_division", ["F12"], "crm_programs",
    lambda: dict(per_limit=ratios.ratio("payment_methods_limit", "subscription_limit")),
)
_scalar(
    "f_month_start", ["F13"], "crm_payments",
    lambda: dict(month=dates.month_of("date_entered")),
)
_scalar(
    "f_quarter_start", ["F14"], "crm_payments",
    lambda: dict(quarter=dates.quarter_of("date_entered")),
)


@query("f_month_series", "F15")
def _(w):
    series = dates.month_series(F.col("service_start_date"), F.col("subscription_close_date"))
    return w.raw("crm_subscriptions").select("id", F.explode(series).alias("month"))


_scalar(
    "f_date_parts", ["F16"], "crm_orders",
    lambda: dict(y=F.year("date_entered"), q=F.quarter("date_entered"), m=F.month("date_entered"), d=F.dayofmonth("date_entered")),
)
_scalar(
    "f_day_of_week", ["F17", "F18"], "crm_orders",
    lambda: _some(dates.calendar_columns(F.col("date_entered"), (5, 6)), "day_of_week", "is_weekend"),
)
_scalar(
    "f_period_labels", ["F19"], "crm_orders",
    lambda: _some(dates.calendar_columns(F.col("date_entered")), "year_month", "year_quarter"),
)
_scalar(
    "f_card_expired", ["F20"], "crm_payment_methods",
    lambda: dict(is_expired=dates.expired_before("expiry_year", "expiry_month", F.lit(AS_OF).cast("date"))),
)
_scalar(
    "f_whole_days", ["F21"], "crm_orders",
    lambda: dict(days=dates.whole_days(F.to_date("date_entered"), "delivered_on")),
)
_scalar(
    "f_day_boundaries", ["F22"], "crm_payments",
    lambda: dict(days=dates.whole_days("date_entered", "payment_timestamp")),
)
_scalar(
    "f_first_timestamp", ["F23"], "crm_payments",
    lambda: dict(paid_at=F.coalesce("payment_timestamp", "date_entered")),
)
_scalar(
    "f_division_or_zero", ["F25"], "crm_programs",
    lambda: dict(per_limit=ratios.ratio_or_zero("payment_methods_limit", "subscription_limit")),
)
_scalar(
    "f_count_is_zero_not_blank", ["F26"], "crm_orders",
    lambda: dict(days=F.coalesce(dates.whole_days("date_entered", "delivered_on"), F.lit(0))),
)
_scalar(
    "f_hierarchy_labels", ["F27"], "crm_orders",
    lambda: _some(dates.hierarchy_columns(F.col("date_entered")), "month", "quarter", "quarter_no"),
)

assert date.fromisoformat(AS_OF)
