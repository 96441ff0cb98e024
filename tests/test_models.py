"""Business rules of the models on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subscope.plans import conform, marts, staging
from subscope.schemas import RAW_TABLES, raw_schema

AS_OF = "2024-06-15"


@pytest.fixture
def raw(spark):
    """``raw("crm_orders", {...}, ...)``: rows with unnamed columns NULL, live by default."""
    def make(table, *rows):
        schema = raw_schema(table)
        base = {f.name: None for f in schema}
        if "deleted" in base:
            base["deleted"] = False
        return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)

    return make


def by_id(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_there_are_29_raw_tables():
    assert len(RAW_TABLES) == 29


def test_soft_deletes(raw):
    rows = raw("crm_countries", {"id": "a"}, {"id": "b", "deleted": True}, {"id": "c", "deleted": None})
    assert set(by_id(staging.stage_countries(rows), "country_id")) == {"a"}
    when = datetime(2024, 1, 1)
    rows = raw("payments_payments", {"id": "a"}, {"id": "b", "deleted_at": when})
    assert set(by_id(staging.stage_psp_payments(rows), "psp_payment_id")) == {"a"}
    rows = raw("payments_transactions", {"id": "a"}, {"id": "b", "_etl_deleted_at": when})
    assert set(by_id(staging.stage_psp_transactions(rows), "transaction_id")) == {"a"}


def test_order_flags(raw):
    rows = raw("crm_orders", {"id": "1", "order_status": " Cancelled", "order_type": "Pre-Order "},
               {"id": "2", "order_status": "delivered"}, {"id": "3", "order_type": " "})
    got = by_id(staging.stage_orders(rows), "order_id")
    assert [(got[i]["is_voided"], got[i]["is_gmv_eligible"], got[i]["is_preorder"], got[i]["order_type"])
            for i in "123"] == [
        (True, False, True, "pre-order"), (False, True, None, "unknown"), (None, None, False, ""),
    ]


def test_account_verification(raw):
    rows = raw("crm_accounts", {"id": "1", "nafath_verified": True, "is_mobile_verified": " yes "},
               {"id": "2", "nafath_verified": True}, {"id": "3", "is_mobile_verified": "YES"},
               {"id": "4", "nafath_verified": True, "is_mobile_verified": "No"})
    customers = staging.stage_accounts(rows).withColumn("corporate_company_name", F.lit(None).cast("string"))
    counts = customers.limit(0).select(
        "customer_id", F.lit(1).alias("device_count"), F.current_date().alias("first_device_purchase_date"),
        F.current_date().alias("latest_device_delivery_date"),
    )
    got = by_id(marts.dim_customers(customers, counts), "customer_id")
    assert [got[i]["is_fully_verified"] for i in "1234"] == [True, None, False, False]
    # an unknown mobile state is no proof of being unverified
    assert [got[i]["customer_verification_segment"] for i in "1234"] == [
        "fully_verified", "unverified", "mobile_only", "nafath_only",
    ]
    assert all(got[i]["device_count"] == 0 for i in "1234")


def test_subscription_status(raw):
    start = date(2024, 1, 1)
    rows = raw("crm_subscriptions",
               {"id": "1", "subscription_status": " Active", "service_start_date": start},
               {"id": "2", "subscription_status": "Active"},
               {"id": "3", "subscription_status": "Waiting_For_Delivery"},
               {"id": "4", "subscription_status": "AUTO_KIFED"},
               {"id": "5", "service_start_date": start}, {"id": "6"})
    got = by_id(staging.stage_subscriptions(rows), "subscription_id")
    assert [got[i]["is_active_subscription"] for i in "12345"] == [True, False, False, False, None]
    assert got["6"]["is_active_subscription"] is False  # unknown and not started
    assert got["3"]["subscription_status"] == "waiting_for_delivery" and got["4"]["is_kifed"]


SNAPSHOT = (
    "subscription_id string, created_at timestamp, updated_at timestamp, subscription_status string, "
    "service_started_at date, service_ended_at date, subscription_close_date date, "
    "channel_partner_id string, program_id string, partner_name string, "
    "monthly_subscription_amount_sar decimal(18,4), is_mrr_eligible boolean, is_churned boolean, "
    "is_upgraded boolean, is_kifed boolean"
)


def snapshots(table, **given):
    base = dict.fromkeys([c.split()[0] for c in SNAPSHOT.split(", ")])
    base.update(subscription_id="s", created_at=datetime(2024, 1, 10), subscription_status="active",
                is_churned=False, is_upgraded=False, is_kifed=False)
    base.update(given)
    out = conform.int_subscription_snapshots_monthly(table(SNAPSHOT, tuple(base.values())), AS_OF)
    return {r.snapshot_month: r for r in out.collect()}


def months(*numbers):
    return [date(2024, n, 1) for n in numbers]


def test_snapshot_span_runs_to_as_of(table):
    got = snapshots(table, service_started_at=date(2024, 4, 30))
    assert sorted(got) == months(4, 5, 6)


def test_snapshot_span_without_start_uses_creation(table):
    got = snapshots(table, subscription_close_date=date(2024, 2, 1))
    assert sorted(got) == months(1, 2)
    assert not any(r.is_active_at_month_end for r in got.values())


def test_snapshot_closed_before_start_has_no_rows(table):
    assert snapshots(table, service_started_at=date(2024, 3, 1),
                     subscription_close_date=date(2024, 2, 28)) == {}


def test_snapshot_activity_boundaries(table):
    got = snapshots(table, service_started_at=date(2024, 4, 1), service_ended_at=date(2024, 6, 1))
    # the month in which the service ends is no longer active at its end
    assert [got[m].is_active_at_month_end for m in months(4, 5, 6)] == [True, True, False]
    # started on the first day of the quarter counts, later does not
    assert got[date(2024, 4, 1)].is_active_at_quarter_start
    late = snapshots(table, service_started_at=date(2024, 4, 2))
    assert not late[date(2024, 4, 1)].is_active_at_quarter_start
    assert not got[date(2024, 5, 1)].is_active_at_quarter_start  # not a quarter month


def test_snapshot_close_on_the_first_excludes_quarter_start(table):
    closing = snapshots(table, service_started_at=date(2024, 1, 1), subscription_close_date=date(2024, 4, 1))
    assert not closing[date(2024, 4, 1)].is_active_at_quarter_start
    later = snapshots(table, service_started_at=date(2024, 1, 1), subscription_close_date=date(2024, 4, 2))
    assert later[date(2024, 4, 1)].is_active_at_quarter_start
    assert not later[date(2024, 4, 1)].is_active_at_month_end


def test_snapshot_churn_month_and_current_status_consequence(table):
    got = snapshots(table, subscription_status="cancelled", is_churned=True,
                    service_started_at=date(2024, 1, 1), service_ended_at=date(2024, 3, 15))
    assert [m for m, r in got.items() if r.is_churned_in_month] == months(3)
    # the status is today's: an ended subscription is in no earlier base
    assert not any(r.is_active_at_quarter_start or r.is_active_at_month_end for r in got.values())
    open_end = snapshots(table, subscription_status="cancelled", is_churned=True,
                         service_started_at=date(2024, 5, 1))
    assert not any(r.is_churned_in_month for r in open_end.values())


def test_snapshot_upgrade_month_is_the_last_update(table):
    got = snapshots(table, subscription_status="upgraded", is_upgraded=True, is_kifed=None,
                    service_started_at=date(2024, 3, 1), updated_at=datetime(2024, 4, 30, 23, 59))
    assert [m for m, r in got.items() if r.is_upgraded_in_month] == months(4)
    never = snapshots(table, subscription_status="upgraded", is_upgraded=True, service_started_at=date(2024, 3, 1))
    assert [r.is_upgraded_in_month for r in never.values()] == [False] * 4


def test_program_limits(table):
    programs = table(
        "program_id string, program_name string, program_status string, channel_partner_id string, "
        "subscription_limit int, is_fnf_program boolean",
        ("null", "a", "active", "cp", None, False), ("zero", "a", "active", None, 0, True),
        ("reached", "a", "active", "cp", 2, False), ("over", "a", "active", "x", 1, False),
        ("off", "a", None, "cp", 9, False), ("disabled", "a", "closed", "cp", 1, False),
    )
    partners = table("channel_partner_id string, partner_name string, partner_type string", ("cp", "P", "t"))
    orders = table("order_id string, program_id string",
                   *[(f"{p}{i}", p) for p in ("null", "zero", "reached", "over") for i in range(3)])
    subs = table(
        "order_id string, subscription_status string",
        *[(f"{p}{i}", s) for p in ("null", "zero", "reached", "over")
          for i, s in enumerate(("active", "waiting_for_delivery", "cancelled"))],
        ("missing", "active"), (None, "active"),
    )
    got = by_id(marts.dim_programs(conform.int_programs(programs, partners, subs, orders)), "program_id")
    assert {p: r["is_over_subscription_limit"] for p, r in got.items()} == {
        "null": None, "zero": False, "reached": False, "over": True, "off": False, "disabled": False,
    }
    assert got["reached"]["program_subscription_utilization_pct"] == Decimal("1.0000")
    assert got["zero"]["program_subscription_utilization_pct"] is None
    assert got["off"]["is_disabled_program"] is None
    assert {p: r["program_limit_segment"] for p, r in got.items()} == {
        "null": "within_limit", "zero": "fnf_pending_rules", "reached": "within_limit",
        "over": "over_subscription_limit", "off": "within_limit", "disabled": "disabled",
    }
    assert got["over"]["has_valid_channel_partner"] is False


def test_mrr_needs_an_existing_price_with_an_amount(table):
    subs = table(
        "subscription_id string, subscription_pricing_id string, order_id string, customer_id string, "
        "is_active_subscription boolean, is_upgraded boolean, is_kifed boolean",
        ("ok", "p", None, "c", True, False, True), ("gone", "x", None, None, True, None, False),
        ("free", "n", None, "c", True, False, False), ("idle", "p", None, "c", False, True, None),
        ("unknown", "p", None, "c", None, False, False),
    )
    pricing = table("subscription_pricing_id string, monthly_subscription_amount_sar decimal(18,4), "
                    "subscription_duration_id string", ("p", Decimal(10), "d"), ("n", None, None))
    durations = table("subscription_duration_id string, duration_months int", ("d", 12))
    got = by_id(conform.int_subscriptions(subs, pricing, durations, None), "subscription_id")
    assert {i: r["is_mrr_eligible"] for i, r in got.items()} == {
        "ok": True, "gone": False, "free": False, "idle": False, "unknown": None,
    }
    assert got["ok"]["subscription_term_months"] == 12
    assert {i: r["is_upgraded_or_kifed"] for i, r in got.items()} == {
        "ok": True, "gone": None, "free": False, "idle": True, "unknown": False,
    }


def test_refunds_are_refunded_with_a_positive_amount(table):
    crm = table(
        "payment_id string, is_refunded boolean, refund_amount_sar decimal(18,4), paid_at timestamp, "
        "customer_id string, order_id string, channel_partner_id string, program_id string, partner_name string",
        *[(i, f, a, None, None, None, None, None, None) for i, f, a in (
            ("1", True, Decimal(5)), ("2", True, Decimal(0)), ("3", True, None), ("4", False, Decimal(5)),
            ("5", None, Decimal(5)))],
    )
    assert set(by_id(conform.int_refunds(crm), "refund_event_id")) == {"1"}


def test_reconciliation_months(table):
    day = datetime(2024, 1, 5)
    payments = table(
        "payment_timestamp timestamp, created_at timestamp, collected_amount_sar decimal(18,4), "
        "refund_amount_sar decimal(18,4), is_collected boolean, is_refunded boolean",
        (None, day, Decimal(10), None, True, False), (day, datetime(2023, 1, 1), Decimal(5), None, True, False),
        (day, day, Decimal(3), Decimal(2), False, True), (None, None, Decimal(99), None, True, False),
    )
    invoices = table(
        "invoice_date date, settlement_date date, created_at timestamp, invoice_amount_sar decimal(18,4), is_paid boolean",
        (None, date(2024, 2, 3), day, Decimal(7), True), (date(2024, 2, 1), None, day, Decimal(4), False),
        (date(2024, 2, 1), None, day, Decimal(8), None),
    )
    notes = table("created_at timestamp", (datetime(2024, 3, 1),), (None,))
    got = by_id(conform.int_finance_reconciliation(payments, invoices, notes), "reconciliation_month")
    assert sorted(k for k in got if k) == months(1, 2, 3)
    jan, feb, mar, undated = (got[k] for k in (*months(1, 2, 3), None))
    assert (jan["collected_revenue_sar"], jan["collected_payment_count"], jan["crm_refund_amount_sar"]) == (15, 2, 2)
    assert (feb["invoiced_revenue_sar"], feb["unpaid_invoice_amount_sar"], feb["finance_variance_sar"]) == (7, 4, -7)
    assert (mar["credit_note_count"], mar["collected_revenue_sar"]) == (1, 0)
    assert undated["credit_note_count"] == 0  # an undated month matches nothing


def test_partner_operations_segment(table):
    partners = table("channel_partner_id string", ("quiet",), ("good",), ("bad",))
    events = table("channel_partner_id string, is_failure boolean", ("good", False), ("good", None),
                   ("bad", True), ("bad", False), ("bad", False), (None, True))
    got = by_id(marts.dim_channel_partners(partners, events), "channel_partner_id")
    assert {k: r["partner_operations_segment"] for k, r in got.items()} == {
        "quiet": "no_api_activity", "good": "healthy_api_performance", "bad": "elevated_api_failures",
    }
    assert got["bad"]["partner_api_failure_rate"] == Decimal("0.3333")
    assert got["quiet"]["partner_api_failure_rate"] is None


def test_site_specific_parent_types(table):
    logs = table("api_log_id int, parent_type string, parent_id string", (1, "mod_orders", "o"), (2, "mod_partners", "p"))
    orders = table("order_id string, channel_partner_id string", ("o", "cp"))
    subs = table("subscription_id string, channel_partner_id string", ("s", "cp"))
    customers = table("customer_id string, channel_partner_id string", ("c", "cp"))
    partners = table("channel_partner_id string, partner_name string", ("cp", "P"))
    out = conform.int_partner_api_events(
        logs, orders, subs, customers, partners,
        {conform.PARENT_ORDER: "mod_orders", conform.PARENT_PARTNER: "mod_partners"},
    )
    assert {r.api_log_id: (r.channel_partner_id, r.partner_name) for r in out.collect()} == {
        1: ("cp", "P"), 2: ("p", None),
    }
