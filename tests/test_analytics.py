"""Metric and KPI definitions, where they differ, and report order; quality and profiling."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from subscope.plans import kpis, metrics, reports
from subscope.plans.semantics import METRICS, MODELS, Derived, Ratio, Simple
from subscope.quality import checks, contracts, profile
from subscope.schemas import TableSpec

ORDERS = (
    "order_id string, order_date date, delivered_at date, first_paid_at timestamp, "
    "channel_partner_id string, program_id string, customer_id string, order_status string, "
    "is_preorder boolean, is_gmv_eligible boolean, gmv_amount_sar decimal(18,4)"
)


@pytest.fixture
def w(spark, table):
    from datetime import datetime
    from decimal import Decimal

    day = date(2024, 1, 1)
    return {
        "fct_orders": table(
            ORDERS,
            ("1", day, date(2024, 1, 11), datetime(2024, 1, 9, 23), "a", "p", "c", "ok", True, True, Decimal(10)),
            ("2", day, date(2024, 1, 3), None, "a", "q", "c", "ok", False, True, Decimal(20)),
            ("3", date(2024, 2, 1), date(2024, 2, 2), None, "x", "p", None, "void", True, False, Decimal(40)),
            ("4", date(2024, 2, 1), None, None, None, "p", "d", None, None, None, None),
        ),
        "dim_channel_partners": table("channel_partner_id string, partner_name string", ("a", "A"), ("b", "B")),
        "dim_programs": table(
            "program_id string, program_name string, channel_partner_id string, subscription_limit int, "
            "utilization_subscription_count bigint", ("p", "P", "a", 10, 30), ("q", "Q", "a", 30, 10), ("r", "R", "b", 0, 5)),
        "dim_customers": table(
            "customer_id string, device_count bigint, corporate_company_id string", ("c", 4, None), ("d", 0, None)),
        "fct_devices": table("device_id string, customer_id string", ("1", "c"), ("2", "c"), ("3", "c"), ("4", "c")),
        "fct_subscription_monthly_snapshots": table(
            "snapshot_quarter date, channel_partner_id string, is_churned boolean, is_upgraded boolean, "
            "is_kifed boolean, is_active_at_quarter_start boolean",
            (day, "a", True, False, False, True), (day, "a", False, True, False, True),
            (date(2024, 4, 1), "a", True, False, True, False), (day, "b", True, False, False, True),
        ),
        "fct_invoices": table(
            "invoice_date date, channel_partner_id string, customer_id string, is_paid boolean",
            (day, "a", "c", False), (day, "a", "d", None), (day, "a", "e", True), (day, "a", None, False)),
        "fct_payment_attempts": table(
            "attempt_date date, channel_partner_id string, customer_id string, "
            "is_outstanding_retry_failure boolean",
            (day, "a", "c", True), (day, "a", "f", True), (day, "a", "g", False)),
    }


def one(df):
    return df.collect()[0][-1]


def test_the_two_definitions_of_each_kpi(w):
    assert one(metrics.metric(w, "preorder_order_share")) == 2 / 4
    assert one(kpis.kpi(w, "preorder_share")) == 1 / 2
    assert one(metrics.metric(w, "avg_days_payment_to_delivery")) == (10 + 2) / 2
    assert one(kpis.kpi(w, "avg_days_payment_to_delivery")) == 2.0  # from the paid day, paid only
    assert one(metrics.metric(w, "avg_devices_per_customer")) == 4.0
    assert one(kpis.kpi(w, "avg_devices_per_customer")) == 2.0
    assert one(metrics.metric(w, "program_subscription_utilization_pct")) == 45 / 40
    assert abs(one(kpis.kpi(w, "program_subscription_utilization")) - (3 + 1 / 3) / 2) < 1e-9
    # 1 + 3 counts c twice; the union has c, d (payment state unknown) and f
    assert one(metrics.metric(w, "customers_with_outstanding_payments")) == 1 + 3
    assert one(kpis.kpi(w, "customers_with_outstanding_payments")) == 3
    assert one(metrics.metric(w, "churn_rate")) == 3 / 3


def test_churn_takes_the_latest_or_the_selected_quarter(w):
    quarter = {"snapshot_quarter": [date(2024, 1, 1)]}
    assert one(kpis.kpi(w, "churn_rate")) == 0.0  # latest quarter has no base
    assert one(kpis.kpi(w, "churn_rate", slicers=quarter)) == 2 / 3
    assert one(kpis.kpi(w, "upgrade_rate", slicers=quarter)) == 1 / 3
    by_partner = kpis.kpi(w, "churn_rate", [reports.PARTNER])
    assert {tuple(r) for r in by_partner.collect()} == {("A", 0.0), ("B", 1.0)}
    by_quarter = kpis.kpi(w, "churn_rate", ["snapshot_quarter"])
    assert {r[0]: r[1] for r in by_quarter.collect()}[date(2024, 1, 1)] == 2 / 3


def test_metric_by_linked_dimension_keeps_the_unmatched(w):
    got = metrics.metric(w, "orders_total_count", [reports.PARTNER], "month")
    assert {tuple(r) for r in got.collect()} == {
        (date(2024, 1, 1), "A", 2), (date(2024, 2, 1), None, 2),
    }


def test_metric_median_and_distinct_by_linked_dimension(w):
    got = metrics.metric(w, "median_order_to_delivery_days", [reports.PROGRAM])
    assert {tuple(r) for r in got.collect()} == {("P", 5.5), ("Q", 2.0)}


def test_metric_filters_and_slicers(w):
    assert one(metrics.metric(w, "orders_total_count", where=F.col("order_id") > "1")) == 3
    assert one(metrics.metric(w, "orders_total_count", slicers={reports.PROGRAM: ["P"]})) == 3
    assert one(metrics.metric(w, "orders_total_count", slicers={"order_status": ["ok"]})) == 2


def test_metric_rejects_what_is_not_a_dimension(w):
    with pytest.raises(KeyError):
        metrics.metric(w, "gmv_sar", ["gmv_amount_sar"])
    with pytest.raises(KeyError):
        metrics.metric(w, "gmv_sar", ["invoice__is_paid"])


def test_fill_periods(w, table):
    gmv = metrics.metric(w, "gmv_sar", grain="month")
    spine = table("m date", (date(2024, 1, 1),), (date(2024, 2, 1),))
    assert {tuple(r) for r in metrics.fill_periods(gmv, spine, ["gmv_sar"]).collect()} == {
        (date(2024, 1, 1), 30), (date(2024, 2, 1), 0),
    }


def test_report_order_and_blank_member(w):
    rows = [tuple(r) for r in reports.gmv_by_partner(w).collect()]
    assert rows == [("A", 30), (None, None)]


def test_kpis_of_different_marts_cannot_share_a_pass(w):
    with pytest.raises(ValueError):
        kpis.kpis(w, ["orders", "subscriptions"])


def test_inventory_sizes():
    kinds = [type(m) for m in METRICS.values()]
    assert (kinds.count(Simple), kinds.count(Ratio), kinds.count(Derived)) == (37, 5, 3)
    assert len(MODELS) == 24 and len(kpis.ALL_KPIS) == 29


# --- quality --------------------------------------------------------------------------


def test_declared_checks_by_kind():
    kinds = [c.kind for c in contracts.all_checks()]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 101, "not_null": 116, "relationships": 138, "accepted_values": 25,
        "unique_combination": 2,
    }
    assert sum(c.severity == checks.WARN for c in contracts.all_checks()) == 92
    assert sum(c.where is not None for c in contracts.all_checks()) == 5


@pytest.fixture
def tables(table):
    return {
        "child": table("id string, fk string, s string", ("1", "a", "x"), ("1", "z", "y"), ("2", "z", "q"),
                       ("2", None, None), (None, "y", "q"), (None, "a", "r")),
        "parent": table("pk string", ("a",), ("b",)),
    }


def run(tables, *lots):
    return {(r["check"], r.column): (r.failures, r.status) for r in checks.run_checks(tables, lots).collect()}


def test_run_checks(tables):
    c = checks.Check
    rel = {"parent": "parent", "parent_key": "pk"}
    got = run(
        tables,
        c("not_null", "child", ("id",)), c("not_null", "child", ("fk",), "warn"),
        c("unique", "child", ("id",)), c("accepted_values", "child", ("s",), values=("x", "y")),
        c("relationships", "child", ("fk",), **rel),
        c("unique_combination", "child", ("id", "fk")),
    )
    assert got == {
        ("not_null", "id"): (2, "fail"), ("not_null", "fk"): (1, "warn"),
        ("unique", "id"): (2, "fail"), ("accepted_values", "s"): (2, "fail"),
        ("relationships", "fk"): (3, "fail"), ("unique_combination", "id,fk"): (0, "pass"),
    }


def test_conditions_tolerance_and_relaxing(tables):
    c = checks.Check("relationships", "child", ("fk",), parent="parent", parent_key="pk", max_ratio=0.6)
    assert run(tables, c) == {("relationships", "fk"): (3, "pass")}
    strict = checks.Check("relationships", "child", ("fk",), parent="parent", parent_key="pk",
                          where="s in ('x', 'y')")
    assert run(tables, strict) == {("relationships", "fk"): (1, "fail")}
    relaxed = checks.relax([strict, checks.Check("unique", "child", ("id",))], ["relationships"])
    assert [x.severity for x in relaxed] == ["warn", "error"]
    assert contracts.gate(relaxed) == [relaxed[1]]


def test_checks_from_spec():
    spec = TableSpec("t", ("a", "b"), (("f", "p", "k"),), (("s", ("x",)),), ("s",), (("s", "f > 1"),), ("f",))
    got = [(c.kind, c.columns, c.severity, c.where) for c in checks.checks_from_spec(spec)]
    assert got == [
        ("unique_combination", ("a", "b"), "error", None), ("not_null", ("a",), "error", None),
        ("not_null", ("b",), "error", None), ("not_null", ("s",), "error", None),
        ("relationships", ("f",), "warn", None), ("accepted_values", ("s",), "error", "f > 1"),
    ]


def test_profile(table):
    df = table("id string, deleted boolean, x int", ("1", True, None), ("1", None, None), ("2", False, None), (None, True, None))
    assert profile.profile_table(df, "id").collect()[0].asDict() == {
        "row_count": 4, "distinct_keys": 2, "duplicated_keys": 1, "deleted_rows": 2,
    }
    rates = {r.column: (r.null_rows, r.null_rate, r.is_all_null) for r in profile.null_rates(df).collect()}
    assert rates == {"id": (1, 0.25, False), "deleted": (1, 0.25, False), "x": (4, 1.0, True)}
    assert [tuple(r) for r in profile.value_counts(df, "id").collect()] == [("1", 2), (None, 1), ("2", 1)]


def test_checks_run_table_by_table_and_keep_only_their_rows(tables):
    lots = [
        checks.Check("unique", "child", ("id",)), checks.Check("unique", "parent", ("pk",)),
        checks.Check("relationships", "child", ("fk",), parent="parent", parent_key="pk"),
        checks.Check("relationships", "parent", ("pk",), parent="child", parent_key="fk"),
    ]
    found = checks.run_checks(tables, lots)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Scan" in plan  # no shuffle of the checks is left
    assert {(r.check, r.model, r.failures) for r in found.collect()} == {
        ("unique", "child", 2), ("unique", "parent", 0), ("relationships", "child", 3), ("relationships", "parent", 1)}


def test_repeated_combinations_are_told_by_their_places(table, monkeypatch):
    day = date(2024, 1, 1)
    rows = [("a", day), ("a", date(2024, 2, 1)), ("a", date(2024, 2, 2)), ("b", day), ("b", None), (None, day), (None, None)]
    counted = lambda *more: checks.dq_unique_combination(table("k string, d date", *rows, *more), ["k", "d"])
    assert counted().first()[0] == 0  # two days share a place, no combination repeats
    assert counted(("b", None), (None, day), (None, day), ("a", day), ("c", day)).first()[0] == 3
    monkeypatch.setattr(checks, "SLOTS", 64)
    far = [("z", date(2000 + i, 1, 1)) for i in range(70)]
    assert counted(*far).first()[0] == 0 and counted(*far, far[3]).first()[0] == 1


@pytest.mark.parametrize("kind, values", [
    ("bigint", (1, 257, -1, None)), ("string", ("x", "", None)), ("double", (0.0, float("nan"), None)), ("timestamp", (None,))])
def test_repeated_combinations_of_any_type(table, kind, values):
    rows = [(k, v) for k in ("a", "b", None) for v in values]
    counted = lambda *more: checks.dq_unique_combination(table(f"k string, v {kind}", *rows, *more), ["k", "v"]).first()[0]
    assert counted() == 0 and counted(rows[0], rows[0], rows[-1]) == 2
