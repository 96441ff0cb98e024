"""The whole pipeline written to disk, read back, and checked."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from subscope.plans import kpis, metrics, reports
from subscope.plans.warehouse import MARTS, SHARED, Warehouse, build, shared_folder
from subscope.quality import checks, contracts
from subscope.sources.bindings import bound_raw
from subscope.sources.sinks import mart_path, write_bucketed

AS_OF = "2001-11-20"


@pytest.fixture(scope="module")
def lazy(spark, sf_dir):
    return Warehouse(spark, bound_raw(spark, sf_dir), AS_OF, calendar_start="1995-01-01")


@pytest.fixture(scope="module")
def written(spark, lazy, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("marts"))
    paths = build(lazy, out, shared=f"{out}/_shared")
    assert set(paths) == set(MARTS)
    return Warehouse.of_marts(spark, out, AS_OF), out


def test_written_marts_equal_the_lazy_ones(lazy, written):
    marts, _ = written
    for name in MARTS:
        a, b = lazy[name], marts[name].select(lazy[name].columns)
        assert a.count() == b.count(), name
    for name in ("fct_devices", "dim_device_skus", "fct_partner_api_events", "dim_subscription_pricing"):
        a, b = lazy[name], marts[name].select(lazy[name].columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_layout_on_disk(written):
    marts, out = written
    path = mart_path(marts.spark, out, "fct_subscription_monthly_snapshots")
    assert any(d.startswith("snapshot_quarter=") for d in os.listdir(path))
    assert set(os.listdir(f"{out}/_shared")) == set(SHARED)


def test_quarter_filter_prunes_partitions(written):
    marts, _ = written
    df = marts["fct_subscription_monthly_snapshots"].where("snapshot_quarter = date '1999-01-01'")
    assert "PartitionFilters: [isnotnull(snapshot_quarter" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("setting, on_context, expected", [
    ("/shared/", None, "/shared/run-"), (None, "/context", "/context/run-"), (None, None, "/x/run-"),
])
def test_shared_folder_follows_the_cluster_setting(setting, on_context, expected):
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": setting}[key] or default)
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: on_context))
    assert shared_folder(session, "/x").startswith(expected)
    assert shared_folder(session, "/x") != shared_folder(session, "/x")


GRAIN = {  # mart -> staged table it has one row per row of
    "fct_orders": "stg_orders", "fct_order_items": "stg_order_items", "dim_customers": "stg_accounts",
    "fct_subscriptions": "stg_subscriptions", "fct_payments": "stg_payments",
    "fct_payment_attempts": "stg_payment_history", "fct_psp_transactions": "stg_psp_transactions",
    "fct_invoices": "stg_invoices", "fct_invoice_line_items": "stg_invoice_line_items",
    "fct_credit_notes": "stg_credit_notes", "fct_devices": "stg_devices",
    "fct_device_journey_events": "stg_devices_journey", "fct_partner_api_events": "stg_api_logs",
    "dim_programs": "stg_programs", "dim_device_skus": "stg_master_skus", "bridge_cp_skus": "stg_cp_skus",
}


def test_no_mart_fans_out(lazy, written):
    marts, _ = written
    for mart, source in GRAIN.items():
        assert marts[mart].count() == lazy[source].count(), mart


def test_keys_are_unique_and_present(written):
    marts, _ = written
    lots = [c for c in contracts.checks_of(contracts.MARTS)
            if c.kind in (checks.UNIQUE, checks.COMBINATION, checks.NOT_NULL)]
    bad = [(r.model, r.column, r.failures) for r in checks.run_checks(marts, lots).collect() if r.status == "fail"]
    # the one undated month of credit notes is part of the data
    assert bad == [("fct_finance_reconciliation_monthly", "reconciliation_month", 1)]


def test_finance_invariants(written):
    marts, _ = written
    variance = kpis.kpi(marts, "finance_variance_sar").first()[0]
    collected = kpis.kpi(marts, "collected_revenue_sar").first()[0]
    invoiced = kpis.kpi(marts, "invoiced_revenue_sar").first()[0]
    assert variance == collected - invoiced
    statuses = marts["fct_payments"].groupBy("psp_reconciliation_status").count().collect()
    assert {r[0] for r in statuses} == {"no_psp_reference", "missing_in_psp", "amount_mismatch", "reconciled"}
    assert sum(r[1] for r in statuses) == marts["fct_payments"].count()


def test_metrics_and_reports_run_on_written_marts(written):
    marts, _ = written
    total = metrics.metric(marts, "gmv_sar").first()[0]
    by_partner = reports.gmv_by_partner(marts)
    assert by_partner.agg(F.sum("gmv_sar")).first()[0] == total


def test_bucketed_facts_join_without_a_shuffle(spark, written, tmp_path):
    marts, _ = written
    names = []
    for name in ("fct_orders", "fct_payments"):
        table = f"bucketed_{name}_{os.getpid()}"
        spark.sql(f"drop table if exists {table}")
        # an explicit location keeps the test's files out of the repository
        spark.sql(f"create database if not exists buckets_{os.getpid()} location '{tmp_path}'")
        names.append(write_bucketed(marts[name], f"buckets_{os.getpid()}.{table}", ["order_id"], 4))
    left, right = (spark.table(n) for n in names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = left.join(right, "order_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.sql(f"drop database buckets_{os.getpid()} cascade")
    assert "SortMergeJoin" in p and "Exchange" not in p
