"""Counts from interval ends against the snapshots they stand for."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from subscope.plans import kpis, metrics
from subscope.plans.conform import int_subscription_snapshots_monthly, monthly_snapshot_counts
from subscope.plans.warehouse import Warehouse
from subscope.sources.bindings import bound_raw

AS_OF = "2001-11-20"
FLAGS = ("is_active", "is_active_at_quarter_start", "is_churned", "is_upgraded", "is_kifed")
SCHEMA = """subscription_id string, subscription_status string, created_at timestamp, updated_at timestamp,
    service_started_at date, service_ended_at date, subscription_close_date date, channel_partner_id string,
    program_id string, partner_name string, monthly_subscription_amount_sar decimal(18,4), is_mrr_eligible boolean,
    is_churned boolean, is_upgraded boolean, is_kifed boolean"""


def some_day(rng, share_of_nulls):
    if rng.random() < share_of_nulls:
        return None
    day = date(2000, 11, 1) + timedelta(days=rng.randrange(500))
    return day.replace(day=1) if rng.random() < 0.2 else day


@pytest.fixture(scope="module")
def subscriptions(spark):
    rng, rows = random.Random(5), []
    for i in range(600):
        created, updated = some_day(rng, 0.05), some_day(rng, 0.1)
        rows.append((
            f"s{i}", rng.choice(["active", "active", "cancelled", None]),
            created and datetime(created.year, created.month, created.day, 13), updated and datetime(updated.year, updated.month, updated.day),
            some_day(rng, 0.2), some_day(rng, 0.5), some_day(rng, 0.6),
            rng.choice(["p1", "p2", None]), "g", "n", None, True, *(rng.choice([True, False, None]) for _ in range(3))))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("by", [[], ["channel_partner_id"], ["channel_partner_id", "subscription_status"]])
def test_counts_are_those_of_the_snapshots(subscriptions, by):
    snapshots = int_subscription_snapshots_monthly(subscriptions, AS_OF).select(
        *by, "snapshot_month", "snapshot_quarter", F.col("is_active_at_month_end").alias("is_active"),
        "is_active_at_quarter_start", *[F.col(f"{c}_in_month").alias(c) for c in FLAGS[2:]])
    want = snapshots.groupBy(*by, "snapshot_month", "snapshot_quarter").agg(
        F.count(F.lit(1)).alias("snapshots"), *[F.count_if(c).alias(c) for c in FLAGS],
        F.count_if(F.col("is_upgraded") | F.col("is_kifed")).alias("is_upgraded_or_kifed"))
    flags = [*FLAGS, "is_upgraded_or_kifed"]
    got = monthly_snapshot_counts(subscriptions, AS_OF, by, flags).select(want.columns)
    assert want.count() > 15
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = monthly_snapshot_counts(subscriptions, AS_OF, by, ["is_churned"])
    assert set(one.columns) == {*by, "snapshot_month", "snapshot_quarter", "snapshots", "is_churned"}


def test_no_subscriptions_have_no_months(subscriptions):
    assert monthly_snapshot_counts(subscriptions.limit(0), AS_OF, [], FLAGS).isEmpty()
    with pytest.raises(KeyError):
        monthly_snapshot_counts(subscriptions, AS_OF, [], ["is_late"])


@pytest.fixture(scope="module")
def both(spark, sf_dir):
    lazy = Warehouse(spark, bound_raw(spark, sf_dir), AS_OF, calendar_start="1995-01-01")
    name = "fct_subscription_monthly_snapshots"
    return lazy, Warehouse(spark, bound_raw(spark, sf_dir), AS_OF, "1995-01-01", ready={name: lazy[name]})


PARTNER = "channel_partner__partner_name"
ASKED = {
    "churn by quarter": lambda w: metrics.metric(w, "churn_rate", grain="quarter"),
    "active by partner and status": lambda w: metrics.metric(
        w, "active_subscriptions_at_month_end", [PARTNER, "subscription_status"], "month"),
    "sliced by partner and quarter": lambda w: metrics.metric(
        w, "churn_rate", ["program__program_name"], slicers={PARTNER: ["ASIA"], "snapshot_quarter": [date(1998, 1, 1)]}),
    "whole": lambda w: metrics.measure(w, "subscription_monthly_snapshots", "snapshot_subscriptions_count"),
    "kpi": lambda w: kpis.kpi(w, "upgrade_rate", [PARTNER]),
    "kpi of a quarter": lambda w: kpis.kpi(w, "churn_rate", slicers={"snapshot_quarter": [date(1998, 4, 1)]}),
    "kpi by quarter": lambda w: kpis.kpi(w, "churn_rate", ["snapshot_quarter"]),
    "by a flag": lambda w: metrics.metric(w, "active_subscriptions_at_month_end", ["is_churned"]),
}


@pytest.mark.parametrize("name", ASKED)
def test_rates_are_the_same_from_snapshots_that_are_written(both, name):
    counted, written = (ASKED[name](w) for w in both)
    assert sorted(map(str, counted.collect())) == sorted(map(str, written.select(counted.columns).collect()))


def test_rates_do_not_expand_subscriptions(both):
    lazy, _ = both
    for name in ("churn by quarter", "kpi", "kpi by quarter", "whole"):
        plan = ASKED[name](lazy)._jdf.queryExecution().optimizedPlan().toString()
        assert "explode" not in plan and plan.count("Generate inline") == 2, name
    assert "explode" in ASKED["by a flag"](lazy)._jdf.queryExecution().optimizedPlan().toString()
