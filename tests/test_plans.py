"""What the optimizer makes of the operators: shuffles, pushdown, join kinds."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from subscope.plans import metrics, reports
from subscope.plans.warehouse import STAGED, Warehouse
from subscope.schemas import RAW_TABLES, raw_schema
from subscope.sources.raw import read_raw


@pytest.fixture(scope="module")
def raw_root(spark, tmp_path_factory):
    """Empty raw tables on disk: enough to plan against."""
    root = str(tmp_path_factory.mktemp("raw"))
    for t in RAW_TABLES:
        spark.createDataFrame([], raw_schema(t)).write.parquet(f"{root}/{t}")
    return root


@pytest.fixture(scope="module")
def w(spark, raw_root):
    return Warehouse.over(spark, raw_root, "2024-06-15")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(STAGED))
def test_staging_is_narrow_with_pushed_filter(w, name):
    p = plan(w[name])
    assert "Exchange" not in p and "Join" not in p
    pushed = re.search(r"PushedFilters: \[([^\]]*)", p).group(1)
    assert "deleted" in pushed


def test_only_used_columns_are_read(w):
    p = plan(w["stg_orders"].select("order_id", "order_status"))
    assert re.search(r"ReadSchema: struct<id:string,deleted:boolean,order_status:string>", p)


def test_snapshots_expand_without_a_join_back(w):
    used = w["fct_subscription_monthly_snapshots"].select("subscription_id", "snapshot_month", "is_churned")
    assert optimized(used).count("crm_subscriptions") <= 1
    assert "Generate explode" in plan(used)


def test_unused_existence_lookup_is_not_planned(w):
    used = optimized(w["fct_orders"].select("order_id", "has_valid_customer"))
    unused = optimized(w["fct_orders"].select("order_id", "order_status"))
    assert used.count("Join") > unused.count("Join")
    assert "nafath" not in unused


def test_usage_rollup_is_not_planned_for_a_program_name(w):
    p = optimized(metrics.metric(w, "orders_total_count", [reports.PROGRAM]))
    assert "subscription_status" not in p


def test_facts_are_aggregated_before_a_dimension_is_joined(w):
    p = optimized(metrics.metric(w, "orders_total_count", [reports.PROGRAM]))
    lines = p.split("\n")
    kinds = [re.search(r"(Aggregate|Join)", x).group(1) for x in lines if re.search(r"(Aggregate|Join) ", x)]
    assert kinds[:3] == ["Aggregate", "Join", "Aggregate"]


def test_no_cartesian_product_in_any_mart(w):
    from subscope.plans.warehouse import CONFORMED, MARTS

    for name in (*CONFORMED, *MARTS):
        p = plan(w[name])
        assert "Cartesian" not in p and "NestedLoop" not in p, name


def test_reconciliation_reads_no_joined_table(w):
    assert "Join" not in plan(w["fct_finance_reconciliation_monthly"])


def test_api_calls_meet_their_parents_in_one_join(w):
    df = w["int_partner_api_events"].select("api_log_id", "channel_partner_id")
    assert optimized(df).count("_kind") > 0
    assert len(re.findall(r"Join LeftOuter, \(.*_kind", optimized(df))) == 1


def test_physical_names_are_mapped(spark, tmp_path):
    site = spark.range(1).select(
        F.lit("1").alias("id"), F.lit("n").alias("name"), F.current_timestamp().alias("date_entered"),
        F.current_timestamp().alias("date_modified"), F.lit(False).alias("deleted"),
        F.lit("b").alias("barcode"), F.lit(1.0).alias("launch_rrp"), F.lit("m").alias("site_master"),
        F.lit("t").alias("program_skus_type"), F.lit("c").alias("category"),
        F.lit("u").alias("program_skus_uid"), F.current_timestamp().alias("_etl_synced_at"),
        F.lit("crm").alias("_etl_source_system"),
    )
    site.write.parquet(str(tmp_path / "site_skus"))
    got = read_raw(spark, str(tmp_path), "crm_program_skus", physical_names={
        "crm_program_skus": "site_skus", "master_skus_id": "site_master",
    })
    assert got.schema.names == raw_schema("crm_program_skus").names
    assert got.first().master_skus_id == "m"


def test_devices_cross_one_shuffle_for_item_and_subscription(spark, raw_root):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Warehouse.over(spark, raw_root, "2024-06-15")["int_devices"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\(.*device_id", p)) == 1
