"""Join, aggregate and set operators, also under skew, against brute force."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import date
from statistics import median

import pytest
from pyspark.sql import functions as F

from subscope.operators import aggs, joins, sets
from subscope.sources.calendar import calendar_for, date_spine


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_enrich_keeps_rows_and_flags(table):
    fact = table("id string, k string", ("1", "a"), ("2", "x"), ("3", None))
    dim = table("k string, v int", ("a", 10), ("b", 20), (None, 30))
    for spread in (None, "id"):
        out = joins.enrich(fact, dim, ("k", "k"), {"w": "v"}, flag="hit", spread=spread)
        got = {r["id"]: (r["w"], r["hit"]) for r in out.collect()}
        assert got == {"1": (10, True), "2": (None, False), "3": (None, False)}
        assert out.columns == ["id", "k", "w", "hit"]


def test_existence_flag_does_not_fan_out(table):
    fact = table("id int, k string", (1, "a"), (2, "b"))
    dim = table("k string", ("a",), ("a",))
    out = joins.enrich(fact, dim, ("k", "k"), flag="hit")
    assert sorted((r.id, r.hit) for r in out.collect()) == [(1, True), (2, False)]


def test_spread_puts_null_keys_in_many_partitions(spark):
    fact = spark.range(4000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("k")).alias("k"),
    )
    dim = spark.range(10).select(F.col("id").cast("string").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.enrich(fact, dim, ("k", "k"), flag="hit", spread="id")
        out = joins.enrich(fact, dim.withColumn("v", F.lit(1)), ("k", "k"), ["v"], spread="id")
        sizes = out.where("k is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * 2667 / 8


def test_hot_key_join_and_rollup_match_brute_force(spark):
    """One key holds a third of the rows, another third has no key."""
    n = 30_000
    fact = spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, (F.col("id") % 97).cast("string")).alias("k"),
        (F.col("id") % 11).alias("x"),
    )
    dim = spark.range(97).select(F.col("id").cast("string").alias("k")).union(
        spark.createDataFrame([("hot",)], "k string")
    )
    expected = defaultdict(int)
    for i in range(n):
        if i % 3 < 2:
            expected["hot" if i % 3 == 0 else str(i % 97)] += i % 11
    joined = joins.enrich(fact, dim, ("k", "k"), {"name": "k"}, flag="hit", spread="id")
    assert joined.count() == n and joined.where("hit").count() == 2 * n // 3
    rolled = joins.with_rollup(dim, fact, ("k", "k"), {"s": F.sum("x")}, {"s": 0})
    assert {r["k"]: r["s"] for r in rolled.collect()} == dict(expected)


def test_adaptive_execution_splits_a_hot_key(spark):
    """A key with a third of the rows is split over tasks; nothing is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 60_000, 1, 16).select(
            F.col("id").cast("string").alias("id"),
            F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise((F.col("id") % 5000).cast("string")).alias("k"),
        )
        dim = spark.range(0, 5000, 1, 4).select(
            F.col("id").cast("string").alias("k"), F.sha1(F.col("id").cast("string")).alias("v")
        )
        out = joins.enrich(fact, dim, ("k", "k"), ["v"], spread="id")
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 60_000 and all(r.v is not None for r in rows)
    assert "skew=true" in plan


def test_shuffles_are_sized_for_the_input(spark):
    from subscope.session import INITIAL_PARTITIONS, size_shuffle

    try:
        assert size_shuffle(spark, 1024) == 8
        assert size_shuffle(spark, 100 * 1024**4) == 819_200
        assert size_shuffle(spark, 1024**4) == 819_200  # never lowered
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def test_polymorphic_lookup(table):
    logs = table("id int, t string, p string", (1, " A ", "k"), (2, "b", "k"), (3, "self", "z"),
                 (4, "c", "k"), (5, None, "k"), (6, "a", "nope"), (7, "a", None))
    a, b = table("k string, v string", ("k", "va")), table("k string, v string", ("k", "vb"))
    out = joins.polymorphic_lookup(logs, "t", "p", {"a": (a, "k", "v"), "b": (b, "k", "v")}, "o", "self")
    assert {r.id: r.o for r in out.collect()} == {
        1: "va", 2: "vb", 3: "z", 4: None, 5: None, 6: None, 7: None,
    }


def test_merge_by_key_unions_keys_and_null_matches_nothing(table):
    x = table("m string, a bigint", ("1", 5), (None, 7))
    y = table("m string, b bigint", ("2", 3), (None, 9))
    out = joins.merge_by_key("m", [(x, {"a": 0}), (y, {"b": 0})])
    assert {r.m: (r.a, r.b) for r in out.collect()} == {"1": (5, 0), "2": (0, 3), None: (0, 0)}


def test_reconcile_statuses(table):
    left = table("id string, ref string, amt int", ("1", None, 1), ("2", "p2", 1), ("3", "p3", 1),
                 ("4", "p4", 1), ("5", "p5", None), ("6", "p6", None))
    right = table("ref string, amt int", ("p3", 2), ("p4", 1), ("p5", None), ("p6", 1))
    out = joins.reconcile(left, right, ("ref", "ref"), ("amt", "other"), {"other": "amt"},
                          "hit", "status", "reason", spread="id")
    assert {r.id: r.status for r in out.collect()} == {
        "1": "no_psp_reference", "2": "missing_in_psp", "3": "amount_mismatch",
        "4": "reconciled", "5": "reconciled", "6": "amount_mismatch",
    }
    reasons = {r.status: r.reason for r in out.collect()}
    assert reasons == joins.RECONCILIATION


def test_sku_paths(table):
    items = table("order_item_id string, program_sku_id string, cp_sku_id string",
                  ("own", "p1", None), ("bridge", None, "c1"), ("master", None, "c2"),
                  ("both", "p9", "c1"), ("none", None, None), ("blank", "p3", None))
    cols = "brand string, model string, memory string, color string, device_sku_key string"
    masters = table(f"master_sku_id string, {cols}", ("m1", "B1", "M", "1", "c", "B1|M|1|c"),
                    ("m2", "B2", None, None, None, "B2"), ("m3", None, None, None, None, ""))
    skus = joins.enrich(
        table("program_sku_id string, master_sku_id string", ("p1", "m1"), ("p2", "m2"), ("p3", "m3")),
        masters, ("master_sku_id", "master_sku_id"),
        ["brand", "model", "memory", "color", "device_sku_key"],
    )
    bridge = table("cp_sku_id string, program_sku_id string, master_sku_id string",
                   ("c1", "p2", "m1"), ("c2", None, "m1"))
    out = {r.order_item_id: r for r in joins.resolve_sku(items, skus, bridge, masters, "order_item_id").collect()}
    key = {i: r.device_sku_key for i, r in out.items()}
    assert key == {"own": "B1|M|1|c", "bridge": "B2", "master": "B1|M|1|c", "both": "B2",
                   "none": "sku_unknown", "blank": ""}
    # attributes are filled path by path: the model comes from the partner SKU's master
    assert (out["bridge"].brand, out["bridge"].model) == ("B2", "M")
    assert out["both"].resolved_program_sku_id == "p9" and not out["both"].has_valid_program_sku
    assert out["both"].has_valid_resolved_sku and not out["none"].has_valid_resolved_sku
    assert out["master"].has_valid_cp_sku and not out["master"].has_valid_resolved_sku
    assert out["blank"].master_sku_id == "m3"


def test_orphans_and_match_rate(table):
    child = table("k string", ("a",), ("a",), ("x",), ("x",), ("y",), (None,))
    parent = table("k string", ("a",), (None,))
    assert {(r.fk, r.n) for r in joins.orphans(child, "k", parent, "k").collect()} == {("x", 2), ("y", 1)}
    assert dicts(joins.match_rate(child, parent, ("k", "k"))) == [
        {"reference_count": 5, "matched_count": 2, "match_rate": 0.4}
    ]


def test_slice_by(table):
    fact, dim = table("k int", (1,), (2,), (None,)), table("k int, n string", (1, "a"), (2, "b"))
    assert dicts(joins.slice_by(fact, dim, F.col("n") == "b", ("k", "k"))) == [{"k": 2}]


def test_conditional_sums_are_null_without_rows(table):
    df = table("x int, p boolean", (1, True), (2, None), (4, False))
    out = df.agg(aggs.sum_where("x", "p").alias("s"), aggs.sum_where("x", F.lit(False)).alias("n"),
                 aggs.count_where("p").alias("c"), aggs.sum_where("x", ~F.col("p")).alias("f"))
    assert dicts(out) == [{"s": 1, "n": None, "c": 1, "f": 4}]


def test_exact_median_matches_brute_force(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("g"),
        F.when(F.col("id") % 13 != 0, (F.col("id") * 7919 % 101)).alias("x"),
    )
    groups = defaultdict(list)
    for r in df.collect():
        if r.x is not None:
            groups[r.g].append(r.x)
    got = {r.g: r.m for r in aggs.exact_median(df, ["g"], F.col("x"), "m").collect()}
    assert got == {g: float(median(v)) for g, v in groups.items()}
    near = {r.g: r.m for r in aggs.exact_median(df, ["g"], F.col("x"), "m", approx=True).collect()}
    assert all(abs(near[g] - got[g]) <= 1 for g in got)


def test_date_rollup_levels(table):
    df = table("d date, x int", (date(2024, 1, 1), 1), (date(2024, 1, 2), 2), (date(2024, 4, 1), 4), (None, 8))
    out = aggs.date_rollup(df, "d", {"s": F.sum("x")})
    totals = {(r.level, r.year, r.quarter_no, r.month_no, r.day): r.s for r in out.collect()}
    assert totals[(0, None, None, None, None)] == 15
    assert totals[(2, 2024, 1, None, None)] == 3 and totals[(4, 2024, 1, 1, 2)] == 2
    assert totals[(1, None, None, None, None)] == 8  # undated rows are a group of their own


def test_mean_ignores_null_and_monthly_fallback(table):
    df = table("a date, b date, x int", (None, date(2024, 1, 5), 3), (date(2024, 2, 9), None, 5),
               (None, None, 7))
    assert dicts(df.agg(aggs.mean(F.col("x")).alias("m")))[0]["m"] == 5.0
    by_month = aggs.monthly_agg(df, ["a", "b"], {"n": F.sum("x")}, "m")
    assert {(r.m, r.n) for r in by_month.collect()} == {(date(2024, 1, 1), 3), (date(2024, 2, 1), 5)}


def test_dedup_first_under_a_hot_key(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"),
        F.format_string("%05d", F.col("id") * 7919 % 9001).alias("o"),
    )
    expected = {}
    for r in df.collect():
        expected[r.k] = min(expected.get(r.k, r.o), r.o)
    out = sets.dedup_first(df, ["k"], ["o"])
    assert {r.k: r.o for r in out.collect()} == expected
    assert out.count() == len(expected)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_k_per_group(table):
    df = table("g string, i string", ("a", "x"), ("a", "x"), ("a", "y"), ("a", "z"), ("b", "y"))
    out = sets.top_k_per_group(df, ["g"], ["i"], aggs.count_rows(), "n", 2)
    assert {(r.g, r.i, r.n, r["rank"]) for r in out.collect()} == {
        ("a", "x", 2, 1), ("a", "y", 1, 2), ("b", "y", 1, 1),
    }


def test_set_operations(table):
    a, b = table("k string", ("1",), ("2",), (None,)), table("k string", ("2",), ("3",), (None,))
    assert Counter(r.k for r in sets.union_keys(a, b).collect()) == Counter(["1", "2", "3", None])
    assert dicts(sets.union_distinct_count(a, b, "k", "n")) == [{"n": 3}]
    u = sets.conform_union({"a": a, "b": b.withColumnRenamed("k", "j")}, {"k": "string", "j": "string"}, "s")
    assert {(r.s, r.k, r.j) for r in u.collect()} == {
        ("a", "1", None), ("a", "2", None), ("a", None, None),
        ("b", None, "2"), ("b", None, "3"), ("b", None, None),
    }


def test_spines(spark, table):
    assert date_spine(spark, "2024-02-28", "2024-03-01").count() == 2  # end exclusive
    assert date_spine(spark, "2024-03-01", "2024-03-01").count() == 0
    assert date_spine(spark, "2024-03-02", "2024-03-01").count() == 0
    cal = calendar_for(table("d date", (date(2023, 6, 1),), (date(2024, 2, 1),)), "d")
    lo, hi, n = cal.agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert (lo, hi, n) == (date(2023, 1, 1), date(2024, 12, 31), 365 + 366)


@pytest.mark.parametrize("given", [{"partitionColumn": "id"}, {"numPartitions": "8"}])
def test_jdbc_scan_refuses_half_a_partitioning(given):
    from subscope.sources.raw import jdbc_options

    with pytest.raises(ValueError):
        jdbc_options("jdbc:postgresql://h/d", "t", given)
    assert jdbc_options("jdbc:postgresql://h/d", "t")["dbtable"] == "t"


def test_lookup_of_flagged_rows_only(table):
    fact = table("id string, k string, f boolean", ("1", "a", True), ("2", "a", False), ("3", None, True), ("4", "x", True), ("5", "a", None))
    dim = table("k string, v int", ("a", 10), ("a", 11), (None, 30))
    for spread in (None, "id"):
        out = joins.enrich(fact, dim, ("k", "k"), ["v"], flag="hit", spread=spread, when="f")
        assert Counter((r["id"], r["v"], r["hit"]) for r in out.collect()) == Counter([
            ("1", 10, True), ("1", 11, True), ("2", None, False), ("3", None, False), ("4", None, False), ("5", None, False)])
