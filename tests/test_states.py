"""Medians by ranks, mergeable distinct states, versioned marts, bucketed joins."""

from __future__ import annotations

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from subscope.operators.distinct_states import count_state, dictionary, distinct_state, merged_state
from subscope.operators.medians import median_by_ranks
from subscope.session import scratch_root
from subscope.sources.sinks import mart_path, read_mart, versions, write_mart


@pytest.fixture(scope="module")
def measures(spark):
    rng, rows = random.Random(3), []
    for i in range(6000):
        group = rng.choice(["even", "even", "odd", None, "few", "ties", "none"])
        x = {"few": float(i % 2), "ties": rng.choice([5.0, 5.0, 5.0, rng.gauss(5, 1)]), "none": None}.get(
            group, rng.choice([rng.gauss(0, 1e6), rng.random(), -1e300 * rng.random()]))
        rows.append((group, x))
    rows += [("one", 7.5), ("two", 1.0), ("two", 2.0), ("none", float("nan"))]
    return spark.createDataFrame(rows, "g string, x double")


@pytest.mark.parametrize("bound", [4, 50, 1 << 16])
def test_median_by_ranks(measures, bound):
    want: dict = {}
    for r in measures.collect():
        if r.x is not None and r.x == r.x:
            want.setdefault(r.g, []).append(r.x)
    got = {r.g: r.m for r in median_by_ranks(measures, ["g"], F.col("x"), "m", bound).collect()}
    assert got == {g: pytest.approx(median(xs), rel=1e-12) for g, xs in want.items()}
    whole = median_by_ranks(measures, [], F.col("x"), "m", bound).first()[0]
    assert whole == pytest.approx(median([x for xs in want.values() for x in xs]), rel=1e-12)


def test_only_the_middle_values_are_sorted_in_one_task(spark, tmp_path):
    """A million distinct values in one group: what is left to sort fits the bound."""
    rows = spark.range(1_000_000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 1_000_003).cast("double").alias("x"))
    kept = []

    def keep(df):
        path = f"{tmp_path}/{len(kept)}"
        df.write.parquet(path)
        kept.append(spark.read.parquet(path))
        return kept[-1]

    assert median_by_ranks(rows, ["g"], F.col("x"), "m", 20_000, keep).first().m == rows.select(F.median("x")).first()[0]
    assert kept[-1].count() <= 20_000


def test_no_rows_have_no_median(measures):
    assert median_by_ranks(measures.limit(0), ["g"], F.col("x"), "m").isEmpty()


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", "c", None]), rng.randrange(4), rng.choice([None, f"k{rng.randrange(40_000)}"])) for _ in range(50_000)]
    return spark.createDataFrame([*rows, ("empty", 9, None)], "g string, h int, k string")


def test_states_count_like_the_facts_at_every_level(facts):
    numbers = dictionary(facts, "k")
    distinct = [r[0] for r in numbers.orderBy("_key").select("_number").collect()]
    assert distinct == list(range(1, len(distinct) + 1)) and len(distinct) > 1 << 13
    state = distinct_state(facts, ["g", "h"], "k", numbers)
    for by in (["g", "h"], ["g"], ["h"], []):
        want = facts.groupBy(*by).agg(F.count_distinct("k").alias("n"))
        assert sorted(map(str, count_state(state, by, "n").collect())) == sorted(map(str, want.collect())), by
    again = count_state(merged_state(state, ["h"]), [], "n").first().n
    assert again == facts.agg(F.count_distinct("k")).first()[0]


def test_a_state_has_a_row_per_group_and_run_of_keys(facts):
    state = distinct_state(facts, ["g"], "k", dictionary(facts, "k"))
    assert state.groupBy("g", "bucket").count().where("count > 1").isEmpty()
    assert state.count() <= 5 * 3


def test_a_failed_refresh_leaves_the_old_mart(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        read_mart(spark, root, "m")
    first = spark.range(100).withColumn("p", F.col("id") % 3)
    write_mart(first, root, "m", ["p"])
    before = read_mart(spark, root, "m")
    broken = spark.range(0, 1000, 1, 8).withColumn("p", F.when(F.col("id") < 900, F.col("id") % 3).otherwise(
        F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        write_mart(broken, root, "m", ["p"])
    assert read_mart(spark, root, "m").count() == 100 and before.count() == 100
    write_mart(spark.range(7).withColumn("p", F.lit(0)), root, "m", ["p"])
    assert read_mart(spark, root, "m").count() == 7
    assert before.count() == 100 and read_mart(spark, root, "m", 1).count() == 100  # who reads the old one goes on
    assert [r.version for r in versions(spark, root, "m").orderBy("version").collect()] == [1, 2]
    assert mart_path(spark, root, "m") != mart_path(spark, root, "m", 1)


def test_scratch_on_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    def session(master, named):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: named or default),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    assert scratch_root(session("spark://x:1", "/shared/")) == "/shared"
    for master in ("spark://x:1", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(session(master, None))


def test_bucketed_join_query_moves_no_row(spark, sf_dir):
    import __spark_entry__ as entrypoint

    frame = entrypoint.queries()["bucketed_fact_join"](spark, sf_dir)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):plan.index("== Initial Plan ==") if "== Initial Plan ==" in plan else len(plan)]
    assert "Exchange" not in join and "SelectedBucketsCount" in join
