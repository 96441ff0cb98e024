from __future__ import annotations

import numpy as np
import pytest

from subscope.llm import vector_graph as v


def brute(rows, cosine=0.95):
    unit = []
    for _, x in rows:
        a = None if x is None or not x or any(c is None for c in x) else np.array(x, float)
        if a is not None and (not np.isfinite(a).all() or not a.any()):
            a = None
        unit.append(None if a is None else a / np.abs(a).max() / np.linalg.norm(a / np.abs(a).max()))
    n = len(rows)
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
              and unit[i] @ unit[j] >= cosine] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        new = [min([label[i], *(label[j] for j in links[i])]) for i in range(n)]
        if new == label:
            break
        label = new
    ids = [i for i, _ in rows]
    least = {c: min((ids[i] for i in range(n) if label[i] == c and ids[i] is not None), default=None) for c in set(label)}
    return sorted(((ids[i], len(links[i]), least[label[i]]) for i in range(n)), key=str)


@pytest.fixture(scope="module")
def clusters():
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(30):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 25)):
            rows.append((centre + rng.normal(size=16) * rng.choice((0.0, 0.05, 0.2))).tolist())
    rows += rng.normal(size=(200, 16)).tolist()
    order = rng.permutation(len(rows))
    return [(int(i), rows[j]) for i, j in enumerate(order)]


def check(spark, rows, least_recall=0.97):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = v.near_duplicates(frame).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    found, true = sum(r.n_links for r in got), sum(n for _, n, _ in want)
    assert found <= true and found >= least_recall * true
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str), want


def test_clusters(spark, clusters):
    got, want = check(spark, clusters)
    assert got == want


def test_many_small_shards(spark, clusters, monkeypatch):
    monkeypatch.setattr(v, "SHARD_SIZE", 40)
    monkeypatch.setattr(v, "SHARD_MOST", 60)
    monkeypatch.setattr(v, "MOST_OVERLAP", 3)
    check(spark, clusters)


def test_odd_vectors(spark):
    x, y = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [float("nan"), 1.0, 1.0]), (5, [float("inf"), 1.0, 1.0]), (6, [1.0, None, 1.0]),
            (7, x), (8, x), (8, x), (9, [2.0, 4.0, 6.0]), (None, x), (10, y), (11, [1.0, 2.0]), (12, [1e200, 2e200, 3e200])]
    got, want = check(spark, rows, 1.0)
    assert got == want
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, n_links int, node string")
    assert v.near_duplicates(empty).count() == 0


def test_pruned_lists_reach_every_row():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(1, 8)) + rng.normal(size=(60, 8)) * 0.01 for _ in range(6)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    lists = [np.array(sorted(s)) for s in v.shard_graph(x)]
    start = v.medoid(x)
    for i in range(0, len(x), 7):
        got = set(v.range_search(x, lists, start, x[i], 0.95).tolist())
        assert got == set(np.flatnonzero(x @ x[i] >= 0.95).tolist())


def test_large_shard_is_dealt_on_by_nearness(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(300, 16))
    rows = [(int(i), (base[i // 4] + rng.normal(size=16) * 0.03).tolist()) for i in rng.permutation(1200)]
    monkeypatch.setattr(v, "SHARD_MOST", 60)
    monkeypatch.setattr(v, "PART_SIZE", 30)
    monkeypatch.setattr(v, "all_links", None)  # the graph itself must reach the recall
    monkeypatch.setattr(v, "STEP_CENTRES", 1)
    monkeypatch.setattr(v, "SHARD_SIZE", 10_000)  # one shard of all
    check(spark, rows)


def test_parts_that_nearness_does_not_cut_and_exact_comparison(spark, clusters, monkeypatch):
    monkeypatch.setattr(v, "SHARD_MOST", 60)
    monkeypatch.setattr(v, "PART_SIZE", 30)
    monkeypatch.setattr(v, "SHARD_SIZE", 10_000)
    monkeypatch.setattr(v, "UNCUT", 0.0)
    got, want = check(spark, clusters)
    monkeypatch.setattr(v, "RECALL", 2.0)
    monkeypatch.setattr(v, "CHUNK", 100)
    got, want = check(spark, clusters, 1.0)
    assert got == want


def test_audit_asks_nodes_without_found_links(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 16))
    rows = [(i, (base[i // 2] + rng.normal(size=16) * 0.01).tolist()) for i in range(300)]
    units = v.unit_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    nodes = units.select(v.F.col("id").alias("node"), "unit")
    half = spark.createDataFrame([(i, i + 1) for i in range(0, 150, 2)], "a long, b long")
    assert 0.3 < v.audit(nodes, half, 0.95, 300) < 0.7
