"""Targets, rates and copies against plain Python."""

from __future__ import annotations

import math
import re
from collections import defaultdict

import pytest

from subscope.llm import entropy_mix


def plain_targets(totals: dict, weights=(5, 2, 1), most=3) -> dict:
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(totals.values())), set(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * totals[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = float(most * totals[s])
            left -= target[s]
        open_ -= above
    return target


def plain_rates(sizes: list[int], target: float, most=3) -> list[float]:
    """Rates of the dual by bisection."""
    mean = sum(sizes) / len(sizes)
    rate = lambda u: [min(most, math.exp(min(u * z / mean, 50))) for z in sizes]
    low, high = -1e6, 1e6
    for _ in range(200):
        u = (low + high) / 2
        low, high = (u, high) if sum(r * z for r, z in zip(rate(u), sizes, strict=True)) < target else (low, u)
    return rate(high)


def size(text) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(docs, got, near):
    rows = docs.select("doc_id", "text", "source").collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(size(r.text))
    target = plain_targets({s: sum(z) for s, z in by.items()})
    out = got.collect()
    assert sorted((str(r.doc_id), r["size"]) for r in out) == sorted((str(r.doc_id), size(r.text)) for r in rows)
    taken = defaultdict(list)
    for r in out:
        taken[r["group"]].append(r)
        assert r.source_size == sum(by[r["group"]]) and r.target == pytest.approx(target[r["group"]], rel=1e-9)
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"] <= 3 * r["size"]
    for s, its in taken.items():
        assert abs(sum(r.taken for r in its) - target[s]) <= near(by[s], target[s])
        want = defaultdict(set)
        if sum(by[s]):
            for z, rate in zip(by[s], plain_rates(by[s], target[s]), strict=True):
                want[z].add(round(rate, 6))
            for r in its:
                if r["size"] and target[s] < 3 * sum(by[s]):
                    assert r.rate == pytest.approx(want[r["size"]].pop() if len(want[r["size"]]) > 1 else next(iter(want[r["size"]])), abs=2e-5)


def test_given_documents_come_near_their_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs, entropy_mix.balance(docs), lambda z, t: max(z) / 2 + 1)


def test_many_small_documents_meet_their_targets(spark, monkeypatch):
    monkeypatch.setattr(entropy_mix, "CELL", 50)  # one size holds a third of the rows: its cell is dealt by hash
    rows = [(i, "w " * (7 if i % 3 == 0 else 1 + i * i % 90), ("hot" if i % 3 else None) if i % 5 else f"s{i % 4}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = entropy_mix.balance(docs)
    check(docs, got, lambda z, t: 4)
    again = entropy_mix.balance(docs.repartition(13))
    assert sorted(map(str, got.drop("rate").collect())) == sorted(map(str, again.drop("rate").collect()))


def test_odd_rows(spark, odd):
    got = entropy_mix.balance(odd)
    check(odd, got, lambda z, t: max(z))
    assert entropy_mix.balance(odd.limit(0)).count() == 0
    nothing = odd.where("text is null or text = ''")
    assert {(r.taken, r.target) for r in entropy_mix.balance(nothing).collect()} == {(0, 0.0)}


def test_the_mix_holds_every_copy(spark, odd):
    taken = sum(r.taken for r in entropy_mix.balance(odd).collect())
    mixed = entropy_mix.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert sum(size(r.text) for r in mixed.select("text").collect()) == taken


def test_a_code_point_order_that_utf16_would_break(spark):
    rows = [(i, "a b c d", s) for i, s in enumerate(["￿", "\U0001f600", "a", None, ""])]
    got = {r["group"]: r.target for r in entropy_mix.balance(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == pytest.approx(plain_targets({s: 4 for _, _, s in rows}))
