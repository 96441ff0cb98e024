from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np

from subscope.llm import quality as q
from subscope.llm.common import Scratch


def reference(texts, order):
    """Interpolated modified Kneser-Ney probabilities computed with dictionaries."""
    counts = {order: Counter()}
    for t in texts:
        raw = b"\0" * (order - 1) + t.encode()
        for i in range(len(t.encode())):
            counts[order][raw[i : i + order]] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    model = {}
    for k in range(1, order + 1):
        n = Counter(counts[k].values())
        cut = q.discounts(n[1], n[2], n[3], n[4])
        total, freed = Counter(), defaultdict(float)
        for g, c in counts[k].items():
            total[g[:-1]] += c
            freed[g[:-1]] += cut[min(c, 3) - 1]
        model[k] = (counts[k], cut, total, freed)

    def p(context, byte, k):
        if k == 0:
            return 1 / 256
        seen, cut, total, freed = model[k]
        h = context[len(context) - k + 1 :] if k > 1 else b""
        lower = p(context, byte, k - 1)
        if h not in total:
            return lower
        c = seen.get(h + bytes([byte]), 0)
        own = (c - cut[min(c, 3) - 1]) / total[h] if c else 0.0
        return own + freed[h] / total[h] * lower

    return p


def test_probabilities_match_the_definition(spark):
    rng = random.Random(2)
    train = ["".join(rng.choice("abc de") for _ in range(80)) for _ in range(30)]
    test = ["abc de", "zzz", "a", "", "é ü abcd", "bad cab dec"]
    frame = spark.createDataFrame([(t,) for t in train], "text string")
    scratch = Scratch(spark)
    model = q.smooth(scratch.keep(q.count_grams(frame)), scratch)
    p = reference(train, q.ORDER)
    want = {}
    for i, t in enumerate(test):
        raw = b"\0" * (q.ORDER - 1) + t.encode()
        want[i] = sum(math.log(p(raw[j : j + q.ORDER - 1], raw[j + q.ORDER - 1], q.ORDER)) for j in range(len(t.encode())))
    docs = spark.createDataFrame(list(enumerate(test)), "id long, text string")
    for limit in (q.SHARD_ROWS, 20):  # one shard, many shards
        got = q.log_likelihoods(docs, model, "id", "text", [], limit).collect()
        assert {r.id: r.n_bytes for r in got} == {i: len(t.encode()) for i, t in enumerate(test)}
        for r in got:
            assert math.isclose(r.log_p, want[r.id], rel_tol=1e-5, abs_tol=1e-5)
    total = sum(p(b"\0\0bc", b, q.ORDER) for b in range(256))
    assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_grams_stay_in_their_text():
    data = np.frombuffer(b"abxy", np.uint8)
    got = q.byte_grams(data, np.array([0, 2, 2, 4]), 3).tolist()
    assert got == [ord("a"), ord("a") << 8 | ord("b"), ord("x"), ord("x") << 8 | ord("y")]


def test_labelled_documents_are_told_apart(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in q.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    good = [got[r.doc_id].kept for r in labels.collect() if r.quality == 1]
    poor = [got[r.doc_id].kept for r in labels.collect() if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(poor) <= 0.5 * len(poor)


def test_odd_tables(spark, odd, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for some in (labels, labels.limit(0), spark.createDataFrame([(8, 1, 0), (8, None, 0), (None, 1, 0)], labels.schema)):
        got = q.classify(odd, some).collect()
        assert {r.doc_id for r in got} == {r.doc_id for r in odd.collect()}
        assert not any(r.kept for r in got if r.n_bytes == 0)
    assert q.classify(odd.limit(0), labels).count() == 0
    kept = q.accepted_documents(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == odd.where("length(text) > 0").count()


def test_a_rare_language_is_judged_by_its_own_cut(spark):
    rng = random.Random(7)
    say = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(i, say("ab ", 300), "big") for i in range(300)]
    rare = "klmnopqrstuvwxyzäöü KLMNOPQRSTUVWXYZ"
    rows += [(1000 + i, say(rare, 300), "rare") for i in range(60)] + [(2000 + i, say(rare, 300), "unknown") for i in range(5)]
    labels = [(i, 1, 0) for i in range(240)] + [(1000 + i, 1, 0) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = q.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    cut = {r.lang: r.cut for r in got}
    assert cut["rare"] > cut["big"] + 1 and cut["unknown"] is None
    assert all(r.kept for r in got if r.lang == "unknown")
    clean = [r.kept for r in got if r.lang == "rare" and r.doc_id >= 1024]
    assert sum(clean) >= 0.8 * len(clean)
