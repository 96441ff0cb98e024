from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from subscope.llm import decontaminate as d


def say(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_planted_passages_and_nothing_else(spark):
    rng = random.Random(4)
    items = [(i, say(rng, rng.randint(14, 60))) for i in range(30)] + [(90, say(rng, 5)), (91, None), (92, "")]
    items.append((93, items[0][1].upper() + "!"))
    docs, want = [], {}
    for i in range(200):
        text = say(rng, rng.randint(0, 150))
        want[i] = []
        if i % 4 == 0:
            item = i // 4 % 30
            words = items[item][1].split(" ")
            if i % 8 == 0:  # one word in ten is another one
                for j in range(4, len(words), 10):
                    words[j] = "other"
            text += " (" + " ".join(words).capitalize() + "). " + say(rng, 20)
            want[i] = [item]
        docs.append((i, text, "x"))
    frame = spark.createDataFrame(docs, "doc_id long, text string, item string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r["items"]) for r in d.contamination(frame, bench).collect()}
    assert got == {i: (bool(x), x) for i, x in want.items()}
    clean = d.clean_documents(frame, bench)
    assert clean.columns == frame.columns and {r.doc_id for r in clean.collect()} == {i for i, x in want.items() if not x}


def brute_overlap(doc, item, shift):
    best, need = 0, min(d.MIN_OVERLAP, len(item))
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    for a in range(low, high):
        for b in range(a + need, high + 1):
            same = sum(doc[i + shift] == item[i] for i in range(a, b))
            if same >= d.MIN_SHARE * (b - a) - 1e-9:
                best = max(best, same)
    return best


def test_overlap_is_the_best_stretch():
    rng = np.random.default_rng(0)
    for _ in range(300):
        doc, item = rng.integers(0, 3, rng.integers(0, 50)), rng.integers(0, 2, rng.integers(6, 30))
        shift = int(rng.integers(-20, 30))
        got, want = d.overlap(doc, item, shift), brute_overlap(doc, item, shift)
        assert got == want


def changes(n):
    """Most words of a stretch of n that may differ."""
    return int(n * (1 - d.MIN_SHARE) + 1e-9)


def test_masks_hit_whatever_overlap_accepts():
    for n in range(d.MIN_WORDS, 2 * d.MIN_OVERLAP):
        masks = d.MASKS[d.mask_set(n)][1]
        placed = [sum(1 << s + i for i in d.seed_offsets(m)) for m in masks for s in range(n - len(m) + 1)]
        for k in range(changes(n) + 1):
            bad = np.array([sum(1 << i for i in c) for c in combinations(range(n), k)])
            assert np.any([bad & p == 0 for p in placed], axis=0).all(), n


def test_every_pattern_of_changed_words_is_found(spark):
    rng = random.Random(9)
    items = [(n, say(rng, n)) for n in range(6, 16)]
    docs, want = [], {}
    for n, text in items:
        for k in range(changes(n) + 2):
            for c in combinations(range(n), k):
                if k > changes(n) and rng.random() > 0.05:
                    continue
                words = text.split(" ")
                for i in c:
                    words[i] = "other"
                want[len(docs)] = n if k <= changes(n) else None
                docs.append((len(docs), "before it " + " ".join(words) + " and after"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r["items"] for r in d.contamination(frame, bench).collect()}
    loose = {i for i, n in want.items() if n is None}  # too many changes for the whole item; a part of 13 words may do
    assert {i: got[i] for i in want if i not in loose} == {i: [n] for i, n in want.items() if n is not None}
    for i in loose:
        words, found = docs[i][1].split(" "), got[i]
        for n, text in items:
            near = any(brute_overlap(words, text.split(" "), s) for s in range(len(words)))
            assert (n in found) == near


def test_operator_equals_brute_force(spark):
    """Few different words, so that stretches agree by chance, at any length and place."""
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))) for i in range(25)]
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    first = {t: i for i, t in reversed(items)}
    want = {}
    for i, text in docs:
        for item, other in items:
            a, b = text.split(), other.split()
            if len(b) >= d.MIN_WORDS and first[other] == item:
                a, b = np.array(a), np.array(b)
                n = max((d.overlap(a, b, s) for s in range(-len(b), len(a))), default=0)
                if n:
                    want[i, item] = n
    got = {(r.doc_id, r.item): r.n_words for r in d.find_overlaps(frame, bench).collect()}
    assert got == want and len(want) > 20


def test_odd_tables(spark, odd):
    bench = spark.createDataFrame(
        [(1, "the same text again and again in this line the same text"), (None, "long " * 20), (3, None)],
        "item_id long, text string")
    got = d.contamination(odd, bench).collect()
    assert len(got) == odd.count()
    assert {r.doc_id for r in got if r.contaminated} == {8, 9, 10}
    assert not any(r.contaminated for r in d.contamination(odd, bench.limit(0)).collect())
    assert d.contamination(odd.limit(0), bench).count() == 0
