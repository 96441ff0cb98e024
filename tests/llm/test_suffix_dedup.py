"""Repeated byte windows against a set of all windows, and suffix order against sorting."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from subscope.llm import lyndon
from subscope.llm import suffix_dedup as sd
from subscope.llm.lyndon import suffix_arrays


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=40), min_size=1, max_size=5))
def test_suffix_arrays_are_sorted(texts):
    texts = [[*t, 0] for t in texts]
    bounds = np.cumsum([0] + [len(t) for t in texts])
    letters = np.concatenate([np.array(t) for t in texts])
    got = suffix_arrays(letters, bounds)
    for few in (0, 2):  # side by side to the end, and one by one from two texts on
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(lyndon, "FEW", few)
            assert suffix_arrays(letters, bounds).tolist() == got.tolist()
    for i, text in enumerate(texts):
        want = sorted(range(len(text)), key=lambda j: text[j:])
        assert (got[bounds[i] : bounds[i + 1]] - bounds[i]).tolist() == want


def brute(docs, length=100):
    """Same result from the set of earlier windows."""
    seen, out = {}, {}
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    for doc, text in order:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            at = seen.setdefault(raw[p : p + length], (doc, p))
            if at != (doc, p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, docs, monkeypatch=None):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.remove_repeats(frame).collect()}
    assert got == brute(docs)


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("the", "of", "ann", "tio", "re") for b in ("s", "ed", "", "ing")]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = say(60), say(200)
    docs = [(i, say(rng.randint(0, 120))) for i in range(40)]
    docs += [(100 + i, say(10) + passage + say(10)) for i in range(20)]
    docs += [(200 + i, base) for i in range(8)]
    for i in range(12):
        near = base.split(" ")
        near[rng.randrange(len(near))] = "changed"
        docs.append((300 + i, " ".join(near)))
    docs += [(400, "ab" * 400), (401, "a" * 300), (402, None), (403, ""), (404, "é" * 120 + "x"), (None, passage)]
    return docs


def test_matches_brute_force(spark, documents):
    check(spark, documents)


def test_frequent_anchors_and_long_texts_take_other_paths(spark, documents, monkeypatch):
    monkeypatch.setattr(sd, "FREQUENT", 5)
    monkeypatch.setattr(sd, "SEGMENT", 300)
    check(spark, documents)


def test_odd_documents(spark, odd):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    got = sd.remove_repeats(odd).collect()
    want = brute([d for i, d in enumerate(docs) if d not in docs[:i]])
    assert len(got) == len(docs)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert sd.remove_repeats(odd.limit(0)).count() == 0
