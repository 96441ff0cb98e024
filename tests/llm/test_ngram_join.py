from __future__ import annotations

import os
import random
import re

import numpy as np
import pytest

from subscope.llm import ngram_join as nj


def sets_of(rows):
    out = {}
    for doc, text in rows:
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
        w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
        out.setdefault(doc, []).append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    return out


def brute(rows):
    flat = [(doc, s) for doc, many in sets_of(rows).items() for s in many]
    parent = list(range(len(flat)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(flat):
        for j, (_, b) in enumerate(flat[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (doc, _) in enumerate(flat):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, len(s), least.get(find(i), doc)) for i, (doc, s) in enumerate(flat)), key=str)


def got(frame):
    return sorted(map(tuple, nj.similarity_components(frame).collect()), key=str)


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeiourst") for _ in range(3))
    bases = [[word() for _ in range(rng.choice((6, 30, 120)))] for _ in range(12)]
    rows = []
    for i in range(160):
        text = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 2, 4, 9))):
            at = rng.randrange(len(text))
            text[at : at + rng.choice((0, 1))] = [word()]
        rows.append((i, " ".join(text)))
    rows += [(500 + i, " ".join(word() for _ in range(rng.randint(0, 9)))) for i in range(40)]
    return rows


def test_matches_brute_force(spark, near_copies):
    frame = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(5)
    assert got(frame) == brute(near_copies)


def test_order_of_frequent_shingles_changes_nothing(spark, near_copies, monkeypatch):
    monkeypatch.setattr(nj, "FREQUENT_LOCAL", 2)
    frame = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(3)
    assert got(frame) == brute(near_copies)


def test_blockwise_product():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64) * np.uint64(1 << 58)) for _ in range(2))
        true = len(np.intersect1d(a, b))
        least = int(rng.integers(1, 30))
        assert nj.multiply(a, b, least) == (true if true >= least else -1)


def test_odd_tables(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd) == brute(rows)
    assert nj.similarity_components(odd.limit(0)).count() == 0
    kept = nj.one_of_each_group(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 8, 10, 11]


def test_one_row_of_each_group_with_null_ids_and_repeated_rows(spark, odd):
    kept = nj.one_of_each_group(odd)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 6, 7, 8, 10, 11, None], key=str)
    rows = [
        (None, "a clean text without an id that stands alone", 0), (None, "copies that all have no id at all", 1),
        (None, "copies that all have no id at all", 1), (5, "one row that comes twice in the table", 2),
        (5, "one row that comes twice in the table", 2), (7, "a copy with an id and one without", 3),
        (None, "a copy with an id and one without", 3), (5, "another text under an id used before", 4), (None, None, 5), (None, None, 6),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row_key int").repartition(4)
    got = nj.one_of_each_group(frame)
    assert got.columns == frame.columns
    assert sorted((r.row_key, r.doc_id) for r in got.collect()) == [(0, None), (1, None), (2, 5), (3, 7), (4, 5), (5, None), (6, None)]


def thue_morse(n: int) -> str:
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_words_that_a_polynomial_would_confuse_are_not_linked(spark):
    one = thue_morse(1024)
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, other), (3, f"{one} b c d e f"), (4, f"{other} b c d e f"), (5, one)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(i, c) for i, _, c in got(frame)] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 1)]


def test_pairs_of_a_large_group_grow_with_the_group(spark, monkeypatch):
    """2,000 near copies of one text: the pairs that are multiplied are a small multiple of the group."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(2000):
        text = list(base)
        for _ in range(rng.choice((1, 1, 2))):
            text[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    tried = []
    usual = nj.within_bounds
    monkeypatch.setattr(nj, "within_bounds", lambda pairs, *a: (tried.append(pairs.count()), usual(pairs, *a))[1])
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert {c for _, _, c in got(frame)} == {0}
    assert sum(tried) < 30 * len(rows), tried


def test_clashing_columns_keep_their_values(spark, near_copies):
    names = ["k", "fp", "h", "a", "b", "id", "set_fp", "least_id", "row_place", "maybe_grouped"]
    frame = spark.createDataFrame(near_copies, "doc_id long, text string").selectExpr("*", *(f"doc_id + {i} as `{c}`" for i, c in enumerate(names)))
    kept = nj.one_of_each_group(frame).collect()
    assert all(tuple(r)[2:] == tuple(r.doc_id + i for i in range(len(names))) for r in kept)
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in brute(near_copies)})


def test_parities_bound_the_difference():
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in (0, 1, 7, 300, 310, 1500, 2900)]
    sets.append(sets[3])
    row = np.concatenate([np.full(len(s), i) for i, s in enumerate(sets)])
    bits = nj.parities(row, np.concatenate(sets), len(sets)).to_pylist()
    for a, x in zip(sets, bits, strict=True):
        for b, y in zip(sets, bits, strict=True):
            differ = sum(((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(x, y, strict=True))
            assert differ <= len(np.setxor1d(a, b)) and (differ == 0 or not np.array_equal(a, b))


def test_group_that_is_not_near_enough(spark, monkeypatch):
    """Texts that share a long passage and differ in a quarter of their shingles: all pairs meet, few go on."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiourst") for _ in range(4))
    passage = [word() for _ in range(90)]
    rows = [(i, " ".join(passage + [word() for _ in range(30 if i % 10 else 4)])) for i in range(120)]
    tried = []
    bound = nj.within_bounds
    monkeypatch.setattr(nj, "within_bounds", lambda pairs, *more: tried.append(pairs.count()) or bound(pairs, *more))
    monkeypatch.setattr(nj, "CHOSEN", ())
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert sum(tried) < 10 * len(rows) < len(rows) ** 2 / 4


def test_only_texts_in_pairs_are_shingled_again(spark, monkeypatch, tmp_path):
    """Of texts that share nothing with another no rows are made for the product; one text of a set is enough."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeiourst") for _ in range(6))
    rows = [(i, " ".join(word() for _ in range(40))) for i in range(300)]
    rows += [(300, rows[7][1] + " end"), (301, rows[7][1].upper()), (302, rows[7][1].replace(" ", "\t")), (303, rows[9][1] + " fin")]
    usual, folder = nj.shingle_rows, str(tmp_path)

    def counted(column, k):
        with open(f"{folder}/{os.getpid()}", "a") as file:
            file.write(f"{len(column)}\n")
        yield from usual(column, k)

    monkeypatch.setattr(nj, "shingle_rows", counted)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    shingled = sum(int(line) for path in tmp_path.iterdir() for line in path.read_text().split())
    assert 2 * len(rows) < shingled < 2 * len(rows) + 20, shingled
