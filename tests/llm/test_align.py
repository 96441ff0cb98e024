"""Groups, links and counts against both libraries on whole texts."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("public_tokenizers")

import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from subscope.llm import align, bpe  # noqa: E402


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(bpe.default_tokenizer())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=align.piece_tokenizer())


def whole(libraries, text):
    """(A ids, B ids, groups, links) of a text, from its definition; None without tokens."""
    if not text:
        return None
    a, b = libraries
    back = bpe.byte_alphabet()
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_x = [bytes(back[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in x]
    pieces = [b.id_to_piece(i) for i in y]
    bytes_y = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(y, pieces, strict=True)]
    if not b"".join(bytes_x) == b"".join(bytes_y) == (" " + text).encode():
        return None
    spans = []
    for parts in (bytes_x, bytes_y):
        at, own = 0, []
        for p in parts:
            own.append((at, at + len(p)))
            at += len(p)
        spans.append(own)
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, low = [], 0
    for cut in cuts:
        groups.append(tuple(tuple(i for i, (s, e) in zip(ids, own, strict=True) if low <= s and e <= cut) for ids, own in zip((x, y), spans, strict=True)))
        low = cut
    links = [(i, j) for i, (s, e) in zip(x, spans[0], strict=True) for j, (u, w) in zip(y, spans[1], strict=True) if s < w and u < e] if len(x) < 3000 else None
    return x, y, groups, links


def plain(libraries, rows):
    each = [(i, whole(libraries, t)) for i, t in rows]
    count = Counter(link for _, w in each if w for link in w[3])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for i, w in each:
        if not w:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in w[2])
        out.append((i, len(w[0]), len(w[1]), len(w[2]), len(w[3]), sum(count[x] == best[x[1]] for x in w[3]),
                    sum(count[x] for x in w[3]), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_texts_against_the_libraries(spark, odd, libraries, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 4000").select("doc_id", "text")
    for frame in (docs, odd.where("doc_id <> 10 or doc_id is null").selectExpr("*", "1 as code", "2 as missing", "3 as `row`")):
        want = plain(libraries, [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()])
        assert sorted(map(tuple, align.alignment(frame).collect()), key=str) == want
        # rare pairs that are not sent to the tasks are joined
        assert sorted(map(tuple, align.alignment(frame, listed=40).collect()), key=str) == want
    assert align.alignment(odd.limit(0)).count() == 0


def test_the_pair_table_is_the_count_of_all_links(spark, libraries, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 500")
    want = Counter(link for r in docs.collect() if (w := whole(libraries, r.text)) for link in w[3])
    got = {(r.a_id, r.b_id): r.n for r in align.pair_table(docs).collect()}
    assert got == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab's tlré ü    \n0Ĳ1!<|endoftext|>字▁\x1c\t"), max_size=120), st.integers(4, 400))
def test_units_are_the_tokens_of_the_whole_text(libraries, text, run):
    v = align.Vocabularies.at(bpe.default_tokenizer(), align.piece_tokenizer())
    assert v.units
    usual, align.RUN = align.RUN, run
    try:
        rows = list(align.aligned_rows(v, align.Tokens(v), [text, None, "a b", text]))
    finally:
        align.RUN = usual
    want = whole(libraries, text)
    assert [r.good for r in rows] == [want is not None, False, True, want is not None]
    for row in (rows[0], rows[3]):
        if want:
            assert row.numbers.tolist() == [len(want[0]), len(want[1]), len(want[2]), len(want[3])]
            joined = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want[2])
            assert row.digest.hexdigest() == hashlib.sha256(joined.encode()).hexdigest()


def test_a_very_long_text_is_cut_into_runs(monkeypatch):
    text = "some words of a long text, again and again. " * 200
    v = align.Vocabularies.at(bpe.default_tokenizer(), align.piece_tokenizer())
    want = next(align.aligned_rows(v, align.Tokens(v), [text])).digest.hexdigest()
    monkeypatch.setattr(align, "RUN", 50)
    monkeypatch.setattr(align, "KEPT", 100)
    got = next(align.aligned_rows(v, align.Tokens(v), [text]))
    assert len(got.same) > 100 and got.digest.hexdigest() == want


def test_the_identity_map_pairs_equal_bytes():
    v = align.Vocabularies.at(bpe.default_tokenizer(), align.piece_tokenizer())
    some = [i for i in range(len(v.same)) if v.same[i] >= 0]
    assert len(some) > 10_000 and all(v.bytes_a[i] == v.bytes_b[v.same[i]] for i in some)
