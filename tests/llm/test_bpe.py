"""Ids and texts against the tokenizers library itself, for both encoders and the token files."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from subscope.llm import bpe, token_files  # noqa: E402


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_tokenizer())


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_round_trip_is_the_librarys(spark, odd, library, sf_dir):
    for docs in (odd, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        want = set()
        for r in docs.select("doc_id", "text").collect():
            ids = ids_of(library, r.text)
            back = library.decode(ids.tolist(), skip_special_tokens=False)
            want.add((r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
        got = bpe.round_trip(docs)
        assert set(map(tuple, got.collect())) == want and got.count() == docs.count()
    assert bpe.round_trip(odd.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab's tlré ü\u00a0\u2003\n0\u01321!<|endoftext|>字"), max_size=200), st.integers(1, 7))
def test_any_cuts_are_repaired(text, step):
    coder = bpe.Coder.at(bpe.default_tokenizer())
    raw = text.encode()
    safe = [i for i in range(step, len(raw), step) if (raw[i] & 0xC0) != 0x80]
    ids, back = coder.whole(raw, safe)
    assert np.frombuffer(ids, "<u4").tolist() == coder.library.encode(text, add_special_tokens=False).ids
    assert back == raw
    memory = token_files.WordMemory.at(bpe.default_tokenizer())
    assert memory.encode(text) == ids


def test_shared_chunks_are_encoded_once(library):
    import pyarrow as pa
    rng = np.random.default_rng(0)
    shared = " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(2000))
    coder = bpe.Coder(bpe.default_tokenizer())
    first = len(list(bpe.encode_texts(coder, pa.array([shared]))))
    stored = len(coder.store)
    list(bpe.encode_texts(coder, pa.array(["other start " + shared])))
    assert first == 1 and stored > 5 and len(coder.store) <= stored + 3


def test_blocks_give_back_their_ids():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 1023, 1024, 1025, 9000):
        for high in (1, 2, 400, 1 << 17):
            ids = rng.integers(0, high, n)
            assert (token_files.decode_blocks(token_files.encode_blocks(ids)) == ids).all()
    repeated = np.tile(rng.integers(0, 50_000, 60), 200)
    assert len(token_files.encode_blocks(repeated)) < 0.5 * 2 * len(repeated)
    with pytest.raises(ValueError):
        token_files.encode_blocks(np.array([1 << 17]))


def test_damage_is_noticed():
    payload = bytearray(token_files.encode_blocks(np.arange(3000) % 700))
    payload[len(payload) // 2] ^= 1
    with pytest.raises(ValueError):
        token_files.decode_blocks(bytes(payload))


def test_token_files(spark, odd, library, monkeypatch):
    rows = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want, start = [], 0
    for r in rows:
        ids = np.append(ids_of(library, r.text), 0).astype("<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for partitions in (1, 4):
        got = token_files.files_round_trip(odd, partitions=partitions).collect()
        assert sorted(map(tuple, got), key=lambda t: t[1]) == want
    assert token_files.files_round_trip(odd.limit(0)).count() == 0


def test_words_met_once_take_no_call_of_the_library(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(rng.choice(list("abcdefgh12"), 9)) for _ in range(300)) for _ in range(20)]
    want = [bpe.Coder.at(bpe.default_tokenizer()).library.encode(t, add_special_tokens=False).ids for t in texts]
    memory = token_files.WordMemory(bpe.default_tokenizer())

    def no_library(*_, **__):
        raise AssertionError("the library was asked")

    library = type("Library", (), {"encode": no_library, "encode_batch": no_library})()
    monkeypatch.setattr(memory.coder, "library", library)
    assert [np.frombuffer(memory.encode(t), "<u4").tolist() for t in texts] == want


def test_blocks_are_as_they_were():
    """The files of earlier versions stay readable: the same ids give the same bytes."""
    rng = np.random.default_rng(7)
    ids = np.concatenate([rng.integers(0, 1 << 17, 1500), np.tile(rng.integers(0, 900, 50), 60), np.zeros(2100, np.int64)])
    payload = token_files.encode_blocks(ids)
    assert (len(payload), zlib.crc32(payload)) == (3792, 3691889738)
    assert (token_files.decode_blocks(payload) == ids).all()


def test_blocks_side_by_side_are_the_blocks_alone():
    """Lanes share every array, the last one idles on after its end, and few of them go round twice."""
    rng = np.random.default_rng(11)
    n = 40 * 1024 + 77
    skewed = np.where(rng.random(n) < 0.02, rng.integers(0, 1 << 17, n), rng.zipf(1.4, n) % 3000)
    alone = [token_files.encode_blocks(skewed[i : i + 1024]) for i in range(0, len(skewed), 1024)]
    assert token_files.encode_blocks(skewed) == b"".join(alone)
    assert (token_files.decode_blocks(b"".join(alone)) == skewed).all()


def test_a_task_codes_its_blocks_at_once_and_keeps_the_ids(spark, library, tmp_path):
    """More lanes a call take less time an id; the query needs no ids outside of its tasks."""
    text = " ".join("abcdefgh"[i % 8] for i in range(280_000))
    docs = spark.createDataFrame([(i, text) for i in range(8)], "doc_id long, text string")
    folder = str(tmp_path / "tokens")
    token_files.write_token_files(docs, folder, partitions=1)
    segments = spark.read.parquet(folder)
    ids = np.append(ids_of(library, text), 0).astype("<u4")
    assert [r.ids for r in segments.select("ids").collect()] == [8 * len(ids)] and 8 * len(ids) > 1 << 21
    back = token_files.read_token_files(spark, folder, with_ids=False)
    assert back.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    crc = zlib.crc32(ids.tobytes())
    assert sorted(map(tuple, back.collect())) == [(i, i * len(ids), len(ids), crc) for i in range(8)]
    with_ids = token_files.read_token_files(spark, folder).where("doc_id = 7").collect()
    assert [bytes(r.ids) for r in with_ids] == [ids.tobytes()]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab's tlRé\u00a0\x85\n\t\r\x0b\x0c\x1c\x1f 01!.<|endoftext|>"), max_size=40))
def test_lone_white_space_needs_no_look_ahead(text):
    memory = token_files.WordMemory.at(bpe.default_tokenizer())
    want = memory.coder.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(memory.encode(text), "<u4").tolist() == want


def test_plain_texts_take_the_pattern_without_look_ahead(monkeypatch):
    memory = token_files.WordMemory(bpe.default_tokenizer())
    text = "It's 12 plain\nlines, façades and all!\n"
    want = memory.coder.library.encode(text, add_special_tokens=False).ids

    def slower(_):
        raise AssertionError("the look-ahead was used")

    monkeypatch.setattr(memory.coder, "fast", slower)
    assert np.frombuffer(memory.encode(text), "<u4").tolist() == want
    for run in ("  ", "\n\n", " \n", "\n ", "\t", "\r\n"):
        with pytest.raises(AssertionError):
            memory.encode("a" + run + "b")
