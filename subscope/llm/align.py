"""Alignment of two tokenizers' ids over the same bytes, with an identity-map fast path.

A space after a character that is no white space begins a new token in both tokenizers (A's pre-tokenizer
starts a piece there; B has no piece with a space inside, which is checked when it is loaded). Texts are cut there
into *units*; a unit has the same tokens wherever it stands, so a task encodes each distinct one once.
A tokenizer without these properties gets its texts whole.

1. *Groups and links.* Ends of A's and B's tokens are marked on the bytes of about ``RUN`` characters at once: common marks
   end the groups, and every stretch between two marks is one link. Ids of links are written beside the results.
2. *Identity map.* For every A id the B id of the same bytes. A group of one A and one B token of equal bytes is
   counted in a vector over A's vocabulary, addressed by the id; so is such a pair inside a larger group.
   Only the other links of irregular groups become (pair, n): summed in the task, then in a shuffle by pair.
3. *Sums.* The vector, the highest count of each B id, both bounded by the vocabularies, and the ``LISTED`` most
   frequent pairs go to all tasks, which sum over the links written before. Links of rarer pairs leave
   as (row, pair, n) and are joined with the pair table.

Defined cases: null and empty texts, and texts whose tokens do not spell the space and the text (U+2581 inside, or a
normalizer that rewrites) have zeros and an empty digest and count nowhere; repeated rows count again; null
ids are kept; an empty table gives an empty result; other columns are ignored. Very long texts are cut into runs
of units; one without a safe space is a run of its own.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.bpe import _PLAIN, Coder, byte_alphabet, default_tokenizer
from subscope.llm.common import Scratch, most_frequent

#: Pairs that go to all tasks, at most.
LISTED = 1 << 20
#: Bytes of units and ids a task keeps before it starts anew.
KEPT = 40 << 20
#: Characters of a run of units.
RUN = 1 << 18
#: Links a task holds before it counts them.
HELD = 3_000_000
_SPACE = "▁"
_UNSAFE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


class Flat:
    """Byte strings in one array."""

    def __init__(self, parts: list[bytes]):
        self.lengths = np.array([len(x) for x in parts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings of the ids one after another, and where each ends."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        return self.data[np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)], ends


class Vocabularies:
    """Both tokenizers, the bytes of their ids and the identity map."""

    _kept: dict[tuple[str, str], Vocabularies] = {}

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        stand_in = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(stand_in[c] for c in token) if all(c in stand_in for c in token) else token.encode()

        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.size_b = self.b.get_piece_size()
        tokens = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [
            bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace(_SPACE, " ").encode() for i, t in enumerate(tokens)]
        model = sentencepiece_model_pb2.ModelProto.FromString(self.b.serialized_model_proto())
        rules = model.normalizer_spec
        pre = spec.get("pre_tokenizer") or {}
        self.units = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
            and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
            and not any(_SPACE in t.lstrip(_SPACE) for t in tokens)
        )
        self.fast = Coder.at(path_a).fast if self.units else None
        self.lone = self.b.piece_to_id(_SPACE)
        usual = {x: i for i, x in reversed(list(enumerate(self.bytes_b))) if self.b.is_byte(i)}
        usual |= {x: i for i, x in reversed(list(enumerate(self.bytes_b))) if not self.b.is_byte(i) and not self.b.is_control(i)}
        self.same = np.array([usual.get(x, -1) for x in self.bytes_a], np.int64)
        self.flat_a, self.flat_b = Flat(self.bytes_a), Flat(self.bytes_b)
        self.digits = Flat([f";{i}".encode() for i in range(max(len(self.bytes_a), self.size_b))])
        self.wide = len(self.bytes_a) * self.size_b >= 1 << 32

    @classmethod
    def at(cls, path_a: str, path_b: str) -> Vocabularies:
        key = (path_a, path_b)
        if key not in cls._kept:
            cls._kept[key] = cls(*key)
        return cls._kept[key]

    def of_a(self, unit: str) -> bytes:
        if self.fast and _PLAIN.fullmatch(unit):
            return np.array(self.fast(unit), "<u4").tobytes()
        return np.array(self.a.encode(unit, add_special_tokens=False).ids, "<u4").tobytes()

    def of_b(self, units: list[str]) -> Iterator[bytes]:
        for unit, ids in zip(units, self.b.encode([u[1:] for u in units], num_threads=1), strict=True):
            yield np.array(ids if len(unit) > 1 else [self.lone], "<u4").tobytes()


class Tokens:
    """The ids of runs of units, each distinct unit encoded once."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self.a: dict[str, bytes] = {}
        self.b: dict[str, bytes] = {}
        self.size = 0

    def of(self, units: list[str]) -> tuple[bytes, bytes]:
        try:
            return b"".join(map(self.a.__getitem__, units)), b"".join(map(self.b.__getitem__, units))
        except KeyError:
            if self.size > KEPT:
                self.a, self.b, self.size = {}, {}, 0
            new = [u for u in dict.fromkeys(units) if u not in self.a]
            self.a.update(zip(new, map(self.v.of_a, new), strict=True))
            self.b.update(zip(new, self.v.of_b(new), strict=True))
            self.size += sum(9 * len(u) + 250 for u in new)
            return b"".join(map(self.a.__getitem__, units)), b"".join(map(self.b.__getitem__, units))


def runs_of(text: str, units: bool) -> Iterator[list[str]]:
    """The units of a text after its space, run by run."""
    whole = " " + text
    if not units:
        yield [whole]
        return
    start = 0
    while start < len(whole):
        end = len(whole)
        if end - start > RUN and (cut := _CUT.search(whole, start + RUN)):
            end = cut.start()
        run = whole[start:end]
        if _UNSAFE.search(run):
            first, *rest = _CUT.split(run)
            yield [first, *(" " + w for w in rest)]
        else:
            yield [" " + w for w in run.split(" ")[1:]]
        start = end


class Aligned:
    """Some runs side by side: per run whether its tokens spell it, and their numbers, groups and links."""

    def __init__(self, v: Vocabularies, raws: list[bytes], a: list[bytes], b: list[bytes]):
        self.good = self.spelled(v, raws, a, b)
        some = np.flatnonzero(self.good).tolist()
        ids_a, ids_b = (np.frombuffer(b"".join(x[i] for i in some), "<u4").astype(np.int64) for x in (a, b))
        count_a, count_b = (np.array([len(x[i]) // 4 for i in some], np.int64) for x in (a, b))
        end_a, end_b = np.cumsum(v.flat_a.lengths[ids_a]), np.cumsum(v.flat_b.lengths[ids_b])
        stop = np.cumsum([len(raws[i]) for i in some], dtype=np.int64)
        size = int(stop[-1]) + 1 if len(some) else 1

        marks = np.zeros(size, np.uint8)  # bit 0: a token of A ends here; bit 1: one of B
        marks[end_a] = 1
        marks[end_b] |= 2
        at = np.flatnonzero(marks)
        kind = marks[at]
        of_a, of_b, both = kind & 1, kind >> 1, kind == 3
        link_a, link_b = (ids_a[np.cumsum(of_a, dtype=np.int64) - of_a], ids_b[np.cumsum(of_b, dtype=np.int64) - of_b])
        same = v.same[link_a] == link_b
        links = np.searchsorted(at, stop, side="right")
        sames = np.append(0, np.cumsum(same))[links]
        groups = np.append(0, np.cumsum(both))[links]
        self.numbers = np.zeros((len(raws), 4), np.int64)
        self.numbers[some] = np.stack([count_a, count_b, *(np.diff(x, prepend=0) for x in (groups, links))], axis=1).reshape(-1, 4)

        ended = np.cumsum(marks == 3)
        group_a, group_b = (ended[e] - (marks[e] == 3) for e in (end_a, end_b))
        total = int(ended[-1])
        before_a, before_b = (np.append(0, np.cumsum(np.bincount(g, minlength=total))) for g in (group_a, group_b))
        place_a = np.arange(len(ids_a)) + before_b[group_a]
        place_b = np.arange(len(ids_b)) + before_a[group_b + 1]
        ids = np.empty(len(ids_a) + len(ids_b), np.int64)
        sign = np.empty(len(ids), np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        sign[place_a] = np.where(np.diff(group_a, prepend=-1) > 0, ord(";"), ord(","))
        sign[place_b] = np.where(np.diff(group_b, prepend=-1) > 0, ord("|"), ord(","))
        text, ends = v.digits.joined(ids)
        text[ends - v.digits.lengths[ids]] = sign
        text_stop = np.append(0, ends)[np.cumsum(count_a + count_b)].tolist()

        self.texts, self.same, self.pairs = ([b""] * len(raws) for _ in range(3))
        raw_text = text.tobytes()
        raw_same = link_a[same].astype("<u4").tobytes()
        codes = link_a[~same] * v.size_b + link_b[~same]
        width = 8 if v.wide else 4
        raw_pairs = codes.astype(f"<u{width}").tobytes()
        low = (0, 0, 0)
        for i, t, s, p in zip(some, text_stop, sames.tolist(), (links - sames).tolist(), strict=True):
            self.texts[i], self.same[i], self.pairs[i] = raw_text[low[0] : t], raw_same[4 * low[1] : 4 * s], raw_pairs[width * low[2] : width * p]
            low = (t, s, p)

    @staticmethod
    def spelled(v: Vocabularies, raws: list[bytes], a: list[bytes], b: list[bytes]) -> np.ndarray:
        """Whether the tokens of both spell each run."""
        good = np.ones(len(raws), bool)
        for ids, flat in ((a, v.flat_a), (b, v.flat_b)):
            lengths = flat.lengths[np.frombuffer(b"".join(ids), "<u4")]
            first = np.append(0, np.cumsum([len(x) // 4 for x in ids]))
            sums = np.append(0, np.cumsum(lengths))[first]
            good &= np.diff(sums) == np.array([len(x) for x in raws], np.int64)
        some = np.flatnonzero(good)
        want = np.frombuffer(b"".join(raws[i] for i in some), np.uint8)
        stop = np.cumsum([len(raws[i]) for i in some], dtype=np.int64)
        for ids, flat in ((a, v.flat_a), (b, v.flat_b)):
            own, _ = flat.joined(np.frombuffer(b"".join(ids[i] for i in some), "<u4"))
            wrong = np.flatnonzero(own != want)
            good[some[np.unique(np.searchsorted(stop, wrong, side="right"))]] = False
        return good


class Row:
    """One text, put together from its runs."""

    def __init__(self, text: str | None):
        self.text, self.good = text, bool(text)
        self.numbers, self.digest = np.zeros(4, np.int64), hashlib.sha256()
        self.same: list[bytes] = []
        self.pairs: list[bytes] = []

    def add(self, aligned: Aligned, i: int) -> None:
        self.good &= bool(aligned.good[i])
        if self.good:
            self.digest.update(aligned.texts[i] if self.numbers[0] else aligned.texts[i][1:])
            self.numbers += aligned.numbers[i]
            self.same.append(aligned.same[i])
            self.pairs.append(aligned.pairs[i])

    def checked(self, v: Vocabularies) -> Row:
        """If a run is not spelled, the whole text may still be."""
        if self.good or not self.text or not v.units:
            return self
        whole, out = " " + self.text, Row(self.text)
        out.add(Aligned(v, [whole.encode()], [v.of_a(whole)], list(v.of_b([whole]))), 0)
        return out


def aligned_rows(v: Vocabularies, tokens: Tokens, texts: list[str | None]) -> Iterator[Row]:
    rows: list[Row] = []
    runs: list[tuple[Row, bytes, bytes, bytes]] = []
    size = 0

    def align() -> None:
        together = Aligned(v, *([x[i] for x in runs] for i in (1, 2, 3)))
        for i, (row, *_) in enumerate(runs):
            row.add(together, i)
        runs.clear()

    for text in texts:
        rows.append(Row(text))
        for units in runs_of(text, v.units) if text else ():
            raw = "".join(units).encode()
            runs.append((rows[-1], raw, *tokens.of(units)))
            size += len(raw)
            if size >= RUN:
                align()
                size = 0
        if not runs:
            yield from (row.checked(v) for row in rows)
            rows = []
    if runs:
        align()
    yield from (row.checked(v) for row in rows)


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def aligned_texts(docs: DataFrame, path_a: str, path_b: str, kind: str) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, same, pairs): the last two hold the ids of links, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabularies.at(path_a, path_b)
        tokens = Tokens(v)
        for batch in batches:
            at, rows = 0, []

            def packed() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(rows)),
                     *(pa.array([int(r.numbers[i]) if r.good else 0 for r in rows], pa.int64()) for i in range(4)),
                     pa.array([r.digest.hexdigest() if r.good else "" for r in rows], pa.string()),
                     *(pa.array([b"".join(x) if r.good else b"" for r, x in own], pa.binary())
                       for own in ([(r, r.same) for r in rows], [(r, r.pairs) for r in rows]))],
                    names=["id", *NUMBERS, "groups_sha256", "same", "pairs"])

            for row in aligned_rows(v, tokens, [x.as_py() for x in batch.column(1)]):
                rows.append(row)
                if sum(r.numbers[3] for r in rows[-1:]) > RUN or len(rows) >= 500:
                    yield packed()
                    at, rows = at + len(rows), []
            if rows:
                yield packed()

    return docs.mapInArrow(
        run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same binary, pairs binary")


def unpacked(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a packed column, and where each row's begin (one more at the end)."""
    stops = np.append(0, np.cumsum([len(x.as_buffer()) // width for x in column], dtype=np.int64))
    return np.frombuffer(b"".join(x.as_buffer() for x in column), f"<u{width}").astype(np.int64), stops


def link_counts(aligned: DataFrame, vocabulary: int, wide: bool) -> DataFrame:
    """(same, code, n): links of identical bytes by A id (``same``), the others by pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, held, size = np.zeros(vocabulary, np.int64), [], 0

        def counted(same: bool, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), same)), pa.array(codes), pa.array(n)], names=["same", "code", "n"])

        for batch in batches:
            vector += np.bincount(unpacked(batch.column(0), 4)[0], minlength=vocabulary)
            held.append(unpacked(batch.column(1), 8 if wide else 4)[0])
            size += len(held[-1])
            if size >= HELD:
                yield counted(False, *np.unique(np.concatenate(held), return_counts=True))
                held, size = [], 0
        if size:
            yield counted(False, *np.unique(np.concatenate(held), return_counts=True))
        some = np.flatnonzero(vector)
        yield counted(True, some, vector[some])

    return (
        aligned.select("same", "pairs").mapInArrow(run, "same boolean, code long, n long")
        .groupBy("same", "code").agg(F.sum("n").alias("n"))
    )


def link_sums(aligned: DataFrame, v: Vocabularies, known) -> DataFrame:
    """``aligned`` with n_best, count_sum, and the links of pairs that are not ``known``."""
    size_b, wide, same_of = v.size_b, v.wide, v.same
    named = ["id", *NUMBERS, "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, best, codes, n = known.value
        is_best = (vector == best[same_of]).astype(np.int64)  # by A id, of its pair of equal bytes

        def row_sums(values: np.ndarray, stops: np.ndarray) -> np.ndarray:
            return np.diff(np.append(0, np.cumsum(values))[stops])

        for batch in batches:
            ids, stops = unpacked(batch.column(len(named)), 4)
            top, total = row_sums(is_best[ids], stops), row_sums(vector[ids], stops)
            pairs, stops = unpacked(batch.column(len(named) + 1), 8 if wide else 4)
            at = np.minimum(np.searchsorted(codes, pairs), max(len(codes) - 1, 0))
            found = (codes[at] == pairs) if len(codes) else np.zeros(len(pairs), bool)
            count = np.where(found, n[at], 0) if len(codes) else np.zeros(len(pairs), np.int64)
            top += row_sums(found & (count == best[pairs % size_b]), stops)
            total += row_sums(count, stops)
            lost = np.flatnonzero(~found)
            row = np.searchsorted(stops, lost, side="right") - 1
            missing = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)), pa.array(pairs[lost]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(named)], pa.array(top), pa.array(total), missing], names=[*named, "n_best", "count_sum", "missing"])

    kept = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in named)
    return aligned.select(*named, "same", "pairs").mapInArrow(run, f"{kept}, n_best long, count_sum long, missing array<long>")


def piece_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def pair_table(docs: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(a_id, b_id, n, same): how often each pair of ids is linked in all texts."""
    path_a, path_b = path_a or default_tokenizer(), path_b or piece_tokenizer()
    v = Vocabularies.at(path_a, path_b)
    aligned = aligned_texts(docs.select(F.lit(0).alias("id"), F.col(text).cast("string")), path_a, path_b, "int")
    same = F.element_at(F.lit(v.same.tolist()), (F.col("code") + 1).cast("int")).cast("long")
    return link_counts(aligned, len(v.bytes_a), v.wide).select(
        F.when(F.col("same"), F.col("code")).otherwise(F.floor(F.col("code") / v.size_b)).cast("long").alias("a_id"),
        F.when(F.col("same"), same).otherwise(F.col("code") % v.size_b).cast("long").alias("b_id"), "n", "same")


def alignment(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None,
    listed: int = LISTED,
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, see the module's head."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    path_a, path_b = path_a or default_tokenizer(), path_b or piece_tokenizer()
    v = Vocabularies.at(path_a, path_b)
    kind = docs.schema[id_col].dataType.simpleString()
    aligned = scratch.keep(aligned_texts(docs.select(F.col(id_col), F.col(text).cast("string")), path_a, path_b, kind))
    counts = scratch.keep(link_counts(aligned, len(v.bytes_a), v.wide))

    vector, best = np.zeros(len(v.bytes_a), np.int64), np.zeros(v.size_b, np.int64)
    same = counts.where("same").select("code", "n").toArrow()  # at most A's vocabulary
    vector[same.column("code").to_numpy()] = same.column("n").to_numpy()
    used = np.flatnonzero(vector)
    np.maximum.at(best, v.same[used], vector[used])
    others = counts.where("not same").select("code", "n")
    highest = others.groupBy((F.col("code") % v.size_b).alias("b")).agg(F.max("n").alias("n")).toArrow()  # at most B's
    np.maximum.at(best, highest.column("b").to_numpy(), highest.column("n").to_numpy())
    top, more = most_frequent(others, listed)
    codes, n = top.column("code").to_numpy(), top.column("n").to_numpy()
    order = np.argsort(codes)
    known = spark.sparkContext.broadcast((vector, best, codes[order], n[order]))

    found = link_sums(aligned, v, known)
    out = [F.col("id").alias(id_col), *NUMBERS, "n_best", "count_sum", "groups_sha256"]
    if not more:
        return found.select(*out)
    rows = scratch.keep(found.withColumn("row", F.monotonically_increasing_id()))
    highs = spark.createDataFrame(pa.table({"b": np.arange(v.size_b), "high": best}))  # the size of B's vocabulary
    rare = others.join(highs, F.col("code") % v.size_b == F.col("b")).select(
        "code", F.col("n").alias("count"), (F.col("n") == F.col("high")).cast("long").alias("is_best"))
    late = (
        rows.select("row", F.explode("missing").alias("code")).join(rare, "code").groupBy("row")
        .agg(F.sum("is_best").alias("more_best"), F.sum("count").alias("more_sum"))
    )
    return rows.join(late, "row", "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}).select(*out)
