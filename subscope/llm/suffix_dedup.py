"""Removal of repeated passages by suffix arrays built from Lyndon groups.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier (smaller id, or
the same document and an earlier start). All windows of ``LENGTH`` bytes are judged on the input.

1. *Anchors.* Every window has an anchor, the ``KMER`` bytes in it with the least hash (the leftmost
   of equals), so equal windows have equal anchors at the same place. Neighbouring windows mostly
   share theirs: a run of windows with one anchor is a *piece* of ``LENGTH`` to ``2 LENGTH`` bytes.
2. *Candidates.* Anchors are counted over all documents. Those that occur once hold no repeat. A
   bitmap of fixed size keeps most of them out of the next pass.
3. *Pieces.* Equal pieces are collapsed in each task and again behind the shuffle; of each only the
   earliest place goes on. Pieces of very frequent anchors get finer keys, namely the bytes that
   all windows of a narrow range around the anchor share, so that no group collects what merely
   stands beside a frequent passage.
4. *Suffix arrays.* The different pieces of an anchor are sorted with ``lyndon.suffix_arrays``, many
   anchors side by side. Windows that are equal stand next to each other; all but the earliest
   are repeats. Later copies of a whole piece are repeats throughout.
5. *Removal.* Repeated ranges are joined to the documents that have any.

Defined cases: a null or empty text has no bytes, no spans and the digest of nothing; texts shorter
than ``LENGTH`` lose nothing; a null id counts as the smallest; rows with the same id are the same
document, so what one repeats of the other at the same place stays; very long texts are read in
segments; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.common import Scratch, bitmap_of, in_bitmap, mix, powers, prefix_hash, range_hash, strings
from subscope.llm.lyndon import suffix_arrays

LENGTH = 100
KMER = 32
SEGMENT = 1 << 20
#: Anchors of so many places get finer keys; at most so many anchors do, which bounds the list.
FREQUENT, FREQUENT_MOST = 500, 1 << 17
STEP = 8
BATCH_BYTES = 1 << 19
NULL_ID = -(1 << 63)
_POSITION_BITS = 22


def segments(bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, start and end (bytes) of texts of about a segment together; long texts in overlapping parts."""
    rows, lows, highs, held = [], [], [], 0
    for row in np.flatnonzero(np.diff(bounds) >= length).tolist():
        low, high = int(bounds[row]), int(bounds[row + 1])
        while low < high - length + 1:
            stop = min(high, low + SEGMENT + length - 1)
            rows.append(row)
            lows.append(low)
            highs.append(stop)
            held += stop - low
            low += SEGMENT
            if held >= SEGMENT:
                yield np.array(rows), np.array(lows), np.array(highs)
                rows, lows, highs, held = [], [], [], 0
    if rows:
        yield np.array(rows), np.array(lows), np.array(highs)


def anchors(data: np.ndarray, sizes: np.ndarray, length: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in texts that lie one after the other in ``data``:
    part, first and last window start, place of the anchor, its hash; and the prefix hashes."""
    sums = prefix_hash(data)
    n = len(data) - kmer + 1
    hashes = mix((sums[kmer:] - sums[:-kmer]) * powers(n + 1)[1][:n])
    low = (hashes >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(n, dtype=np.uint64)
    width = length - kmer + 1
    done, least = 1, low
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if width > done:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    ends = np.cumsum(sizes)
    counts = sizes - length + 1
    firsts = ends - sizes
    at = np.arange(int(counts.sum())) + np.repeat(firsts - (np.cumsum(counts) - counts), counts)
    part = np.repeat(np.arange(len(sizes)), counts)
    place = (least[at] & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (part[1:] != part[:-1])))
    last = np.append(new[1:], len(at)) - 1
    return part[new], at[new], at[last], place[new], hashes[place[new]], sums


def _parts(column: pa.Array, length: int, kmer: int) -> Iterator[tuple]:
    data, bounds = strings(column)
    for rows, lows, highs in segments(bounds, length):
        own = np.concatenate([data[a:b] for a, b in zip(lows.tolist(), highs.tolist(), strict=True)])
        sizes = highs - lows
        part, first, last, place, key, sums = anchors(own, sizes, length, kmer)
        shift = lows - bounds[rows] - (np.cumsum(sizes) - sizes)  # from places in ``own`` to places in the text
        yield own, rows[part], shift[part], first, last, place, key, sums


def count_anchors(texts: DataFrame, length: int, kmer: int) -> DataFrame:
    """(key, c) of the anchors that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch.column(0), length, kmer):
                own, count = np.unique(part[6], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(count)], names=["key", "c"])

    return texts.mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).where("c > 1")


def finer(first, last, place, key, sums, length: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Runs cut into ranges of ``STEP`` offsets, keyed by the bytes all windows of the range share."""
    index, lows, highs, keys = [], [], [], []
    for offset in range(0, length - kmer + 1, STEP):
        most = min(offset + STEP - 1, length - kmer)
        low, high = np.maximum(first, place - most), np.minimum(last, place - offset)
        some = np.flatnonzero(low <= high)
        if len(some):
            at = place[some]
            shared = range_hash(sums, at - offset, at - most + length)
            index.append(some)
            lows.append(low[some])
            highs.append(high[some])
            keys.append(mix(shared + np.uint64(offset) + key[some]))
    return tuple(np.concatenate(x) for x in (index, lows, highs, keys))


def repeated_pieces(docs: DataFrame, bitmap, frequent, length: int, kmer: int) -> DataFrame:
    """(key, print, doc, at, size, piece): candidate pieces; their bytes come once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, often = bitmap.value, frequent.value
        told: set[int] = set()
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy()
            for own, row, shift, first, last, place, key, sums in _parts(batch.column(1), length, kmer):
                keep = np.flatnonzero(in_bitmap(filter_, key))
                if not len(keep):
                    continue
                row, shift, first, last, place, key = (x[keep] for x in (row, shift, first, last, place, key))
                if len(often):
                    at = np.minimum(np.searchsorted(often, key), len(often) - 1)
                    hot = often[at] == key
                    if hot.any():
                        h = np.flatnonzero(hot)
                        index, low, high, fine = finer(first[h], last[h], place[h], key[h], sums, length, kmer)
                        cold = np.flatnonzero(~hot)
                        row = np.concatenate([row[cold], row[h][index]])
                        shift = np.concatenate([shift[cold], shift[h][index]])
                        first = np.concatenate([first[cold], low])
                        last = np.concatenate([last[cold], high])
                        key = np.concatenate([key[cold], fine])
                prints = range_hash(sums, first, last + length)
                raw = own.tobytes()
                text: list[bytes | None] = []
                for a, b, p in zip(first.tolist(), last.tolist(), prints.tolist(), strict=True):
                    if p in told:
                        text.append(None)
                    else:
                        told.add(p)
                        text.append(raw[a : b + length])
                if len(told) > 1_000_000:
                    told.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(ids[row]),
                     pa.array(first + shift), pa.array((last - first + 1).astype(np.int32)), pa.array(text, pa.binary())],
                    names=["key", "print", "doc", "at", "size", "piece"])

    return docs.mapInArrow(run, "key long, print long, doc long, at long, size int, piece binary")


def repeats_of(groups: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]], length: int) -> tuple[np.ndarray, ...]:
    """(doc, low, high) byte ranges that repeat an earlier window; a group is (doc, at, size, pieces) of one key."""
    letters, bounds, starts, sizes = [], [0], [], []
    total = 0
    for _, _, size, texts in groups:
        for text, n in zip(texts, size.tolist(), strict=True):
            letters += [text, b"\x01"]
            starts.append(total)
            sizes.append(n)
            total += len(text) + 1
        letters.append(b"\x00")
        total += 1
        bounds.append(total)
    data = np.frombuffer(b"".join(letters), np.uint8)
    starts, sizes = np.array(starts), np.array(sizes)
    lengths = np.array([len(t) for _, _, _, texts in groups for t in texts])
    own = np.zeros(total, np.int32)  # text letters get numbers above the two separators
    own[:] = data
    inside = np.zeros(total + 1, np.int32)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + lengths, -1)
    own += 2 * np.cumsum(inside[:-1])
    order = suffix_arrays(own, np.array(bounds))
    window = np.zeros(total + 1, np.int32)
    np.add.at(window, starts, 1)
    np.add.at(window, starts + sizes, -1)
    order = order[np.cumsum(window[:-1])[order] > 0]
    rows = np.lib.stride_tricks.as_strided(data, (total - length + 1, length), (1, 1))[order]
    rows = np.ascontiguousarray(rows).view(f"V{length}").reshape(-1)
    lane = np.searchsorted(np.array(bounds), order, side="right")
    same = (rows[1:] == rows[:-1]) & (lane[1:] == lane[:-1])
    run = np.cumsum(np.append(True, ~same))
    many = np.append(False, same) | np.append(same, False)
    order, run = order[many], run[many]
    piece = np.searchsorted(starts, order, side="right") - 1
    doc = np.concatenate([g[0] for g in groups])[piece]
    at = np.concatenate([g[1] for g in groups])[piece] + (order - starts[piece])
    by = np.lexsort((at, doc, run))
    piece, doc, at, run, order = piece[by], doc[by], at[by], run[by], order[by]
    lead = np.maximum.accumulate(np.where(np.append(True, run[1:] != run[:-1])[: len(run)], np.arange(len(run)), 0))
    later = (doc != doc[lead]) | (at != at[lead])
    piece, doc, at = piece[later], doc[later], at[later]
    by = np.lexsort((at, piece))
    piece, doc, at = piece[by], doc[by], at[by]
    new = np.flatnonzero(np.append(True, (piece[1:] != piece[:-1]) | (at[1:] != at[:-1] + 1))[: len(at)])
    last = np.append(new[1:], len(at)) - 1
    return doc[new], at[new], at[last] + length if len(at) else at[new]


def earliest_repeats(pieces: DataFrame, length: int) -> DataFrame:
    """(doc, low, high) of the repeats among the different pieces of each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list = []
        held = 0
        open_: list = []

        def flush() -> pa.RecordBatch:
            doc, low, high = repeats_of(waiting, length)
            return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(low), pa.array(high)], names=["doc", "low", "high"])

        def close() -> int:
            if not open_ or sum(len(x[0]) for x in open_) < 2:
                return 0
            texts = [t for x in open_ for t in x[3]]
            waiting.append((*(np.concatenate([x[i] for x in open_]) for i in range(3)), texts))
            return sum(map(len, texts))

        key_open = None
        for batch in batches:
            key, doc, at, size = (batch.column(i).to_numpy() for i in range(4))
            texts = batch.column(4).to_pylist()
            if not len(key):
                continue
            edges = np.flatnonzero(np.append(True, key[1:] != key[:-1])).tolist() + [len(key)]
            for low, high in zip(edges, edges[1:], strict=False):
                if key[low] != key_open:
                    held += close()
                    open_, key_open = [], key[low]
                    if held >= BATCH_BYTES:
                        yield flush()
                        waiting, held = [], 0
                open_.append((doc[low:high].copy(), at[low:high].copy(), size[low:high].copy(), texts[low:high]))
        close()
        if waiting:
            yield flush()

    return pieces.repartition("key").sortWithinPartitions("key").select("key", "doc", "at", "size", "piece").mapInArrow(
        run, "doc long, low long, high long")


def merge(ranges: np.ndarray, size: int) -> np.ndarray:
    """Ranges sorted and joined where they touch, within 0 to ``size``."""
    if not len(ranges):
        return np.empty((0, 2), np.int64)
    ranges = np.clip(ranges[np.argsort(ranges[:, 0], kind="stable")], 0, size)
    ends = np.maximum.accumulate(ranges[:, 1])
    new = np.flatnonzero(np.append(True, ranges[1:, 0] > ends[:-1]))
    out = np.stack([ranges[new, 0], ends[np.append(new[1:], len(ranges)) - 1]], axis=1)
    return out[out[:, 0] < out[:, 1]]


def repeated_ranges(docs: DataFrame, scratch: Scratch, id_col: str, text: str, length: int = LENGTH, kmer: int = KMER) -> DataFrame:
    """(doc, ranges): per document with repeats, its repeated byte ranges (they may overlap)."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    counted = scratch.keep(count_anchors(own.select("text"), length, kmer))
    bitmap = spark.sparkContext.broadcast(bitmap_of(counted.select("key")))
    often = counted.where(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "key").limit(FREQUENT_MOST).select("key").toArrow()
    frequent = spark.sparkContext.broadcast(np.sort(often.column("key").to_numpy().view(np.uint64)))
    members = scratch.keep(repeated_pieces(own, bitmap, frequent, length, kmer))
    pieces = scratch.keep(
        members.groupBy("key", "print").agg(
            F.min(F.struct("doc", "at")).alias("first"), F.first("piece", ignorenulls=True).alias("piece"),
            F.first("size").alias("size"), F.count("*").alias("n"))
        .select("key", "print", "first.doc", "first.at", "size", "piece", "n")
    )
    among = earliest_repeats(pieces, length)
    first = pieces.where("n > 1").select("key", "print", F.col("doc").alias("d"), F.col("at").alias("a"))
    later = members.join(first, ["key", "print"]).where("doc <> d or at <> a").select(
        "doc", F.col("at").alias("low"), (F.col("at") + F.col("size") - 1 + length).alias("high"))
    return scratch.keep(
        among.union(later).groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("ranges")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, kmer: int = KMER) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed byte ranges) and the bytes kept,
    the last only where something was removed."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    found = repeated_ranges(docs, scratch, id_col, text, length, kmer)
    bitmap = spark.sparkContext.broadcast(bitmap_of(found.select("doc")))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Describe texts without repeats at once; only the others travel to the join."""
        for batch in batches:
            data, bounds = strings(batch.column(1))
            touched = in_bitmap(bitmap.value, batch.column(0).fill_null(NULL_ID).to_numpy())
            raw = [data[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(0).fill_null(NULL_ID), pa.array(np.diff(bounds)),
                 pa.array([None if t else hashlib.sha256(r).hexdigest() for r, t in zip(raw, touched, strict=True)], pa.string()),
                 pa.array([r if t else None for r, t in zip(raw, touched, strict=True)], pa.binary())],
                names=["id", "doc", "n_bytes", "kept_sha256", "raw"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digests, kept, lists = [], [], [], [], []
            for size, digest, raw, ranges in zip(*(batch.column(i) for i in (1, 2, 3, 4)), strict=True):
                if not raw.is_valid:
                    removed.append(0), spans.append(0), digests.append(digest.as_py()), kept.append(None), lists.append([])
                    continue
                whole = raw.as_py()
                rows = np.array([(r["low"], r["high"]) for r in ranges.as_py() or ()], np.int64).reshape(-1, 2)
                out = merge(rows, size.as_py())
                parts, done = [], 0
                for low, high in out.tolist():
                    parts.append(whole[done:low])
                    done = high
                left = b"".join([*parts, whole[done:]])
                removed.append(len(whole) - len(left))
                spans.append(len(out))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
                lists.append([{"low": a, "high": b} for a, b in out.tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digests, pa.string()),
                 pa.array(lists, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))), pa.array(kept, pa.binary())],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    sifted = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string")).mapInArrow(
        sift, "id long, doc long, n_bytes long, kept_sha256 string, raw binary")
    return sifted.join(found, "doc", "left").select("id", "n_bytes", "kept_sha256", "raw", "ranges").mapInArrow(
        cut, f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
             "spans array<struct<low:bigint,high:bigint>>, kept binary")
