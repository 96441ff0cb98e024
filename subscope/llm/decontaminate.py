"""Benchmark decontamination by spaced-seed hashing.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A mask hashes the words
below its ones and ignores the others, so a hit survives substituted words. ``MASKS`` holds a set of masks
for each range of item lengths; wherever ``overlap`` finds an agreement, one of them hits (the tests go
through all patterns of substituted words). Documents are hashed by the sets that the items need.
Hashes of documents meet those of benchmark items in a join; a bitmap of fixed size
drops most document hashes before it (it lets too many through when the benchmark is huge, never
too few). Around each hit the two word sequences are compared along the hit's diagonal: they
overlap when some stretch of ``MIN_OVERLAP`` words or more (or the whole item, if shorter) agrees
in ``MIN_SHARE`` of its words.

Defined cases: null or empty texts are clean; items of fewer than ``MIN_WORDS`` words are too short
to tell and ignored; items with the same words count as the one with the least id, an item without an id as ``NULL_ITEM``; rows with the
same id (null is an id too) share one result; an empty table on either side gives only clean
documents; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.common import (
    PUNCTUATION, Scratch, bitmap_of, combine, in_bitmap, pieces, shuffles_released, strings, without, word_hashes,
)

#: Least words of an item and the masks of such items, up to the next entry. An agreement of 26 words or more
#: holds a shorter one of at least 13, so the last set need only cover stretches of 13 to 25 words.
MASKS = (
    (6, ("1111", "11011")),
    (8, ("11111", "111011", "11010011")),
    (13, ("1110111", "1111011", "1110100011", "11000011011")),
)
MIN_WORDS = MASKS[0][0]
NULL_ITEM = -(1 << 63)
MIN_OVERLAP = 13
MIN_SHARE = 0.8
SLICE_BYTES = 2 << 20


def seed_offsets(mask: str) -> tuple[int, ...]:
    return tuple(i for i, c in enumerate(mask) if c == "1")


def mask_set(n_words: int) -> int:
    """The set of ``MASKS`` for an item of so many words."""
    return sum(n_words >= least for least, _ in MASKS) - 1


def seeds(
    hashes: np.ndarray, rows: np.ndarray, sets: list[int]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, position in the row, hash) of every place of every mask of the sets inside one row."""
    row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    for number, mask in ((len(MASKS) * i + chosen, m) for chosen in sets for i, m in enumerate(MASKS[chosen][1])):
        count = max(len(hashes) - len(mask) + 1, 0)
        if not count:
            continue
        values = combine(hashes, seed_offsets(mask), count) + np.uint64(number)
        inside = np.flatnonzero(row_of[:count] == row_of[len(mask) - 1 : len(mask) - 1 + count])
        yield row_of[inside], inside - rows[row_of[inside]], values[inside]


def overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> int:
    """Agreeing words of the best stretch with document word ``i + shift`` beside item word ``i``; 0 if none will do."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    need = min(MIN_OVERLAP, len(item))
    if high - low < need:
        return 0
    same = doc[low + shift : high + shift] == item[low:high]
    bad = round(MIN_SHARE / (1 - MIN_SHARE))
    score = np.zeros(len(same) + 1, np.int64)
    np.cumsum(np.where(same, 1, -bad), out=score[1:])
    least = np.minimum.accumulate(score[: len(score) - need])
    good = np.flatnonzero(score[need:] >= least)
    if not len(good):
        return 0
    total = np.zeros(len(same) + 1, np.int64)
    np.cumsum(same, out=total[1:])
    ends = good + need
    first = np.searchsorted(-least, -score[ends], side="left")  # the first start that is low enough
    return int((total[ends] - total[first]).max())


def benchmark_words(benchmark: DataFrame, item_col: str, text: str) -> DataFrame:
    """(item, words): the word hashes of each distinct item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = strings(batch.column(1))
            hashes, rows = word_hashes(data, bounds, PUNCTUATION)
            long = np.flatnonzero(np.diff(rows) >= MIN_WORDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(long)),
                 pa.array([hashes[rows[i] : rows[i + 1]].tobytes() for i in long], pa.binary())],
                names=["item", "words"])

    return (
        benchmark.select(F.coalesce(F.col(item_col).cast("long"), F.lit(NULL_ITEM)).alias("item"), F.col(text).cast("string"))
        .mapInArrow(run, "item long, words binary").groupBy("words").agg(F.min("item").alias("item"))
        .select("item", "words")
    )


def item_seeds(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column(0), batch.column(1), strict=True):
                hashes = np.frombuffer(raw.as_py(), np.uint64)
                for _, at, values in seeds(hashes, np.array([0, len(hashes)]), [mask_set(len(hashes))]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values.view(np.int64)), pa.array([item.as_py()] * len(at), pa.int64()),
                         pa.array(at.astype(np.int32))], names=["seed", "item", "item_at"])

    return items.mapInArrow(run, "seed long, item long, item_at int")


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(id, item, n_words) of each verified overlap; n_words are the words that agree."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    items = scratch.keep(benchmark_words(benchmark, item_col, item_text))
    known = scratch.keep(item_seeds(items))
    sizes = items.select(F.octet_length("words") / 8)
    needed = [  # one flag per set of masks
        i for i, used in enumerate(sizes.toDF("n").agg(*(
            F.coalesce(F.max(F.col("n").between(least, most)), F.lit(False))
            for (least, _), most in zip(MASKS, [n - 1 for n, _ in MASKS[1:]] + [1 << 62], strict=True))).first()) if used]
    bitmap = spark.sparkContext.broadcast(bitmap_of(known.select("seed")))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = bitmap.value
        for batch in batches:
            data, bounds = strings(batch.column(1))
            for low, high in pieces(bounds, SLICE_BYTES):
                hashes, rows = word_hashes(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], PUNCTUATION)
                found = [(r[m], a[m], v[m]) for r, a, v in seeds(hashes, rows, needed) if (m := in_bitmap(filter_, v)).any()]
                if not found:
                    continue
                row, at, value = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(row, kind="stable")
                row, at, value = row[order], at[order], value[order]
                own, first = np.unique(row, return_index=True)
                offsets = pa.array(np.append(first, len(row)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low).take(pa.array(own)),
                     pa.ListArray.from_arrays(offsets, pa.array(value.view(np.int64))),
                     pa.ListArray.from_arrays(offsets, pa.array(at.astype(np.int32))),
                     pa.array([hashes[rows[i] : rows[i + 1]].tobytes() for i in own], pa.binary())],
                    names=["id", "seeds", "at", "words"])

    kind = docs.schema[id_col].dataType.simpleString()
    hit = scratch.keep(
        docs.select(F.col(id_col).alias("id"), F.col(text).cast("string"))
        .mapInArrow(hits, f"id {kind}, seeds array<bigint>, at array<int>, words binary")
    )
    pairs = (
        hit.select("id", F.explode(F.arrays_zip("seeds", "at")).alias("h"))
        .select("id", F.col("h.seeds").alias("seed"), F.col("h.at").alias("doc_at"))
        .join(known, "seed").select("id", "item", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct()
        .groupBy("id", "item").agg(F.collect_list("shift").alias("shifts"))
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for shifts, doc, item in zip(*(batch.column(i) for i in (2, 3, 4)), strict=True):
                a, b = np.frombuffer(doc.as_py(), np.uint64), np.frombuffer(item.as_py(), np.uint64)
                best.append(max(overlap(a, b, s) for s in shifts.as_py()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best, pa.int64())], names=["id", "item", "n_words"])

    with_words = (
        pairs.join(items.withColumnRenamed("words", "item_words"), "item").alias("p")
        .join(hit.select("id", "words").alias("d"), F.expr("p.id <=> d.id"))
        .select("p.id", "item", "shifts", "d.words", "item_words")
    )
    found = scratch.keep(
        with_words.mapInArrow(verify, f"id {kind}, item long, n_words long").where("n_words > 0")
        .groupBy(F.col("id").alias(id_col), "item").agg(F.max("n_words").alias("n_words"))
    )
    scratch.keep_only(found)
    return found


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document: whether it holds a benchmark passage, how many items, which, and the longest agreement."""
    found = find_overlaps(docs, benchmark, id_col, text, item_col, item_text)
    per_doc = found.groupBy(F.col(id_col).alias("k")).agg(
        F.count("item").alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"),
        F.max("n_words").alias("n_words"))
    return docs.select(id_col).alias("d").join(per_doc.alias("f"), F.expr(f"d.`{id_col}` <=> f.k"), "left").select(
        f"d.{id_col}", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("n_words", F.lit(0)).alias("n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without a benchmark passage, columns as they were."""
    with shuffles_released(docs.sparkSession):
        found = find_overlaps(docs, benchmark, id_col, text).select(F.col(id_col).alias("k")).distinct()
        return without(docs, id_col, Scratch(docs.sparkSession).keep(found))
