"""Similarity join of documents on word shingles, as a blocked sparse matrix product.

The matrix has a row per distinct shingle set and a column per shingle; its product with its own
transpose counts overlaps. Two sets link when ``100 * overlap >= SIMILARITY * union``.

1. *Columns that can matter.* In one global order (frequent shingles last, else by hash) two sets
   that link share a shingle among the first ``n - ceil(0.8 n) + 1`` of each, so only those
   entries are multiplied. Which shingles are frequent comes from all documents; the list of the
   most frequent is bounded and only an order, so it cannot change a result.
2. *Blocks of columns.* Entries are shuffled by column. Columns with one set are dropped. In the
   others every set is paired with the column's least set (not with every other one), if sizes
   and positions allow the required overlap.
3. *Block sizes.* Every row has the sizes of its ``SIZE_BLOCKS`` blocks of the hash range. The sum of
   the lesser sizes bounds the overlap from above, so most pairs are discarded without their rows.
4. *Overlaps.* The full rows of a pair are multiplied block by block; a pair is discarded as soon as
   what it has plus what is left stays below its bound.
5. *Rounds.* In columns whose sets lie in different components of the links so far, a few sets chosen
   by hash are paired with those of other components (``CHOSEN``). All columns rank their sets in one order, so
   columns that hold the same sets choose the same ones, and their pairs fall together. That joins up
   large groups of near copies at a cost that grows with the group, not with its square.
6. *The rest.* Pairs that share a column but still lie in different components are multiplied too, unless
   their parities tell them apart: every shingle flips one of ``PARITIES`` bits of its row, so two rows differ
   in at least as many shingles as their bits differ, and linked rows differ in at most
   ``n + m - 2 * least overlap``. The join on the column compares the bits and makes no row for the others.
   Pairs inside one component need no count, as only components are reported.

Rows are 64-bit fingerprints of shingle sets and columns 64-bit hashes of shingles; equal sets
are one row. Defined cases: null or empty texts have no shingles and are linked with nothing; fewer
words than a shingle make one shingle; repeated rows link like copies; a document with a null id gets
the least other id it is linked with or null; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscope.llm.common import (
    MIX_1, Scratch, bitmap_of, components, in_bitmap, mix, pieces, shingles, strings, word_hashes,
)

WORDS = 5
SIMILARITY = 80
SLICE_BYTES = 2 << 20
#: A shingle in this many of some 16 MB of texts counts as frequent; at most FREQUENT are listed.
FREQUENT_LOCAL = 3
COUNT_ENTRIES = 2_500_000
FREQUENT = 1 << 19
BLOCKS = 4
SIZE_BLOCKS = 256
#: Bits of a row's parity, in words of 64.
PARITIES = 1024
#: Sets chosen by hash in each open column, round by round.
CHOSEN = (2, 12)


def shingle_rows(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of rows: first row, end row, and of its distinct shingles the row (from the first)
    and hash, sorted; then per row the number of shingles and the fingerprint of the set."""
    data, bounds = strings(column)
    for low, high in pieces(bounds, SLICE_BYTES):
        hashes, rows = word_hashes(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
        row, value = shingles(hashes, rows, k)
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        row, value = row[fresh], value[fresh]
        count = np.bincount(row, minlength=high - low)
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(mix(value * MIX_1), out=total[1:])
        ends = np.cumsum(count)
        print_ = mix(total[ends] - total[ends - count] + count.astype(np.uint64) * MIX_1)
        yield low, high, row, value, count, print_


def needed(n: int, other: int, similarity: int) -> int:
    """Least overlap of two linked sets of these sizes."""
    return -(-similarity * (n + other) // (100 + similarity))


def block_sizes(row: np.ndarray, value: np.ndarray, rows: int) -> list[bytes]:
    """Per row the sizes of its blocks, one byte each, or two each where a size needs them."""
    block = (value >> np.uint64(56)).astype(np.int64)
    sizes = np.bincount(row * SIZE_BLOCKS + block, minlength=rows * SIZE_BLOCKS).reshape(rows, SIZE_BLOCKS)
    small = sizes.max(axis=1, initial=0) < 256
    return [r.astype(np.uint8 if s else "<u4").tobytes() for r, s in zip(sizes, small, strict=True)]


def most_overlap(a: bytes, b: bytes) -> int:
    """No two rows with these block sizes overlap in more shingles."""
    x, y = (np.frombuffer(z, np.uint8 if len(z) == SIZE_BLOCKS else "<u4") for z in (a, b))
    return int(np.minimum(x, y).sum(dtype=np.int64))


def parities(row: np.ndarray, value: np.ndarray, rows: int) -> pa.Array:
    """Per row its ``PARITIES`` bits as an array of longs; the shingles come sorted by row and value."""
    words = PARITIES // 64
    place = value >> np.uint64(64 - PARITIES.bit_length() + 1)
    word = row * words + (place >> np.uint64(6)).astype(np.int64)  # ascending, as the shingles are
    out = np.zeros(rows * words, np.uint64)
    if len(word):
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        out[word[starts]] = np.bitwise_xor.reduceat(np.uint64(1) << (place & np.uint64(63)), starts)
    return pa.ListArray.from_arrays(np.arange(0, len(out) + 1, words, dtype=np.int32), pa.array(out.view(np.int64)))


def differing(a: str, b: str):
    """The least number of shingles in which two rows differ (columns of their parities)."""
    return reduce(lambda x, y: x + y, (
        F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(PARITIES // 64)))


def whole_text(text: str):
    """A hash of a whole text, by which a later pass finds it without its shingles."""
    return F.xxhash64(F.col(text).cast("string")).alias("whole")


def describe(docs: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """Rows (kind 0, id, fingerprint or null, n, block sizes, parities, hash of the text) per document and
    (kind 1, null, shingle, count, null, null, null) of frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        entries = 0

        def frequent() -> pa.RecordBatch:
            value, count = np.unique(np.concatenate(held), return_counts=True)
            many = count >= FREQUENT_LOCAL
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(many.sum(), np.int32)), pa.nulls(int(many.sum()), pa.int64()),
                 pa.array(value[many].view(np.int64)), pa.array(count[many]), pa.nulls(int(many.sum()), pa.binary()),
                 pa.nulls(int(many.sum()), pa.list_(pa.int64())), pa.nulls(int(many.sum()), pa.int64())],
                names=["kind", "id", "key", "n", "sizes", "bits", "whole"])

        for batch in batches:
            for low, high, row, value, count, prints in shingle_rows(batch.column(1), k):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(high - low, np.int32)), batch.column(0).slice(low, high - low),
                     pa.array(prints.view(np.int64), mask=count == 0), pa.array(count.astype(np.int64)),
                     pa.array(block_sizes(row, value, high - low), pa.binary()), parities(row, value, high - low),
                     batch.column(2).slice(low, high - low)],
                    names=["kind", "id", "key", "n", "sizes", "bits", "whole"])
                held.append(value)
                entries += len(value)
                if entries >= COUNT_ENTRIES:
                    yield frequent()
                    held, entries = [], 0
        if held:
            yield frequent()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string"), whole_text(text)).mapInArrow(
        run, "kind int, id long, key long, n long, sizes binary, bits array<long>, whole long")


def prefix_entries(docs: DataFrame, text: str, k: int, similarity: int, frequent) -> DataFrame:
    """(h, fp, n, at): the entries of each set's prefix; ``at`` is the shingle's place in the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = frequent.value
        seen: set[int] = set()
        for batch in batches:
            for _, _, row, value, count, prints in shingle_rows(batch.column(0), k):
                weight = np.zeros(len(value), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
                    weight = np.where(known[at] == value, often[at], 0)
                order = np.lexsort((value, weight, row))
                value = value[order]
                first = np.cumsum(count) - count
                place = np.arange(len(row)) - first[row]
                prefix = count + (-similarity * count // 100) + 1  # n - ceil(n s) + 1
                new = np.ones(len(count), bool)
                for i, fp in enumerate(prints.tolist()):
                    new[i] = fp not in seen
                    seen.add(fp)
                keep = (place < prefix[row]) & new[row]
                own = row[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[keep].view(np.int64)), pa.array(prints[own].view(np.int64)),
                     pa.array(count[own].astype(np.int32)), pa.array(place[keep].astype(np.int32))],
                    names=["h", "fp", "n", "at"])

    return docs.select(F.col(text).cast("string")).mapInArrow(run, "h long, fp long, n int, at int")


def shared_columns(entries: DataFrame) -> DataFrame:
    """Entries of columns with two sets or more, each beside the column's least set (c_fp, c_n, c_at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None  # first row of the column the last batch ended in, and whether it has been put out
        out = False
        last = None
        for batch in batches:
            h, fp, n, at = (batch.column(i).to_numpy() for i in range(4))
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (fp[1:] != fp[:-1])
            if last is not None and len(h):
                fresh[0] = (h[0], fp[0]) != last
            h, fp, n, at = h[fresh], fp[fresh], n[fresh], at[fresh]
            if not len(h):
                continue
            last = (h[-1], fp[-1])
            if head is not None and head[0] == h[0]:  # the column goes on
                if out:
                    lead = np.array([head])
                else:
                    h, fp, n, at = (np.concatenate([[head[i]], x]) for i, x in enumerate((h, fp, n, at)))
                    lead = None
            else:
                lead = None
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            sizes = np.diff(np.append(starts, len(h)))
            column = np.repeat(np.arange(len(starts)), sizes)
            centre = [x[starts].copy() for x in (fp, n, at)]
            multi = sizes > 1
            if lead is not None:
                multi[0] = True
                for i in range(3):
                    centre[i][0] = lead[0][i + 1]
            keep = multi[column]
            head = (h[-1], centre[0][-1], centre[1][-1], centre[2][-1])
            out = bool(multi[-1])
            if keep.any():
                own = column[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[keep]), pa.array(fp[keep]), pa.array(n[keep].astype(np.int32)), pa.array(at[keep].astype(np.int32)),
                     pa.array(centre[0][own]), pa.array(centre[1][own].astype(np.int32)), pa.array(centre[2][own].astype(np.int32))],
                    names=["h", "fp", "n", "at", "c_fp", "c_n", "c_at"])

    return entries.repartition("h").sortWithinPartitions("h", "fp").mapInArrow(
        run, "h long, fp long, n int, at int, c_fp long, c_n int, c_at int")


def possible(a: str, b: str, similarity: int):
    """Whether sizes and places of a shared shingle allow two sets (column prefixes a and b) to link."""
    n, m = F.col(f"{a}n").cast("long"), F.col(f"{b}n").cast("long")
    least = F.ceil(similarity * (n + m) / F.lit(100 + similarity)).cast("long")
    return (
        (100 * F.least(n, m) >= similarity * F.greatest(n, m))
        & (F.col(f"{a}at") <= n - least) & (F.col(f"{b}at") <= m - least)
    )


def multiply(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Overlap of two sorted rows, block by block of the hash range; -1 as soon as ``least`` is out of reach."""
    edges = np.array([(i << 64) // BLOCKS for i in range(1, BLOCKS)], np.uint64)
    cut_a = [0, *np.searchsorted(a, edges), len(a)]
    cut_b = [0, *np.searchsorted(b, edges), len(b)]
    got = 0
    for i in range(BLOCKS):
        x, y = a[cut_a[i] : cut_a[i + 1]], b[cut_b[i] : cut_b[i + 1]]
        if len(x) and len(y):
            at = np.minimum(np.searchsorted(x, y), len(x) - 1)
            got += int(np.count_nonzero(x[at] == y))
        if got + min(len(a) - cut_a[i + 1], len(b) - cut_b[i + 1]) < least:
            return -1
    return got


def within_bounds(pairs: DataFrame, sizes: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose block sizes allow them to link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, n, m = (batch.column(i).to_pylist() for i in range(2, 6))
            good = [most_overlap(p, q) >= needed(i, j, similarity) for p, q, i, j in zip(x, y, n, m, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    of_a = sizes.select(F.col("fp").alias("a"), F.col("sizes").alias("x"), F.col("n").alias("i"))
    of_b = sizes.select(F.col("fp").alias("b"), F.col("sizes").alias("y"), F.col("n").alias("j"))
    return pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "x", "y", "i", "j").mapInArrow(run, "a long, b long")


def linked(
    docs: DataFrame, pairs: DataFrame, sizes: DataFrame, text: str, k: int, similarity: int, scratch: Scratch
) -> DataFrame:
    """The pairs (a, b) of fingerprints whose sets link. The wanted rows are made in one pass over the texts and written.

    ``sizes`` names one text of each set by its hash, and only these texts are shingled again. What a bitmap
    lets through wrongly meets no pair in the joins.
    """
    spark = docs.sparkSession
    in_pairs = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
    wanted = spark.sparkContext.broadcast(bitmap_of(sizes.join(in_pairs, "fp", "left_semi").select("whole")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, seen = wanted.value, set()
        for batch in batches:
            some = in_bitmap(filter_, batch.column(1).to_numpy())
            for _, _, _, value, count, prints in shingle_rows(batch.column(0).filter(pa.array(some)), k):
                ends = np.cumsum(count)
                some = [i for i in np.flatnonzero(count) if not (prints[i] in seen or seen.add(prints[i]))]
                if some:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(prints[some].view(np.int64)),
                         pa.array([value[ends[i] - count[i] : ends[i]].tobytes() for i in some], pa.binary())],
                        names=["fp", "row"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                good.append(multiply(a, b, needed(len(a), len(b), similarity)) >= 0)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    sets = scratch.keep(
        docs.select(F.col(text).cast("string"), whole_text(text)).mapInArrow(rows, "fp long, row binary").dropDuplicates(["fp"]))
    with_b = pairs.join(sets.select(F.col("fp").alias("b"), F.col("row").alias("row_b")), "b")
    both = with_b.join(sets.select(F.col("fp").alias("a"), F.col("row").alias("row_a")), "a")
    found = scratch.keep(both.select("a", "b", "row_a", "row_b").mapInArrow(verify, "a long, b long"))
    scratch.drop(sets)
    return found


def linked_sets(
    docs: DataFrame, id_col: str, text: str, k: int, similarity: int, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """(id, fp, n) of every row, and (node, component) of the sets that are linked with another."""
    spark = docs.sparkSession
    described = scratch.keep(describe(docs, id_col, text, k))
    rows = described.where("kind = 0").select("id", F.col("key").alias("fp"), "n")
    often = (
        described.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    )
    keys = often.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    frequent = spark.sparkContext.broadcast((keys[order], often.column("n").to_numpy()[order]))

    columns = scratch.keep(shared_columns(prefix_entries(docs, text, k, similarity, frequent)))
    in_columns = columns.select("fp").distinct()
    sizes = scratch.keep(
        described.where("kind = 0").select(F.col("key").alias("fp"), "n", "sizes", "bits", "whole")
        .join(in_columns, "fp", "left_semi").dropDuplicates(["fp"])
    )

    def multiplied(pairs: DataFrame) -> DataFrame | None:
        close = scratch.keep(within_bounds(pairs, sizes, similarity))
        found = linked(docs, close, sizes, text, k, similarity, scratch) if not close.isEmpty() else None
        scratch.drop(close)
        return None if found is None or found.isEmpty() else found

    done = [scratch.keep(
        columns.where("fp <> c_fp").where(possible("", "c_", similarity))
        .select(F.least("c_fp", "fp").alias("a"), F.greatest("c_fp", "fp").alias("b")).distinct()
    )]
    links = [found for found in [multiplied(done[0])] if found is not None]

    def labelled() -> DataFrame:
        both = reduce(DataFrame.union, links) if links else done[0].select("a", "b").limit(0)
        return components(spark, both, scratch)

    label = labelled()
    open_ = columns.select("h", "fp", "n", "at")
    of_open: DataFrame | None = None
    for round_ in range(len(CHOSEN) + 1):
        placed = scratch.keep(open_.join(label, F.col("fp") == F.col("node"), "left").select(
            "h", "fp", "n", "at", F.coalesce("component", "fp").alias("part")))
        apart = placed.groupBy("h").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y").select("h")
        kept = scratch.keep(placed.join(apart, "h", "left_semi"))
        scratch.drop(placed, of_open)
        open_ = of_open = kept
        separate, names = F.col("a_part") != F.col("b_part"), ("fp", "n", "at", "part")
        if round_ < len(CHOSEN):
            # one order of sets for all columns, so that columns with the same sets choose the same ones
            by_hash = Window.partitionBy("h").orderBy(F.xxhash64(F.lit(round_), "fp"), "fp")
            chosen = open_.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= CHOSEN[round_])
            right = open_
            once = F.col("a_fp") != F.col("b_fp")
        else:
            chosen = right = open_.join(sizes.select("fp", "bits"), "fp")
            names = (*names, "bits")
            n, m = F.col("a_n").cast("long"), F.col("b_n").cast("long")
            least = F.ceil(similarity * (n + m) / F.lit(100 + similarity)).cast("long")
            once = (F.col("a_fp") < F.col("b_fp")) & (differing("a_bits", "b_bits") <= n + m - 2 * least)
        left = chosen.select("h", *(F.col(c).alias(f"a_{c}") for c in names))
        right = right.select("h", *(F.col(c).alias(f"b_{c}") for c in names))
        pairs = (
            left.join(right, (left.h == right.h) & separate & possible("a_", "b_", similarity) & once)
            .select(F.least("a_fp", "b_fp").alias("a"), F.greatest("a_fp", "b_fp").alias("b")).distinct()
            .join(reduce(DataFrame.union, done), ["a", "b"], "left_anti")
        )
        pairs = scratch.keep(pairs)
        done.append(pairs)
        open_ = open_.drop("part")
        if pairs.isEmpty():
            continue
        if (more := multiplied(pairs)) is not None:
            links.append(more)
            label = labelled()
    if links:
        label = scratch.keep(label)
    scratch.drop(columns, sizes, of_open, *done, *links)
    return rows, label


def similarity_components(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = WORDS, similarity: int = SIMILARITY
) -> DataFrame:
    """Per document: its id, n_shingles, and component_id, the least id its links lead to."""
    rows, label = linked_sets(docs, id_col, text, k, similarity, Scratch(docs.sparkSession))
    classes = rows.where("fp is not null").groupBy("fp").agg(F.min("id").alias("least"))
    labelled = classes.join(label, classes.fp == label.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("part"))
    parts = labelled.groupBy("part").agg(F.min("least").alias("component_id"))
    found = labelled.join(parts, "part").select(F.col("fp").alias("key"), "component_id")
    return rows.join(found, rows.fp == found.key, "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"))


def with_marks(docs: DataFrame, text: str, k: int, fp: str, maybe: str, bitmap) -> DataFrame:
    """``docs`` with the fingerprint of each row's shingle set, and whether the bitmap may hold it; null and false without shingles."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            for low, high, _, _, count, prints in shingle_rows(column if pa.types.is_string(column.type) else column.cast(pa.string()), k):
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(prints.view(np.int64), mask=count == 0), pa.array(in_bitmap(bitmap.value, prints) & (count > 0))],
                    names=[*part.schema.names, fp, maybe])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType()), T.StructField(maybe, T.BooleanType())]))


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = WORDS, similarity: int = SIMILARITY
) -> DataFrame:
    """One row of each component: that with the least id, null ids last, and one of rows with the same id.

    A row without shingles is a component of its own. Texts of rows that are alone in their component are not
    moved: a bitmap of fixed size finds the others, and only those meet the table of kept rows. Columns
    may have any names.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows, label = linked_sets(docs, id_col, text, k, similarity, scratch)
    placed = rows.where("fp is not null").join(label, F.col("fp") == F.col("node"), "left").select(
        "id", "fp", F.coalesce("component", "fp").alias("part"))
    groups = placed.groupBy("part").agg(
        F.count("*").alias("size"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "fp")).alias("least")).where("size > 1")
    sets = scratch.keep(
        placed.select("fp", "part").distinct().join(groups, "part").select("fp", F.col("least.id").alias("least_id"), F.col("least.fp").alias("least_fp")))
    scratch.keep_only(sets)
    grouped = spark.sparkContext.broadcast(bitmap_of(sets.select("fp")))

    fresh = lambda name: name if name not in docs.columns else fresh(name + "_")
    fp, maybe, least_id, least_fp, place = (fresh(c) for c in ("set_fp", "maybe_grouped", "least_id", "least_fp", "row_place"))
    marked = with_marks(docs, text, k, fp, maybe, grouped)
    lookup = sets.select(F.col("fp").alias(fp), F.col("least_id").alias(least_id), F.col("least_fp").alias(least_fp))
    # a set that the bitmap lets through wrongly has one row, which stays
    candidates = marked.where(F.col(maybe)).join(lookup, fp, "left").where(F.col(least_fp).isNull() | (
        (F.col(fp) == F.col(least_fp)) & F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(least_id))))
    # rows of one id and one set are rows that repeat: the first by its text stays
    first = Window.partitionBy(fp).orderBy(F.xxhash64(F.col(f"`{text}`")), F.col(f"`{text}`"))
    chosen = candidates.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    own = [F.col(f"`{c}`") for c in docs.columns]
    return marked.where(~F.col(maybe)).select(*own).union(chosen.select(*own))
