"""What several of the operators share: scratch tables, texts as arrays, filters, components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.session import scratch_root, shuffles_released

U64 = np.uint64
#: Fixed odd constants of the hashes; any odd numbers do.
BASE = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

#: Bits of a membership bitmap (16 MiB). Its size never depends on the data: more keys make it
#: let more rows through to the exact join behind it, never fewer.
BITMAP_BITS = 1 << 27


# ---------------------------------------------------------------- scratch tables

def ship(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it (a cluster has it installed or as py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


class Scratch:
    """Tables written to the shared folder, so that lost executors cost no recomputation."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{scratch_root(spark)}/llm-{uuid.uuid4().hex}"
        self.paths: list[str] = []

    def keep(self, frame: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        with shuffles_released(self.spark):  # they serve nothing after this write
            frame.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(frame.schema).parquet(path)
        self.paths.append(path)
        out._scratch_path = path  # noqa: SLF001
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        """Remove tables that nothing lazy reads any more."""
        self._remove([f._scratch_path for f in frames if f is not None])  # noqa: SLF001

    def keep_only(self, *frames: DataFrame) -> None:
        """Remove all tables kept so far but these."""
        kept = {f._scratch_path for f in frames}  # noqa: SLF001
        self._remove([p for p in self.paths if p not in kept])

    def _remove(self, paths: list[str]) -> None:
        jvm = self.spark.sparkContext._jvm  # noqa: SLF001
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
        for name in paths:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        self.paths = [p for p in self.paths if p not in set(paths)]


#: Ids of dropped documents that may be broadcast; more are joined by a shuffle.
DROPPED_IDS = 1 << 18


def without(docs: DataFrame, id_col: str, dropped: DataFrame) -> DataFrame:
    """The documents whose id (null is one too) is not in the one column ``k`` of a written table; texts move only if it is long."""
    side = F.broadcast(dropped) if dropped.count() <= DROPPED_IDS else dropped
    return docs.alias("d").join(side.alias("f"), F.expr(f"d.`{id_col}` <=> f.k"), "left_anti")


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Arrow batches of at most ``size`` for what is written inside."""
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, size)
    try:
        yield
    finally:
        spark.conf.unset(ARROW_BYTES) if before is None else spark.conf.set(ARROW_BYTES, before)


# ---------------------------------------------------------------- texts as arrays


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes; a longer text is a run of its own."""
    low, rows = 0, len(bounds) - 1
    while low < rows:
        high = int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> U64(30))) * MIX_1
    x = (x ^ (x >> U64(27))) * MIX_2
    return x ^ (x >> U64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums whose differences are the rolling hashes of byte ranges, see ``range_hash``."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + U64(1)) * up[: len(data)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64) * MIX_2)


#: Fixed: the white space of the word contracts, x20 and x09 to x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Everything in ASCII that is neither letter nor digit.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[:128] = [not chr(b).isalnum() for b in range(128)]


def words(
    data: np.ndarray, bounds: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words and, per row, where its words begin (one more at the end)."""
    space = between[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    if len(data):
        firsts = bounds[:-1][bounds[:-1] < bounds[1:]]
        lasts = bounds[1:][bounds[:-1] < bounds[1:]] - 1
        before[firsts], after[lasts] = True, True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(
    data: np.ndarray, bounds: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word with A-Z lower-cased, and where the words of each row begin."""
    starts, ends, rows = words(data, bounds, between)
    return byte_hashes(_LOWER[data], starts, ends), rows


#: Longer words are hashed one by one.
_BLOCKWISE = 256


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per byte range, eight bytes at a time, every block mixed into what came before.

    A polynomial modulo 2**64 would give some different long words, such as those of Thue and Morse, one hash.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    windows = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    lengths = ends - starts
    out = lengths.astype(np.uint64) * MIX_2 + U64(BASE)
    open_ = np.flatnonzero((lengths > 0) & (lengths <= _BLOCKWISE))
    at, left, value = starts[open_], lengths[open_], out[open_]
    while len(open_):
        last = left <= 8
        rest = U64(64) - (np.minimum(left, 8) * 8).astype(np.uint64)
        value = (value ^ (windows[at] & (~U64(0) >> rest))) * MIX_1
        value ^= value >> U64(29)
        out[open_[last]] = value[last]
        more = ~last
        open_, at, left, value = open_[more], at[more] + 8, left[more] - 8, value[more]
    out = mix(out)
    for i in np.flatnonzero(lengths > _BLOCKWISE).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


_ODD = mix(np.arange(1, 65, dtype=np.uint64) * U64(BASE)) | U64(1)


def combine(hashes: np.ndarray, offsets: tuple[int, ...], count: int) -> np.ndarray:
    """One hash per start of the words at the given offsets, for the first ``count`` starts."""
    out = np.full(count, len(offsets), np.uint64)
    for i, at in enumerate(offsets):
        out += hashes[at : at + count] * _ODD[i % 64]
    return mix(out)


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle of ``k`` words; a row with fewer words has one of them all."""
    counts = np.diff(rows)
    total = max(len(hashes) - k + 1, 0)
    own = combine(hashes, tuple(range(k)), total)
    row_of_word = np.repeat(np.arange(len(counts)), counts)
    inside = row_of_word[:total] == row_of_word[k - 1 : k - 1 + total] if total else np.empty(0, bool)
    row, value = row_of_word[:total][inside], own[inside]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.array(
            [combine(hashes[rows[i] : rows[i + 1]], tuple(range(counts[i])), 1)[0] for i in short], np.uint64
        )
        row, value = np.concatenate([row, short]), np.concatenate([value, extra])
    return row, value


# ---------------------------------------------------------------- membership bitmaps


def bitmap_of(keys: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap that holds every value of the one long column of ``keys``.

    The executors or the words together; the driver gets at most ``bits / 64`` of them, so what
    it collects and broadcasts has the size of the bitmap whatever the number of keys.
    """
    name = keys.columns[0]

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words64 = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            column = batch.column(0).drop_null()
            at = slots(column.to_numpy(zero_copy_only=False), bits)
            np.bitwise_or.at(words64, at >> 6, U64(1) << (at & 63).astype(np.uint64))
        some = np.flatnonzero(words64)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int64)), pa.array(words64[some].view(np.int64))], names=["word", "bits"]
            )

    found = (
        keys.select(F.col(name).cast("long")).mapInArrow(marks, "word long, bits long")
        .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def slots(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(np.ascontiguousarray(values).view(np.uint64)) >> U64(1)).astype(np.int64) % bits


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = slots(values, len(bitmap) * 64)
    return (bitmap[at >> 6] >> (at & 63).astype(np.uint64) & U64(1)).astype(bool)


# ---------------------------------------------------------------- lists of bounded size


def most_frequent(counts: DataFrame, limit: int) -> tuple[pa.Table, bool]:
    """At most ``limit`` rows of ``counts``, no other row has a larger ``n``; and whether there are others.

    The bins by the logarithm of ``n`` are a few hundred rows whatever there is; the rows then come unsorted.
    """
    bin_ = F.floor(16 * F.log2("n")).cast("long")
    bins = counts.groupBy(bin_.alias("bin")).count().orderBy(F.desc("bin")).toArrow()
    sums = np.cumsum(bins.column("count").to_numpy())
    fit = int(np.searchsorted(sums, limit, side="right"))
    least = int(bins.column("bin")[fit - 1].as_py()) if fit else 1 << 20
    keys = [c for c in counts.columns if c != "n"]
    rows = counts.where(bin_ >= least).toArrow()
    return rows.sort_by([("n", "descending"), *((c, "ascending") for c in keys)]), fit < len(sums)


# ---------------------------------------------------------------- components


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of all nodes of the undirected edges (a, b); component is the least node.

    Each round points every node to its least neighbour, shortens the pointers and contracts the
    edges, so that the number of nodes at least halves; edges and pointers stay distributed.
    """
    current = scratch.keep(edges.where("a <> b").select("a", "b").distinct())
    maps: list[DataFrame] = []
    while not current.isEmpty():
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")).withColumnRenamed("a", "v")
        least = scratch.keep(least)
        second = least.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        pointer = scratch.keep(
            least.join(second, "p").select("v", F.col("pp").alias("p"))
        )
        to_a = pointer.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        to_b = pointer.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        shorter = current.join(to_a, "a").join(to_b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        own = pointer.join(to_a.withColumnRenamed("a", "p"), "p").select(F.col("p").alias("a"), F.col("pa").alias("b"))
        nxt = scratch.keep(shorter.union(own).where("a <> b").distinct())
        scratch.drop(least, current)
        maps.append(pointer)
        current = nxt
    if not maps:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = maps[-1].select(F.col("v").alias("node"), F.col("p").alias("component"))
    for pointer in reversed(maps[:-1]):
        later = out.select(F.col("node").alias("p"), "component")
        out = scratch.keep(
            pointer.join(later, "p", "left").select(
                F.col("v").alias("node"), F.coalesce("component", "p").alias("component")
            )
        )
    return out
