"""Token-id output: an adaptive context-mixing range coder in checksummed blocks.

File format. A table of segments in Parquet; a segment holds whole documents in ascending id
order: ``doc_ids``, ``lengths`` (ids of each document with its end id) and ``payload``. The
payload is a run of blocks of ``BLOCK`` ids (the last may be shorter), each

    magic "TB1\\n" | ids (uint32) | payload words (uint32) | crc32 of the ids | crc32 of the words | words (uint16)

all little-endian. A block starts with an empty model, so any block can be read alone.

Model. The id last seen after the two previous ids (order 2) and after the previous id (order 1)
are predicted with the hit rates of their confidence level; where both predict the same id, the
two rates are mixed by their evidence; the rest goes to order 0, which predicts the bit length of
the id by adaptive counts and takes its lower bits as they are. The mixture drives a 64-bit
carryless range coder. All arithmetic is on integers, so every machine decodes what another one
wrote. The blocks of a segment are coded side by side, one numpy lane each.

Defined cases: a null or empty text is its end id alone; documents come in ascending id order,
null ids first, repeated ids next to each other in no fixed order; an empty table gives no
segment; a document longer than a segment makes a longer segment of its own.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscope.llm.bpe import _PLAIN, Coder, default_tokenizer
from subscope.llm.common import Scratch

BLOCK = 1024
SEGMENT = 1 << 23
MAGIC = b"TB1\n"
HEADER = struct.Struct("<4sIIII")
END_ID = 0

# ---------------------------------------------------------------- ids of texts

#: White space of plain texts beside the space and the line feed.
_RARE = "\t\x0b\x0c\r"
#: The end of the tokenizer's pattern; only where two white-space characters meet does it differ from ``\\s``.
_BLANKS = r"|\s+(?!\S)|\s+"


def blanks_meet(text: str) -> bool:
    """Whether two white-space characters of a plain text meet, or it holds one of the rare ones."""
    if "  " in text or any(c in text for c in _RARE):
        return True
    lines = text.split("\n")
    return ("" in lines[1:-1] or any(line[:1] == " " for line in lines[1:])
            or any(line[-1:] == " " for line in lines[:-1]))


class WordMemory:
    """The library's ids of texts, by the faster encoder of ``bpe`` wherever it gives the same.

    No word is remembered: most distinct words of a corpus are met once, so that keeping and looking
    them up took longer than encoding every text as it comes. Plain texts whose white space stands
    alone are split by the pattern without its look-ahead, and their ids come as an array, not as a list.
    """

    _kept: dict[str, WordMemory] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.coder = Coder.at(path)
        self.single = self._single() if self.coder.fast else None

    @classmethod
    def at(cls, path: str) -> WordMemory:
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def _single(self) -> Callable[[str], np.ndarray] | None:
        import public_tokenizers
        import tiktoken

        pattern, special = public_tokenizers.PATTERN, self.coder.special
        if not pattern.endswith(_BLANKS):
            return None
        ranks = {token: i for i, token in self.coder.bytes_of.items() if i not in special.values()}
        # without any special token this call would look for an empty one at each character
        return partial(tiktoken.Encoding(
            "single", pat_str=pattern.removesuffix(_BLANKS) + r"|\s", mergeable_ranks=ranks, special_tokens=special
        ).encode_to_numpy, allowed_special=frozenset(), disallowed_special=())

    def encode(self, text: str) -> bytes:
        plain = text.isascii() or _PLAIN.fullmatch(text)
        if self.single is None or not plain or blanks_meet(text) or any(t in text for t in self.coder.special):
            return self.coder.encode(text.encode())
        return self.single(text).astype("<u4", copy=False).tobytes()


# ---------------------------------------------------------------- range coder on lanes

_TOP, _BOT = np.uint64(1 << 48), np.uint64(1 << 32)
_S16 = np.uint64(16)
_SLOTS = 1024
_LEVELS = 4
_CLASSES = 18  # bit lengths 0 to 17; longer ids are refused
_RESERVE = 2048  # of 65536: what the order-0 model always keeps


class Lanes:
    """The model state of blocks coded side by side; encoder and decoder update it alike.

    The first half of an array is order 2, the second is order 1, so that one call serves both. Shares are whole numbers
    in doubles, whose division is the faster one: every product stays below 2**53, so its floor is exact.
    """

    def __init__(self, n: int):
        self.n, self.row = n, np.arange(n)
        self.slots = np.arange(2 * n) * _SLOTS
        self.cells = np.arange(2 * n) * 8
        self.memory = np.full(2 * n * _SLOTS, -8 + _LEVELS, np.int32)  # 8 times the id last seen (-1: none), and its level
        # hits (upper half) and uses (lower half) of each level; cells of places without an id never hit
        self.rates = np.tile(np.repeat(np.array([8 << 16 | 32, 1], np.int32), [_LEVELS, 8 - _LEVELS]), 2 * n)
        counts = np.full(_CLASSES, 4)
        counts[8:17] = 32
        # twice the running counts of the order-0 classes, one column a lane; their sum stays below the reserve
        self.ends = np.zeros((_CLASSES + 1, n), np.int16)
        self.ends[1:] = 2 * np.cumsum(counts)[:, None]
        self.flat, self.total = self.ends.reshape(-1), self.ends[-1].astype(np.float64)
        self.under = np.array([[0], [n]]) + self.row
        self.step = np.empty((_CLASSES, n), np.int16)
        self.context = np.zeros(2 * n, np.int64)  # the last two ids and the last one, hashed
        self.last = np.zeros(n, np.int32)

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Guesses and shares (of 65536) of order 2 and order 1."""
        n = self.n
        self.slot = self.context & (_SLOTS - 1)
        self.slot += self.slots
        self.entry = self.memory.take(self.slot)
        self.guess = self.entry >> 3
        self.cell = self.cells + (self.entry & 7)
        self.rate = self.rates.take(self.cell)
        hits, uses = (self.rate >> 16).astype(np.float64), (self.rate & 0xFFFF).astype(np.float64)
        hit2, hit1, uses2, uses1 = hits[:n], hits[n:], uses[:n], uses[n:]
        both = (self.guess[:n] == self.guess[n:]).astype(np.float64)
        free = 65536.0 - _RESERVE
        share2 = np.floor((hit2 + hit1 * both) * free / (uses2 + uses1 * both))
        share1 = np.floor((free - share2) * hit1 * (1.0 - both) / uses1)
        return self.guess[:n], self.guess[n:], share2, share1

    def interval(self, width: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of order-0 classes within the share that is left for them."""
        below, above = np.floor(self.flat.take(self.under + width * self.n) * rest / self.total)
        return below, above - below

    def learn(self, ids: np.ndarray, width: np.ndarray, missed: np.ndarray) -> None:
        n = self.n
        right = self.guess.reshape(2, n) == ids
        self.rate += right.reshape(-1) * np.int32(32 << 16)
        self.rate += np.int32(32)
        full = ((self.rate & 0xFFFF) > 4096).nonzero()[0]
        if len(full):
            old = self.rate[full]
            self.rate[full] = (old >> 16) + 1 >> 1 << 16 | (old & 0xFFFF) + 1 >> 1
        self.rates[self.cell] = self.rate
        fresh = ids << 3
        self.entry += 1
        entry = np.where(right, np.minimum(self.entry.reshape(2, n), fresh | (_LEVELS - 1)), fresh)
        self.memory[self.slot] = entry.reshape(-1)

        full = ((self.ends[-1] > 2 * (_RESERVE - 32)) & missed).nonzero()[0]
        np.subtract(np.where(missed, width, _CLASSES).astype(np.int16), _CLASS, out=self.step)
        self.step &= 32  # 32 where the class lies above the id's, else 0
        self.ends[1:] += self.step
        if len(full):
            ends = self.ends.take(full, axis=1)
            halves = (ends[1:] - ends[:-1] + 2) >> 2
            self.flat[full + n * np.arange(1, _CLASSES + 1)[:, None]] = 2 * np.add.accumulate(halves, axis=0)
        self.total = self.ends[-1].astype(np.float64)
        mixed = ids * np.int32(40503)
        self.context[:n] = (mixed + self.last * np.int32(30011)) >> 3
        self.context[n:] = mixed >> 4
        self.last = ids


_CLASS = np.arange(1, _CLASSES + 1, dtype=np.int16)[:, None]
_LENGTH = np.frexp(np.arange(1 << 17, dtype=np.float64))[1].astype(np.int8)  # bit length of every id
_RAW = np.maximum(np.arange(_CLASSES) - 1, 0)  # lower bits of an id of each bit length


def due(low: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Whether the upper word is settled, or the span too narrow to go on."""
    return ((low ^ (low + span)) < _TOP) | (span < _BOT)


def shortened(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that are due, cut off at the next border where their upper word is not settled."""
    settled = (low ^ (low + span)) < _TOP
    return low, np.where(settled, span, (~low + np.uint64(1)) & (_BOT - np.uint64(1)))


def normalise(
    low: np.ndarray, span: np.ndarray, some: Callable[[np.ndarray], None], every: Callable[[np.ndarray], None]
) -> None:
    """Move the upper word out of every lane that is due, until none is.

    Only narrow spans can be due twice or be cut, so only they go round. ``some`` passes on a word of the given lanes,
    ``every`` one of each lane whose number of bits to move is not zero.
    """
    ready = (span < _BOT).nonzero()[0]
    while len(ready):
        own, width = shortened(low[ready], span[ready])
        some(ready)
        low[ready], span[ready] = own, width = own << _S16, width << _S16
        ready = ready[due(own, width)]
    bits = (((low + span) ^ low) < _TOP) * _S16
    every(bits)
    low <<= bits
    span <<= bits


# The words of the lanes lie side by side, ``_S16`` lanes to a tile, so that a lane's next word is as many
# places on as its range moves bits.


def tiled(words: np.ndarray) -> np.ndarray:
    """A row of words per lane as tiles; the number of lanes is a multiple of 16."""
    return np.ascontiguousarray(words.reshape(-1, 16, words.shape[1]).transpose(0, 2, 1)).reshape(-1)


def untiled(tiles: np.ndarray, high: int, used: int) -> np.ndarray:
    """A row of the first words per lane, from tiles of ``high`` words a lane."""
    return np.ascontiguousarray(tiles.reshape(-1, high, 16)[:, :used].transpose(0, 2, 1)).reshape(-1, used)


def places(n: int, high: int) -> np.ndarray:
    """Where the first word of each lane lies in tiles of ``high`` words a lane."""
    lane = np.arange(n)
    return (lane >> 4) * (16 * high) + (lane & 15)


def encode_blocks(ids: np.ndarray) -> bytes:
    """All blocks of a run of ids, one after the other."""
    if len(ids) == 0:
        return b""
    if ids.min() < 0 or ids.max() >= 1 << 17:
        raise ValueError("ids must lie between 0 and 131071")
    n = -(-len(ids) // BLOCK)
    flat = np.zeros(n * BLOCK, np.int32)
    flat[: len(ids)] = ids
    grid = np.ascontiguousarray(flat.reshape(n, BLOCK).T)
    last = len(ids) - (n - 1) * BLOCK
    lanes = Lanes(n)
    low, span = np.zeros(n, np.uint64), np.full(n, np.iinfo(np.uint64).max, np.uint64)
    high = BLOCK * 4 + 16
    first = places(n, high)
    out, place = np.zeros(-(-n // 16) * 16 * high, np.uint16), first.copy()

    def some(lane: np.ndarray) -> None:
        out[place[lane]] = low[lane] >> np.uint64(48)
        place[lane] += 16

    def every(bits: np.ndarray) -> None:  # a word that is not moved out is replaced by the lane's next one
        out[place] = (low >> np.uint64(48)).astype(np.uint16)
        np.add(place, bits.view(np.int64), out=place)

    end = None
    for step in range(BLOCK if n > 1 else last):
        if step == last:  # the last block ends here; its lane idles on
            end = low[-1], place[-1]
        now = grid[step]
        guess2, guess1, share2, share1 = lanes.predict()
        hit2 = guess2 == now
        hit1 = ((guess1 == now) & (share1 > 0)) > hit2
        missed = ~(hit2 | hit1)
        width = _LENGTH.take(now).astype(np.int64)
        both = share2 + share1
        below, size = lanes.interval(width, 65536.0 - both)
        start = np.where(hit2, 0.0, np.where(hit1, share2, both + below))
        size = np.where(hit2, share2, np.where(hit1, share1, size))
        unit = span >> _S16
        low += unit * start.astype(np.uint64)
        np.multiply(unit, size.astype(np.uint64), out=span)
        normalise(low, span, some, every)
        bits = _RAW.take(width) * missed
        span >>= bits.view(np.uint64)
        low += span * (now & ((1 << bits) - 1)).view(np.uint64)
        normalise(low, span, some, every)
        lanes.learn(now, width, missed)
    if end:
        low[-1], place[-1] = end
    for _ in range(4):
        out[place] = (low >> np.uint64(48)).astype(np.uint16)
        place += 16
        low <<= _S16
    used = (place - first) >> 4
    words = untiled(out, high, used.max()).astype("<u2", copy=False)
    whole = flat.astype("<u4", copy=False)
    parts = []
    for i, count in enumerate(used.tolist()):
        body = words[i, :count].tobytes()
        own = whole[i * BLOCK : min((i + 1) * BLOCK, len(ids))]
        parts += [HEADER.pack(MAGIC, len(own), count, zlib.crc32(own), zlib.crc32(body)), body]
    return b"".join(parts)


def decode_blocks(payload: bytes) -> np.ndarray:
    """The ids of a run of blocks; a damaged block raises ValueError."""
    at, heads, bodies = 0, [], []
    while at < len(payload):
        magic, size, used, ids_crc, body_crc = HEADER.unpack_from(payload, at)
        body = payload[at + HEADER.size : at + HEADER.size + 2 * used]
        if magic != MAGIC or size > BLOCK or zlib.crc32(body) != body_crc:
            raise ValueError(f"damaged block at byte {at}")
        heads.append((size, ids_crc))
        bodies.append(np.frombuffer(body, "<u2"))
        at += HEADER.size + 2 * used
    n = len(heads)
    if not n:
        return np.empty(0, np.int64)
    sizes = np.array([s for s, _ in heads])
    high = max(map(len, bodies)) + 8
    padded = np.zeros((-(-n // 16) * 16, high), np.uint16)
    for i, body in enumerate(bodies):
        padded[i, : len(body)] = body
    words, place = tiled(padded), places(n, high)
    lanes = Lanes(n)
    low, span = np.zeros(n, np.uint64), np.full(n, np.iinfo(np.uint64).max, np.uint64)
    code = np.zeros(n, np.uint64)  # counted from low
    for _ in range(4):
        code = code << _S16 | words[place]
        place += 16

    def some(lane: np.ndarray) -> None:
        code[lane] = code[lane] << _S16 | words.take(place[lane], mode="clip")
        place[lane] += 16

    def every(bits: np.ndarray) -> None:
        np.left_shift(code, bits, out=code)
        np.bitwise_or(code, words.take(place, mode="clip") * (bits > 0), out=code)
        np.add(place, bits.view(np.int64), out=place)

    grid = np.empty((int(sizes.max()), n), np.int32)
    for now in grid:  # a lane whose block has ended idles on
        guess2, guess1, share2, share1 = lanes.predict()
        both = share2 + share1
        rest = 65536.0 - both
        unit = span >> _S16
        point = np.minimum(code // unit, np.uint64(65535)).astype(np.float64)
        hit2 = point < share2
        missed = point >= both
        hit1 = ~(hit2 | missed)
        target = ((np.maximum(point - both, 0.0) + 1.0) * lanes.total - 2.0) / rest
        under = lanes.ends[1:-1] <= target.astype(np.int16)
        width = np.add.reduce(under.view(np.int8), axis=0, dtype=np.int8).astype(np.int64)
        below, size = lanes.interval(width, rest)
        start = np.where(hit2, 0.0, np.where(hit1, share2, both + below))
        size = np.where(hit2, share2, np.where(hit1, share1, size))
        used = unit * start.astype(np.uint64)
        low += used
        code -= used
        np.multiply(unit, size.astype(np.uint64), out=span)
        normalise(low, span, some, every)
        bits = _RAW.take(width) * missed
        span >>= bits.view(np.uint64)
        lower = np.minimum(code // span, ((1 << bits) - 1).view(np.uint64))
        used = span * lower
        low += used
        code -= used
        normalise(low, span, some, every)
        fresh = (((width > 0) << bits) + lower.view(np.int64)).astype(np.int32)
        now[:] = np.where(hit2, guess2, np.where(hit1, guess1, fresh))
        lanes.learn(now, width, missed)
    keep = np.arange(len(grid))[None, :] < sizes[:, None]
    whole, first = np.ascontiguousarray(grid.T)[keep].astype("<u4", copy=False), 0
    for size, crc in heads:
        if zlib.crc32(whole[first : first + size]) != crc:
            raise ValueError("ids do not match their checksum")
        first += size
    return whole.astype(np.int64)


# ---------------------------------------------------------------- segments

SEGMENTS = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("segment", T.LongType()),
    T.StructField("ids", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType()),
])


def write_token_files(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None,
    partitions: int | None = None,
) -> None:
    """Encode all texts and write their segments in ascending id order below ``folder``."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memory, part, number = WordMemory.at(path), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        runs: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            lengths, ids = [len(r) // 4 for r in runs], np.frombuffer(b"".join(runs), "<u4")
            runs.clear()
            row = {"part": part, "segment": number, "ids": len(ids), "doc_ids": list(doc_ids),
                   "lengths": lengths, "payload": encode_blocks(ids)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = memory.encode(whole.as_py() or "") + struct.pack("<I", END_ID)
                doc_ids.append(doc)
                runs.append(ids)
                held += len(ids) // 4
                if held >= SEGMENT:
                    yield flush()
                    doc_ids, runs, held, number = [], [], 0, number + 1
        if runs:
            yield flush()

    schema = pa.schema([("part", pa.int64()), ("segment", pa.int64()), ("ids", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    ranged = rows.repartitionByRange(partitions, "id") if partitions else rows.repartitionByRange("id")
    (ranged.sortWithinPartitions("id").mapInArrow(run, SEGMENTS)
        .write.option("compression", "uncompressed").mode("overwrite").parquet(folder))


def read_token_files(spark, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids, ids_crc32) of every document, decoded from the files below ``folder``.

    Without ``with_ids`` the ids are decoded all the same but stay in the task: ``ids`` is left out.
    """
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    totals = sorted(map(tuple, segments.select("part", "segment", "ids").collect()))  # one small row per segment file part
    starts: dict[tuple[int, int], int] = {}
    done = 0
    for part, segment, ids in totals:
        starts[part, segment] = done
        done += ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_blocks(row["payload"]).astype("<u4", copy=False)
                ends = np.cumsum(row["lengths"])
                firsts = ends - row["lengths"]
                raw = [ids[a:b].tobytes() for a, b in zip(firsts.tolist(), ends.tolist(), strict=True)]
                start = starts[row["part"], row["segment"]] + firsts
                own = {"doc_id": pa.array(row["doc_ids"], pa.int64()), "start": pa.array(start, pa.int64()),
                       "n_tokens": pa.array(row["lengths"], pa.int64())}
                if with_ids:
                    own["ids"] = pa.array(raw, pa.binary())
                own["ids_crc32"] = pa.array([zlib.crc32(r) for r in raw], pa.int64())
                yield pa.RecordBatch.from_pydict(own)

    return segments.mapInArrow(
        run, f"doc_id long, start long, n_tokens long,{' ids binary,' * with_ids} ids_crc32 long")


def files_round_trip(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                     partitions: int | None = None) -> DataFrame:
    """Write the files to the shared folder, read them back and describe each document."""
    spark = docs.sparkSession
    folder = f"{Scratch(spark).folder}/tokens"
    write_token_files(docs, folder, id_col, text, tokenizer, partitions)
    return read_token_files(spark, folder, with_ids=False)
