"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over 16 bytes cuts every text into chunks whose borders depend on content alone,
so passages that documents share fall into the same chunks. A chunk is encoded once per task and
reused (a store of bounded bytes); what differs from the encoding of the whole text can lie only
at the joins. A join is repaired by re-encoding from the last *agreement point* of the left chunk
to the first of the right one, further out while there is none. An agreement point is a space
after a visible ASCII character: the pre-tokenizer never puts the two into one piece, pieces left
of it do not look past a space, and pieces right of it start there whatever stands before. The
ids are therefore those of the whole text.

Two encoders give the same ids: the tokenizers library, and tiktoken on ranks made from the same
file, which is faster. tiktoken gets only pieces of ASCII and Latin letters without a special
token, where the two libraries' character classes cannot differ.

Defined cases: null and empty texts have no ids and decode to an empty text; a text without any
agreement point is encoded whole; repeated rows give one result each; other columns are ignored.
"""

from __future__ import annotations

import array
import hashlib
import json
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.common import pieces, powers, prefix_hash, strings

WINDOW = 16
#: A chunk ends where the rolling hash has this many high bits zero: 512 bytes on average.
CUT_BITS = 9
SLICE_BYTES = 2 << 20
#: Bytes of stored chunks after which a task starts its store anew.
STORE_BYTES = 48 << 20

_PLAIN = re.compile(r"[\x00-\x7f¡-ɏ]*")
_AGREE = re.compile(rb"[!-~](?= )")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: visible Latin-1 as it is, the rest from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Coder:
    """The tokenizer of one file, kept per worker process."""

    _kept: dict[str, Coder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        stand_in = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.bytes_of = {
            i: bytes(stand_in[c] for c in token) for token, i in vocab.items() if all(c in stand_in for c in token)
        }
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.fast = self._fast(spec, vocab)
        self.texts = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.store: dict[bytes, tuple] = {}
        self.stored = 0

    @classmethod
    def at(cls, path: str) -> Coder:
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def _fast(self, spec: dict, vocab: dict[str, int]) -> Callable[[str], list[int]] | None:
        """tiktoken on the same ranks, if the ids stand in the order of the merges."""
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if merged != sorted(merged) or spec.get("normalizer") or spec["model"].get("ignore_merges"):
            return None
        import public_tokenizers
        import tiktoken

        ranks = {self.bytes_of[i]: i for i in vocab.values() if i not in self.special.values()}
        return tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def encode(self, text: bytes) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        plain = text.decode("utf-8")
        if self.fast and _PLAIN.fullmatch(plain) and not any(t in plain for t in self.special):
            ids = self.fast(plain)
        else:
            ids = self.library.encode(plain, add_special_tokens=False).ids
        out = array.array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def chunk(self, text: bytes) -> tuple[bytes, bytes, bytes, bytes] | None:
        """(text before the first agreement point, ids between first and last, their text, text after)."""
        entry = self.store.get(text, False)
        if entry is not False:
            return entry
        entry = None
        if first := _AGREE.search(text):
            low, high = first.end(), text.rfind(b" ")
            while not 33 <= text[high - 1] <= 126:
                high = text.rfind(b" ", 0, high)
            ids = self.encode(text[low:high])
            entry = (text[:low], ids, self.decode(ids), text[high:])
        self.stored += 2 * len(text) + 400
        if self.stored > STORE_BYTES:
            self.store, self.stored = {}, 0
        self.store[text] = entry
        return entry

    def whole(self, text: bytes, cuts: list[int]) -> tuple[bytes, bytes]:
        """Ids and decoded bytes of a text cut at the given places."""
        ids, decoded, join, low = [], [], b"", 0
        for cut in [*cuts, len(text)]:
            part = text[low:cut]
            low = cut
            entry = self.chunk(part)
            if entry is None:  # no agreement point: the join reaches further
                join += part
                continue
            head, own, own_text, tail = entry
            repaired = self.encode(join + head)
            ids += (repaired, own)
            decoded += (self.decode(repaired), own_text)
            join = tail
        repaired = self.encode(join)
        ids.append(repaired)
        decoded.append(self.decode(repaired))
        return b"".join(ids), b"".join(decoded)


def chunk_cuts(data: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """Per text, the places where its chunks end, counted from its start; a text's end is none."""
    n = max(len(data) - WINDOW + 1, 0)
    sums = prefix_hash(data)
    rolling = (sums[WINDOW:] - sums[:-WINDOW]) * powers(n + 1)[1][:n] if n else sums[:0]
    cuts = np.flatnonzero(rolling >> np.uint64(64 - CUT_BITS) == 0) + WINDOW
    row = np.searchsorted(bounds, cuts, side="left") - 1
    inside = (cuts - WINDOW >= bounds[row]) & (cuts < bounds[row + 1])
    cuts, row = cuts[inside], row[inside]
    first = np.searchsorted(row, np.arange(len(bounds)))
    local = (cuts - bounds[row]).tolist()
    return [local[first[i] : first[i + 1]] for i in range(len(bounds) - 1)]


def encode_texts(coder: Coder, column: pa.Array) -> Iterator[tuple[bytes, bytes]]:
    """(ids, decoded bytes) of each text of an Arrow column."""
    data, bounds = strings(column)
    for low, high in pieces(bounds, SLICE_BYTES):
        part = data[bounds[low] : bounds[high]]
        raw, own = part.tobytes(), bounds[low : high + 1] - bounds[low]
        for i, cuts in enumerate(chunk_cuts(part, own)):
            yield coder.whole(raw[own[i] : own[i + 1]], cuts)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def encode(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """(id, ids): the token ids of each text as little-endian unsigned 32-bit integers."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.at(path)
        for batch in batches:
            ids = [x for x, _ in encode_texts(coder, batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def round_trip(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the text they decode to."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.at(path)
        for batch in batches:
            count, ids_sha, text_sha = [], [], []
            for ids, decoded in encode_texts(coder, batch.column(1)):
                count.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
