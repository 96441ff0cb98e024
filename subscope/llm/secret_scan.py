"""Secret scan: fixed patterns, and a battery of randomness tests with false-discovery control.

Base patterns (assign, access, hex) are found exactly. Beyond them every run of 20 or more token
characters whose encoding can be inferred (hex, base32, base64) is tested against the hypothesis
"uniformly random letters of that alphabet": chi-squared uniformity, runs about the middle of the
alphabet, lag-1 serial correlation; Fisher's sum combines the three. Random tokens have uniform
p-values, words and identifiers pile up near zero. Per encoding and length class the share of
random tokens is read off the upper half of the p-values (one histogram of fixed size over the
distinct tokens of all documents, so that copies count once), and the lowest cut is taken at which the estimated share of ordinary tokens among
the accepted ones stays below ``fdr``.

Defined cases: null or empty text gives no spans; a null ``doc_id`` is passed on; repeated rows
give one result each; other columns are ignored; an empty table gives an empty result. Spans of
the battery that overlap a base span are left out, base spans always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.common import pieces, strings

#: Fixed values of the base patterns; the flags A and I together fold the case of ASCII letters only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

TOKEN_MIN = 20
FDR = 0.1
BINS = 50
#: Upper ends of the length classes.
LENGTHS = (32, 48, 96)
#: Tokens a task remembers, so that most copies stay in it.
TOLD = 200_000
#: Bytes of texts looked at together; the arrays made for them take a multiple of that.
SLICE_BYTES = 2 << 20
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
ENCODINGS = tuple(ALPHABETS)
_INDEX = {name: {c: i for i, c in enumerate(chars)} for name, chars in ALPHABETS.items()}

_CLASS = np.zeros(256, np.uint8)  # 1 digit, 2 upper, 3 lower, 4 other token characters
for _kind, _chars in enumerate((b"0123456789", bytes(range(65, 91)), bytes(range(97, 123)), b"+/_-="), 1):
    _CLASS[list(_chars)] = _kind


def infer(token: str) -> str | None:
    """The narrowest encoding a token can be in; one kind of character alone is no encoding."""
    body = token.rstrip("=")
    digit = any(c.isdigit() for c in body)
    upper = any(c.isupper() for c in body)
    lower = any(c.islower() for c in body)
    if digit + upper + lower < 2:
        return None
    if not (upper and lower) and digit and all(c in _INDEX["hex"] for c in body.lower()):
        return "hex"
    if upper and digit and all(c in _INDEX["base32"] for c in body):
        return "base32"
    return "base64"


def battery(token: str, encoding: str) -> float:
    """Fisher's combination of the three tests: the p-value of "uniformly random"."""
    body = token.rstrip("=")
    body = body.lower() if encoding == "hex" else body.replace("-", "+").replace("_", "/")
    at = np.array([_INDEX[encoding][c] for c in body], float)
    n, size = len(at), len(ALPHABETS[encoding])
    counts = np.bincount(at.astype(int), minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    scaled = (size - 1) + (chi - (size - 1)) / math.sqrt(max(1 - 1 / n, 1e-9))
    cube = (max(scaled, 1e-9) / (size - 1)) ** (1 / 3)  # Wilson and Hilferty
    z = (cube - (1 - 2 / (9 * (size - 1)))) / math.sqrt(2 / (9 * (size - 1)))
    uniform = 0.5 * math.erfc(z / math.sqrt(2))
    high = at >= size / 2
    up = int(high.sum())
    down = n - up
    if up and down:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * up * down / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        runs_p = math.erfc(abs(runs - mean) / math.sqrt(2 * spread)) if spread > 0 else 1.0
    else:
        runs_p = 2.0 ** (1 - n)
    centred = at - at.mean()
    power = float((centred**2).sum())
    if power:
        serial = float((centred[1:] * centred[:-1]).sum()) / power
        serial_p = math.erfc(abs(serial + 1 / n) * math.sqrt(n) / math.sqrt(2))
    else:
        serial_p = 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, runs_p, serial_p))
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def cell_of(encoding: str, length: int) -> int:
    return ENCODINGS.index(encoding) * (len(LENGTHS) + 1) + sum(length > x for x in LENGTHS)


def _candidates(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end (bytes) of the token runs worth testing, and the rows with a long hex run."""
    kind = _CLASS[data]
    token = np.empty(len(data) + 1, bool)
    token[:-1], token[-1] = kind > 0, False
    before = np.zeros(len(data) + 1, bool)
    before[1:] = token[:-1]
    before[bounds[:-1]] = False  # runs never cross texts
    starts = np.flatnonzero(token & ~before)
    stop = ~token
    stop[bounds[1:-1]] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="right")] if len(starts) else starts
    long = ends - starts >= TOKEN_MIN
    starts, ends = starts[long], ends[long]
    kinds = []
    for x in (1, 2, 3):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind == x, out=total[1:])
        kinds.append(total[ends] > total[starts])
    mixed = sum(k.astype(int) for k in kinds) >= 2
    rows = np.searchsorted(bounds, starts, side="right") - 1
    return rows[mixed], starts[mixed], ends[mixed], np.unique(rows)


def base_spans(text: str, low_has_word: bool, long_run: bool) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, sorted."""
    out = []
    if low_has_word:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    if long_run:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _scan(column: pa.Array) -> Iterator[tuple[str, list[tuple[int, int, int]], list[tuple[int, int, int, float]]]]:
    """Per text: the text, its base spans, and (start, end, cell, p) of the tokens tested."""
    data, bounds = strings(column)
    for low, high in pieces(bounds, SLICE_BYTES):
        yield from _scan_slice(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])


def _scan_slice(
    data: np.ndarray, bounds: np.ndarray
) -> Iterator[tuple[str, list[tuple[int, int, int]], list[tuple[int, int, int, float]]]]:
    rows, starts, ends, long_rows = _candidates(data, bounds)
    long_runs = set(long_rows.tolist())
    by_row: dict[int, list[tuple[int, int]]] = {}
    for row, start, end in zip(rows.tolist(), starts.tolist(), ends.tolist(), strict=True):
        by_row.setdefault(row, []).append((start - int(bounds[row]), end - int(bounds[row])))
    raw = data.tobytes()
    for row in range(len(bounds) - 1):
        own = raw[bounds[row] : bounds[row + 1]]
        lower = own.lower()
        long_run = row in long_runs
        has_word = any(w.encode() in lower for w in ASSIGN_WORDS)
        if not (has_word or long_run or b"AKIA" in own):
            yield own.decode(), [], []
            continue
        text = own.decode()
        base = base_spans(text, has_word, long_run)
        tested = []
        for start, end in by_row.get(row, ()):
            token = own[start:end].decode()
            if encoding := infer(token):
                if len(token.rstrip("=")) < TOKEN_MIN or "=" in token.rstrip("="):
                    continue
                at = len(own[:start].decode())
                tested.append((at, at + len(token), cell_of(encoding, len(token)), battery(token, encoding)))
        yield text, base, tested


def fit_cuts(docs: DataFrame, text: str = "text", fdr: float = FDR) -> dict[int, int]:
    """The lowest accepted p-value bin of each cell, from a histogram over the distinct tokens of all documents."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[bytes] = set()
        for batch in batches:
            token, cells, bins = [], [], []
            for whole, _, tested in _scan(batch.column(0)):
                for start, end, cell, p in tested:
                    digest = hashlib.blake2b(whole[start:end].encode(), digest_size=16).digest()
                    if digest in told:
                        continue
                    told.add(digest)
                    token.append(digest)
                    cells.append(cell)
                    bins.append(min(int(p * BINS), BINS - 1))
            if len(told) > TOLD:
                told.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(token, pa.binary()), pa.array(cells, pa.int64()), pa.array(bins, pa.int64())],
                names=["token", "cell", "bin"])

    rows = (
        docs.select(F.col(text).cast("string")).mapInArrow(distinct, "token binary, cell long, bin long").distinct()
        .groupBy("cell", "bin").agg(F.count("*").alias("n")).collect()  # at most cells x bins rows
    )
    counts = np.zeros((len(ENCODINGS) * (len(LENGTHS) + 1), BINS))
    for cell, bin_, n in rows:
        counts[cell, bin_] = n
    return {cell: cut for cell in range(len(counts)) if (cut := lowest_cut(counts[cell], fdr)) is not None}


def lowest_cut(counts: np.ndarray, fdr: float) -> int | None:
    """Storey's estimate: random tokens fill all bins alike, at the height of the upper half."""
    height = counts[BINS // 2 :].mean()
    if not counts.sum() or not height:
        return None
    for cut in range(BINS):
        accepted = counts[cut:].sum()
        if accepted and 1 - min(1.0, height * (BINS - cut) / accepted) <= fdr:
            return cut
    return None


def _spans(base: list, tested: list, cuts: dict[int, int]) -> list[tuple[int, int, int]]:
    extra = [
        (start, 3, end)
        for start, end, cell, p in tested
        if cell in cuts and min(int(p * BINS), BINS - 1) >= cuts[cell]
        and not any(start < e and s < end for s, _, e in base)
    ]
    return sorted(base + extra)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", cuts: dict[int, int] | None = None, fdr: float = FDR
) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, all spans."""
    cuts = fit_cuts(docs, text, fdr) if cuts is None else cuts

    def say(spans: list) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")}
            for _, base, tested in _scan(batch.column(1)):
                spans = _spans(base, tested, cuts)
                for kind, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(sum(k == kind for _, k, _ in base))
                out["base_sha256"].append(hashlib.sha256(say(base).encode()).hexdigest())
                out["spans"].append(say(spans))
                out["n_random"].append(len(spans) - len(base))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(out[n], pa.string() if n in ("base_sha256", "spans") else pa.int64())
                                    for n in out)], names=[id_col, *out])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    )


def redact_secrets(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """The same rows and columns with every found span replaced by ``mask``; a null text stays null."""
    cuts = fit_cuts(docs, text, fdr)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for whole, base, tested in _scan(batch.column(at)):
                parts, done = [], 0
                for start, _, end in _spans(base, tested, cuts):
                    if end > done:
                        parts += [whole[done:start], mask] if start >= done else []
                        done = end
                new.append("".join([*parts, whole[done:]]))
            column = pd.Series(new, dtype=object).where(~batch.column(at).is_null().to_pandas(), None)
            arrays = [pa.array(column, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
