"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model.

The model predicts each byte of a text from the ``ORDER - 1`` before it. It is trained on trusted
documents (label quality 1 in all label rows); the first of ``FOLDS`` folds of them is held out. Counting and
smoothing are DataFrame work: n-gram counts are summed from partial sums of the tasks; the counts of
order k are the numbers of distinct bytes before its n-grams of order k + 1; discounts come from the
counts of counts; probabilities come from joining the counts of an order with those of its contexts
and with the next lower order.

The model is then cut into shards by the last two bytes of the context, each of bounded size, and
each shard is joined to the documents in one pass over them: it is broadcast, which its bound
allows, and the partial log-likelihoods of a document are added. So that every language has a cut of its own
however few trusted documents it has, these are cross-fitted: each fold is scored by a model of the
other folds. A document is rejected when its log-perplexity per byte exceeds the ``QUANTILE`` of the
trusted documents of its language. Texts shorter than a few hundred bytes are drawn towards the
median of their language, by as much as ``PRIOR`` bytes weigh.

Defined cases: a null or empty text has no perplexity and is rejected; a null language is a language
of its own; in a language without trusted documents nothing but empty texts is rejected; rows with the same id are
judged together; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.common import MIX_1, Scratch, pieces, shuffles_released, strings, without

ORDER = 5
QUANTILE = 0.995
FOLDS = 4
PRIOR = 100.0
#: Rows of a shard: 16 bytes each, so 64 MiB; a single shard key can hold 2 ** 24 at most.
SHARD_ROWS = 1 << 22
SLICE_BYTES = 1 << 20
#: Trusted ids that may be broadcast (8 MiB); more are joined by a shuffle.
BROADCAST_IDS = 1 << 20


def byte_grams(data: np.ndarray, bounds: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For every byte, itself and the ``order - 1`` bytes before it in its text as one number; zeros before the start."""
    out = data.astype(np.uint64)
    place = np.arange(len(data)) - np.repeat(bounds[:-1], np.diff(bounds))
    for k in range(1, order):
        earlier = np.zeros(len(data), np.uint64)
        earlier[k:] = data[:-k] if k else data
        earlier[place < k] = 0
        out |= earlier << np.uint64(8 * k)
    return out


def count_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(g, c): how often every n-gram of the highest order occurs in the one text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
            own, at = np.unique(all_keys, return_inverse=True)
            return own, np.bincount(at, weights=all_counts).astype(np.int64)

        for batch in batches:
            data, bounds = strings(batch.column(0))
            for low, high in pieces(bounds, SLICE_BYTES):
                grams = byte_grams(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], order)
                own, count = np.unique(grams, return_counts=True)
                keys.append(own)
                counts.append(count)
                held += len(own)
                if held > 1 << 22:
                    own, count = merged()
                    keys, counts, held = [own], [count], 0
                    if len(own) > 1 << 21:
                        yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(count)], names=["g", "c"])
                        keys, counts = [], []
        if keys:
            own, count = merged()
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(count)], names=["g", "c"])

    return texts.mapInArrow(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def smooth(top: DataFrame, scratch: Scratch, order: int = ORDER) -> list[tuple[DataFrame, DataFrame]]:
    """Per order 1 to ``order``: (g, p) of the n-grams seen and (h, weight) of the contexts seen."""
    tables = {order: top}
    for k in range(order - 1, 0, -1):
        mask = (1 << (8 * k)) - 1
        tables[k] = scratch.keep(
            tables[k + 1].groupBy(F.col("g").bitwiseAND(F.lit(mask)).alias("g")).agg(F.count("*").alias("c")))
    out: list[tuple[DataFrame, DataFrame]] = []
    lower: DataFrame | None = None
    for k in range(1, order + 1):
        n = tables[k].agg(*(F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4))).first()
        cut = discounts(*n)
        of = F.when(F.col("c") == 1, cut[0]).when(F.col("c") == 2, cut[1]).otherwise(cut[2])
        rows = tables[k].select("g", F.shiftright("g", 8).alias("h"), "c", of.alias("d"))
        contexts = rows.groupBy("h").agg(F.sum("c").alias("total"), F.sum("d").alias("freed")).select(
            "h", "total", (F.col("freed") / F.col("total")).alias("weight"))
        joined = rows.join(contexts, "h").select(
            "g", ((F.col("c") - F.col("d")) / F.col("total")).alias("own"), "weight")
        if lower is None:
            found = joined.select("g", (F.col("own") + F.col("weight") / 256).alias("p"))
        else:
            mask = (1 << (8 * (k - 1))) - 1
            found = joined.withColumn("low", F.col("g").bitwiseAND(F.lit(mask))).join(
                lower.select(F.col("g").alias("low"), F.col("p").alias("lower_p")), "low"
            ).select("g", (F.col("own") + F.col("weight") * F.col("lower_p")).alias("p"))
        lower = scratch.keep(found)
        out.append((lower, scratch.keep(contexts.select("h", "weight"))))
    return out


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts; where counts of counts are missing, fixed ones below the count."""
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


class Table:
    """A hash table of numpy arrays: rows sorted by slot, with the first row of every slot."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() + 1)
        slot = self.slot(keys)
        order = np.argsort(slot, kind="stable")
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        counts = np.bincount(slot, minlength=1 << self.bits)
        self.first = np.zeros((1 << self.bits) + 1, np.int32)
        np.cumsum(counts, out=self.first[1:])
        self.most = int(counts.max()) if len(keys) else 0

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(23))) * MIX_1 >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of the keys, -1 where there is none."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        slot = self.slot(keys)
        at, end = self.first[slot], self.first[slot + 1]
        todo = np.flatnonzero(at < end)
        for _ in range(self.most):
            here = at[todo]
            hit = self.keys[here] == keys[todo]
            out[todo[hit]] = here[hit]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
            if not len(todo):
                break
        return out


class Shard:
    """The part of the model whose contexts end in certain two bytes."""

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]], contexts: list[tuple[np.ndarray, np.ndarray]],
                 mine: np.ndarray):
        self.grams = [Table(g, np.log(p)) for g, p in grams]
        self.contexts = [Table(h, np.log(w)) for h, w in contexts]
        self.mine = mine

    def log_p(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probability of the last byte of each n-gram given the bytes before."""
        out = np.zeros(len(grams), np.float64)
        todo = np.arange(len(grams))
        for k in range(order, 0, -1):
            now = grams[todo] & np.uint64((1 << (8 * k)) - 1)
            at = self.grams[k - 1].find(now)
            seen = at >= 0
            out[todo[seen]] += self.grams[k - 1].values[at[seen]]
            todo, now = todo[~seen], now[~seen]
            if not len(todo):
                return out
            back = self.contexts[k - 1].find(now >> np.uint64(8))
            known = back >= 0
            out[todo[known]] += self.contexts[k - 1].values[back[known]]
        out[todo] += np.log(1 / 256)
        return out


def shards(model: list[tuple[DataFrame, DataFrame]], limit: int = SHARD_ROWS) -> Iterator[Shard]:
    """The model in pieces of about ``limit`` rows; orders 1 and 2 are small and in every piece."""
    keyed = []
    for k, (grams, contexts) in enumerate(model, 1):
        if k > 2:
            keyed.append(grams.select(F.lit(k).alias("k"), F.lit(0).alias("kind"), F.col("g").alias("key"), "p",
                                      F.shiftright("g", 8).bitwiseAND(F.lit(0xFFFF)).alias("shard_key")))
            keyed.append(contexts.select(F.lit(k).alias("k"), F.lit(1).alias("kind"), F.col("h").alias("key"),
                                         F.col("weight").alias("p"), F.col("h").bitwiseAND(F.lit(0xFFFF)).alias("shard_key")))
    small = [(g.toArrow(), c.toArrow()) for g, c in model[:2]]  # at most 2 ** 16 n-grams and 2 ** 8 contexts
    rows = keyed[0]
    for more in keyed[1:]:
        rows = rows.union(more)
    sizes = rows.groupBy("shard_key").count().orderBy("shard_key").collect()  # at most 2 ** 16 rows
    groups: list[list[int]] = [[]]
    held = 0
    for key, n in sizes:
        if held + n > limit and groups[-1]:
            groups.append([])
            held = 0
        groups[-1].append(key)
        held += n
    for number, group in enumerate(groups):
        low, high = (group[0], group[-1]) if group else (0, -1)
        part = rows.where(F.col("shard_key").between(low, high)).drop("shard_key").toArrow()
        k, kind = part.column("k").to_numpy(), part.column("kind").to_numpy()
        key, p = part.column("key").to_numpy().view(np.uint64), part.column("p").to_numpy()
        grams = [(g.column(0).to_numpy().view(np.uint64), g.column(1).to_numpy()) for g, _ in small]
        contexts = [(c.column(0).to_numpy().view(np.uint64), c.column(1).to_numpy()) for _, c in small]
        for order in range(3, len(model) + 1):
            own, other = (k == order) & (kind == 0), (k == order) & (kind == 1)
            grams.append((key[own], p[own]))
            contexts.append((key[other], p[other]))
        mine = np.zeros(1 << 16, bool)
        # keys no context ends in are scored with the first shard
        mine[(0 if number == 0 else low) : (1 << 16 if number == len(groups) - 1 else groups[number + 1][0])] = True
        yield Shard(grams, contexts, mine)


def log_likelihoods(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]], id_col: str, text: str, extra: list[str],
                    limit: int = SHARD_ROWS) -> DataFrame:
    """Per id (and ``extra`` columns): the summed log-likelihood and the number of bytes."""
    spark = docs.sparkSession
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (id_col, *extra))
    parts = []
    for shard in shards(model, limit):
        shared = spark.sparkContext.broadcast(shard)
        whole = bool(shard.mine.all())

        def run(batches: Iterator[pa.RecordBatch], shared=shared, whole=whole) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                data, bounds = strings(batch.column(batch.num_columns - 1))
                total = np.zeros(len(bounds) - 1)
                size = np.zeros(len(bounds) - 1, np.int64)
                for low, high in pieces(bounds, SLICE_BYTES):
                    offsets = bounds[low : high + 1] - bounds[low]
                    grams = byte_grams(data[bounds[low] : bounds[high]], offsets)
                    if whole:
                        values, count = own.log_p(grams), np.diff(offsets)
                    else:
                        mine = np.flatnonzero(own.mine[(grams >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.int64)])
                        values = np.zeros(len(grams))
                        values[mine] = own.log_p(grams[mine])
                        row = np.searchsorted(offsets, mine, side="right") - 1
                        count = np.bincount(row, minlength=high - low)
                    sums = np.zeros(len(values) + 1)
                    np.cumsum(values, out=sums[1:])
                    total[low:high], size[low:high] = sums[offsets[1:]] - sums[offsets[:-1]], count
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(total), pa.array(size)],
                    names=[*batch.schema.names[:-1], "log_p", "n_bytes"])

        parts.append(docs.select(id_col, *extra, F.col(text).cast("string")).mapInArrow(
            run, f"{kinds}, log_p double, n_bytes long"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    if len(parts) > 1:
        out = out.groupBy(id_col, *extra).agg(F.sum("log_p").alias("log_p"), F.sum("n_bytes").alias("n_bytes"))
    return out


def trusted_ids(labels: DataFrame, label_id: str, quality: str) -> DataFrame:
    return (
        labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("trusted"))
        .agg(F.min(F.coalesce(F.col(quality).cast("int"), F.lit(0))).alias("q")).where("q = 1").select("trusted")
        .withColumn("fold", F.pmod(F.xxhash64(F.lit("held"), "trusted"), F.lit(FOLDS)).cast("int"))
    )


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
    label_id: str = "doc_id", quality: str = "quality", quantile: float = QUANTILE,
) -> DataFrame:
    """Per id: language, bytes, log-perplexity per byte (natural log), the cut of the language, and whether it is kept."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    ids = scratch.keep(trusted_ids(labels, label_id, quality))
    own = docs.select(F.col(id_col).alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    joined = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = scratch.keep(own.join(joined, F.col("id") == F.col("trusted")).select("id", "lang", "text", "fold"))
    tops = [scratch.keep(count_grams(texts.where(F.col("fold") == fold).select("text"))) for fold in range(FOLDS)]
    parts = []
    for fold in range(FOLDS):
        others = [top for i, top in enumerate(tops) if i != fold]
        rows = others[0]
        for more in others[1:]:
            rows = rows.union(more)
        model = smooth(scratch.keep(rows.groupBy("g").agg(F.sum("c").alias("c"))), scratch)
        if fold == 0:
            scores = scratch.keep(log_likelihoods(own, model, "id", "text", ["lang"]))
            parts.append(scores.join(ids.where("fold = 0"), F.col("id") == F.col("trusted")).select(*scores.columns))
        else:
            parts.append(log_likelihoods(texts.where(F.col("fold") == fold), model, "id", "text", ["lang"]))
        scratch.keep_only(ids, texts, scores, *tops)  # the model's shards have been sent
    fitted = parts[0]
    for part in parts[1:]:
        fitted = fitted.union(part)

    def per_id(rows: DataFrame) -> DataFrame:
        return rows.groupBy("id").agg(
            F.min("lang").alias("lang"), F.sum("log_p").alias("log_p"), F.sum("n_bytes").alias("n_bytes"))

    fitted = scratch.keep(per_id(fitted).where("n_bytes > 0"))
    scratch.keep_only(scores, fitted)
    rate = -F.col("log_p") / F.col("n_bytes")
    drawn = (-F.col("log_p") + PRIOR * F.col("middle")) / (F.col("n_bytes") + PRIOR)
    middles = fitted.groupBy(F.col("lang").alias("of")).agg(F.percentile_approx(rate, 0.5, 10000).alias("middle"))
    cuts = scratch.keep(
        fitted.join(middles, F.expr("lang <=> of")).groupBy("of").agg(
            F.first("middle").alias("middle"), F.percentile_approx(drawn, quantile, 10000).alias("cut"))
    )
    scratch.drop(fitted)
    return (
        per_id(scores).join(cuts, F.expr("lang <=> of"), "left")
        .select(F.col("id").alias(id_col), "lang", "n_bytes",
                F.when(F.col("n_bytes") > 0, F.coalesce(drawn, rate)).alias("log_perplexity"), "cut")
        .withColumn("kept", (F.col("n_bytes") > 0) & (F.col("cut").isNull() | (F.col("log_perplexity") <= F.col("cut"))))
    )


def accepted_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that are kept, columns as they were."""
    with shuffles_released(docs.sparkSession):
        judged = classify(docs, labels, id_col, text, lang)  # one row per id
        rejected = Scratch(docs.sparkSession).keep(judged.where(~F.col("kept")).select(F.col(id_col).alias("k")))
        return without(docs, id_col, rejected)
