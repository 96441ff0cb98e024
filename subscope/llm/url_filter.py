"""URL filter: rules first, then the likelihood ratio of two character models.

The longest rule (host and path) that fits decides. For the rest two variable-order Markov models
over the characters of host and path, one of accepted and one of rejected URLs, are compared:
contexts of up to ``ORDER`` characters, Witten-Bell smoothing down to a uniform distribution. The
log-likelihood difference is divided by the length and held against a cut that blocks at most
``LOSS`` of the held-out accepted URLs.

The URLs the rules decide are the labelled rows. The models count all distinct ones of any length, and all of
them set the cut: each of ``FOLDS`` folds is scored by models of the other folds (their counts are the
whole ones less the fold's). Counts are partial sums of the tasks; counts of shorter contexts are sums over the longer
ones; probabilities come from joining an order with its contexts and with the next shorter order.
Grams are scored once each. At most ``LISTED`` of the most frequent ones go to all tasks; URLs that hold
others get theirs through a join. The driver gets that list and a few histograms, whatever the number of URLs.

Defined cases: a null URL or one without ``://`` has empty host and path; an empty host and path
scores 0; without labelled URLs of both classes every undecided URL is allowed; repeated rows
give one result each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.llm.common import Scratch, most_frequent

#: Fixed values: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
ORDER = 5
#: Each fold of the labelled URLs is scored by models of the others.
FOLDS = 4
#: Grams that may be sent to all tasks; what is rarer is joined.
LISTED = 1 << 18
#: Distinct grams a task counts before it hands them on.
COUNTED = 400_000
#: Scores the driver sorts to find one rank, and the bins that narrow more of them down.
SORTED = 1 << 16
BINS = 1 << 12
#: Share of held-out accepted URLs that the cut may block.
LOSS = 0.01
START = "\x02"
ALPHABET = 256

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, said in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, said).otherwise(verdict)
    return name, verdict


class Markov:
    """Interpolated character model from counts of (context, next character)."""

    def __init__(self, counts: dict[str, Counter]):
        self.known: dict[str, dict[str, float]] = {}
        self.back: dict[str, float] = {}
        for context in sorted(counts, key=len):
            following = counts[context]
            total, kinds = sum(following.values()), len(following)
            self.back[context] = kinds / (total + kinds)
            self.known[context] = {
                c: (n + kinds * self.probability(context[1:] if context else None, c)) / (total + kinds)
                for c, n in following.items()
            }

    def probability(self, context: str | None, c: str) -> float:
        weight = 1.0
        while context is not None:
            if (following := self.known.get(context)) is not None:
                if c in following:
                    return weight * following[c]
                weight *= self.back[context]
            context = context[1:] if context else None
        return weight / ALPHABET

    def log_likelihood(self, text: str) -> float:
        padded = START * ORDER + text
        return sum(math.log(self.probability(padded[i : i + ORDER], padded[i + ORDER])) for i in range(len(text)))


def ratio(models: tuple[Markov, Markov] | Models, text: str) -> float:
    """Accepted minus rejected log-likelihood per character."""
    pair = models.local() if isinstance(models, Models) else models
    return (pair[0].log_likelihood(text) - pair[1].log_likelihood(text)) / len(text) if text else 0.0


def cut_between(limit: float, below: float | None, least: float) -> float:
    return least if below is None else (below + limit) / 2


def calibrated_cut(accepted: list[float], rejected: list[float], loss: float = LOSS) -> float:
    """The cut that blocks most held-out rejected URLs while it blocks at most ``loss`` of the accepted ones.

    It lies midway between the rejected URLs it blocks and the accepted ones it lets pass.
    """
    if not accepted or not rejected:
        return 0.0
    limit = sorted(accepted)[int(loss * len(accepted))]
    return cut_between(limit, max((x for x in rejected if x < limit), default=None), min(*accepted, *rejected))


def value_at(values: DataFrame, rank: int) -> float:
    """The value of the one double column ``x`` with so many others before it; bins narrow it down to a few."""
    while True:
        count, least, most = values.agg(F.count("x"), F.min("x"), F.max("x")).first()
        if least == most:
            return least
        if count <= SORTED:
            return sorted(values.toArrow().column("x").to_pylist())[rank]
        bin_ = F.least(F.floor((F.col("x") - least) / (most - least) * BINS), F.lit(BINS - 1))
        for number, n in sorted(map(tuple, values.groupBy(bin_.alias("bin")).count().collect())):  # at most BINS rows
            if rank < n:
                values = values.where(bin_ == number)
                break
            rank -= n


def cut_of(scores: DataFrame, loss: float = LOSS) -> float:
    """``calibrated_cut`` of the rows (verdict, score)."""
    accepted = scores.where("verdict = 'allow'").select(F.col("score").alias("x"))
    limit = value_at(accepted, int(loss * accepted.count()))
    below = F.max(F.when((F.col("verdict") == "block") & (F.col("score") < limit), F.col("score")))
    return cut_between(limit, *scores.agg(below, F.min("score")).first())


def grams(text: str) -> list[str]:
    """Every character with the ``ORDER`` before it."""
    padded = START * ORDER + text
    return [padded[i : i + ORDER + 1] for i in range(len(text))]


_COUNTS = [f"n{i}" for i in range(2 * FOLDS + 1)]


def count_grams(texts: DataFrame) -> DataFrame:
    """(g, n0, ...): how often each gram occurs in the texts of each ``slot``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([g for _, g in counts], pa.string()), pa.array([s for s, _ in counts], pa.int32()),
                 pa.array(counts.values(), pa.int64())], names=["g", "slot", "n"])

        for batch in batches:
            for text, slot in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts.update((slot, g) for g in grams(text.as_py()))
                if len(counts) > COUNTED:
                    yield flush()
                    counts.clear()
        if counts:
            yield flush()

    return texts.select("text", "slot").mapInArrow(run, "g string, slot int, n long").groupBy("g").agg(
        *(F.sum(F.when(F.col("slot") == i, F.col("n")).otherwise(0)).alias(c) for i, c in enumerate(_COUNTS)))


def probabilities(top: DataFrame, scratch: Scratch) -> DataFrame:
    """(g, n, d0, ...): of every gram its count and, by the models without each fold and by the whole ones, the
    log of its probability as accepted less that as rejected."""
    tables = [top]
    for _ in range(ORDER):
        tables.append(scratch.keep(
            tables[-1].groupBy(F.expr("substring(g, 2)").alias("g")).agg(*(F.sum(c).alias(c) for c in _COUNTS))))
    ways = [(side, fold) for side in (0, 1) for fold in range(FOLDS + 1)]

    def seen(side: int, left_out: int) -> Column:
        return sum((F.col(f"n{side * FOLDS + f}") for f in range(FOLDS) if f != left_out), F.lit(0))

    lower: DataFrame | None = None
    for table in reversed(tables):
        rows = table.select("g", F.expr("left(g, length(g) - 1)").alias("h"), *(seen(*w).alias(f"c{i}") for i, w in enumerate(ways)))
        contexts = rows.groupBy("h").agg(
            *(F.sum(f"c{i}").alias(f"total{i}") for i in range(len(ways))),
            *(F.count_if(F.col(f"c{i}") > 0).alias(f"kinds{i}") for i in range(len(ways))))
        joined = rows.join(contexts if lower is not None else F.broadcast(contexts), "h")  # the empty context is one row
        if lower is None:
            joined = joined.select("*", *(F.lit(1 / ALPHABET).alias(f"low{i}") for i in range(len(ways))))
        else:
            joined = joined.withColumn("s", F.expr("substring(g, 2)")).join(lower.select(
                F.col("g").alias("s"), *(F.col(f"p{i}").alias(f"low{i}") for i in range(len(ways)))), "s")
        lower = joined.select("g", *(
            F.when(F.col(f"total{i}") > 0, (F.col(f"c{i}") + F.col(f"kinds{i}") * F.col(f"low{i}")) / (F.col(f"total{i}") + F.col(f"kinds{i}")))
            .otherwise(F.col(f"low{i}")).alias(f"p{i}") for i in range(len(ways))))
    out = scratch.keep(
        lower.join(top, "g").select("g", sum((F.col(c) for c in _COUNTS), F.lit(0)).alias("n"), *(
            (F.log(f"p{i}") - F.log(f"p{i + FOLDS + 1}")).alias(f"d{i}") for i in range(FOLDS + 1))))
    scratch.drop(*tables[1:])
    return out


def score(text: str, known: dict[str, tuple], model: int) -> float | None:
    """The mean of the grams' logs, correctly rounded; None where ``known`` lacks a gram."""
    try:
        return math.fsum(known[g][model] for g in grams(text)) / len(text) if text else 0.0
    except KeyError:
        return None


class Models:
    """The models over all labelled URLs: their grams as a table, and those that all tasks have."""

    def __init__(self, texts: DataFrame, scratch: Scratch):
        self.counts = scratch.keep(count_grams(texts))
        self.table = probabilities(self.counts, scratch)
        listed, self.more = most_frequent(self.table, LISTED)
        rows = zip(*(listed.column(f"d{i}").to_pylist() for i in range(FOLDS + 1)), strict=True)
        self.listed: Broadcast[dict[str, tuple]] = texts.sparkSession.sparkContext.broadcast(
            dict(zip(listed.column("g").to_pylist(), rows, strict=True)))
        self._local: tuple[Markov, Markov] | None = None

    def local(self) -> tuple[Markov, Markov]:
        """The whole models on the driver, to look at single URLs; no query does that."""
        if self._local is None:
            counts: tuple = (defaultdict(Counter), defaultdict(Counter))
            for g, *n in self.counts.collect():
                for side in (0, 1):
                    if total := sum(n[side * FOLDS : (side + 1) * FOLDS]):
                        for k in range(ORDER + 1):
                            counts[side][g[ORDER - k : ORDER]][g[ORDER]] += total
            self._local = Markov(counts[0]), Markov(counts[1])
        return self._local

    def scores(self, texts: DataFrame, unlisted: bool = False) -> DataFrame:
        """``texts`` (text, model, ...) with their score; on request only those with grams that are not listed."""
        shared, fields = self.listed, [*texts.schema.fields]
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

        def by_list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                held = batch.column(0).to_pylist()
                found = [score(t, known, m) for t, m in zip(held, batch.column(1).to_pylist(), strict=True)]
                rest = [[] if x is not None else list({g for g in grams(t) if g not in known}) for t, x in zip(held, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, pa.float64()), pa.array(rest, pa.list_(pa.string()))],
                    names=[*batch.schema.names, "score", "rest"])

        def by_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                found = [
                    score(t, {**{g: known[g] for g in grams(t) if g in known}, **{e["g"]: {m: e["d"]} for e in own}}, m)
                    for t, m, own in zip(*(batch.column(i).to_pylist() for i in (0, 1, batch.num_columns - 1)), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(found, pa.float64())], names=[*batch.schema.names[:-1], "score"])

        first = texts.mapInArrow(by_list, f"{kinds}, score double, rest array<string>")
        names = [f.name for f in fields]
        own_d = F.element_at(F.array(*(f"d{i}" for i in range(FOLDS + 1))), F.col("model") + 1)
        joined = (
            first.where("score is null").select(*names, F.explode("rest").alias("g")).join(self.table, "g")
            .groupBy(*names).agg(F.collect_list(F.struct("g", own_d.alias("d"))).alias("own"))
            .mapInArrow(by_join, f"{kinds}, score double"))
        if unlisted:
            return joined
        whole = first.where("score is not null").select(*names, "score")
        return whole.union(joined) if self.more else whole


def fit(labelled: DataFrame) -> tuple[Models, float] | None:
    """Models and cut from (text, verdict) rows, null verdicts being those to judge; None where a class is missing."""
    scratch = Scratch(labelled.sparkSession)
    fold = F.pmod(F.xxhash64(F.lit("held"), "text"), F.lit(FOLDS)).cast("int")
    slot = F.when(F.col("verdict") == "allow", fold).when(F.col("verdict") == "block", fold + FOLDS).otherwise(2 * FOLDS)
    texts = scratch.keep(
        labelled.where(F.length("text") > 0).select("text", "verdict").distinct()
        .select("text", F.when(F.col("verdict").isNull(), FOLDS).otherwise(fold).alias("model"), "verdict", slot.alias("slot")))
    if texts.where("verdict is not null").select("verdict").distinct().count() < 2:
        scratch.drop(texts)
        return None
    models = Models(texts, scratch)
    scores = scratch.keep(models.scores(texts.where("verdict is not null").select("text", "model", "verdict")).select("verdict", "score"))
    cut = cut_of(scores)
    scratch.drop(texts, scores)
    return models, cut


def judge(pages: DataFrame, id_col: str = "page_id", url: str = "url", rules: tuple = RULES) -> DataFrame:
    """Per URL: host, path, the rule that decided (or null), verdict, and the model's score of undecided ones."""
    split = pages.select(F.col(id_col), host_of(F.col(url).cast("string")).alias("host"), path_of(F.col(url).cast("string")).alias("path"))
    name, said = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = split.select(id_col, "host", "path", name.alias("rule"), said.alias("said"))
    texts = ruled.select(F.concat("host", "path").alias("text"), F.col("said").alias("verdict"))
    fitted = fit(texts)
    if fitted is None:
        return ruled.select(id_col, "host", "path", "rule", F.coalesce("said", F.lit("allow")).alias("verdict"),
                            F.lit(None).cast("double").alias("score"))
    models, cut = fitted
    shared = models.listed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            host, path, said = (batch.column(i).to_pylist() for i in (1, 2, 4))
            scores = [None if s else score(h + p, known, FOLDS) for h, p, s in zip(host, path, said, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[id_col, "host", "path", "rule", "said", "score"])

    kind = pages.schema[id_col].dataType.simpleString()
    found = ruled.mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, said string, score double")
    if models.more:
        undecided = texts.where("verdict is null").select("text", F.lit(FOLDS).alias("model")).distinct()
        rest = Scratch(pages.sparkSession).keep(models.scores(undecided, unlisted=True).select("text", F.col("score").alias("joined")))
        open_ = F.col("said").isNull() & F.col("score").isNull()
        found = found.where(~open_).union(
            found.where(open_).withColumn("text", F.concat("host", "path")).join(rest, "text", "left")
            .select(id_col, "host", "path", "rule", "said", F.col("joined").alias("score")))
    verdict = F.coalesce("said", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return found.select(id_col, "host", "path", "rule", verdict.alias("verdict"), "score")
