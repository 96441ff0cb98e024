"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Every document gets a rate ``r`` in ``[0, most]``: the rates nearest to 1 in relative entropy,
``sum r ln r - r``, under one token constraint a source, ``sum r * size = target``. Its dual has one
multiplier ``u`` a source, and the rates are exponential tilts, ``r = min(most, exp(u * size / mean))``.

1. *Sizes and targets.* The texts are read once; what goes on is (id, source, size, hash). Sources are
   ranked by code point without bringing them into one task, and shares above ``most`` times a source's
   size are reshared until none is above (one row of sums a round reaches the driver).
2. *Newton iterations.* The dual needs only the histogram (source, size, documents). Each iteration
   joins the multipliers to it, sums moments by source, and steps every open source on the logarithm of
   its constraint; a bracket halves the steps that would leave it. Multipliers stay in a table.
   Sums are decimal, so that reruns give the same rates on any partitioning.
3. *Copies.* Documents of one source and size are cells, large ones dealt by hash into cells of about
   ``CELL`` rows. From large to small sizes the fractions of ``rate * documents`` are carried along, so
   that a source misses its target by at most one document of its largest size; ``REPAIRS`` rounds then
   change the cell that brings the source nearest to its target. In a cell the documents first by hash
   take the odd copies.

Defined cases: a null text has size 0; documents of size 0 keep one copy and count nothing; a null source
is a source, the last one; a source with a target of ``most`` times its size takes every document so often;
null and repeated ids and equal rows are rows of their own; an empty table gives an empty result; other
columns are ignored. Whole copies cannot meet a target nearer than the least document that can be changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscope.llm.common import Scratch

WEIGHTS = (5, 2, 1)
MOST = 3
#: Fixed: the words of the contract.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one source and size that one task ranks, about.
CELL = 1 << 16
TOLERANCE = 1e-9
#: Newton steps after which the bracket alone would have met any tolerance of a double.
STEPS = 80
REPAIRS = 4
EXACT = "decimal(38,12)"


def sizes(docs: DataFrame, id_col: str, text: str, group: str) -> DataFrame:
    """(id, grp, size, h) of each row; ``h`` deals and ranks rows and is no key."""
    return docs.select(
        F.col(id_col).alias("id"), F.col(group).cast("string").alias("grp"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(id_col), F.col(text).cast("string")).alias("h"))


def ranked(totals: DataFrame, scratch: Scratch) -> DataFrame:
    """``totals`` with ``place``, 0 for the least group by code point, null last."""
    order = F.col("grp").asc_nulls_last()
    rows = scratch.keep(
        totals.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id()))
    part, low = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.withColumn("part", part).join(starts, "part").withColumn("place", F.col("start") + low).drop("part", "at", "start")


def with_targets(groups: DataFrame, weights: tuple[float, ...], most: int) -> DataFrame:
    """``groups`` (place, total) with ``target``: shares by weight, none above ``most`` times its total."""
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    rows = groups.withColumn("weight", weight).withColumn("bound", (F.col("total") * most).cast("double"))
    whole = rows.agg(F.sum("total")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # every round but the last finds groups at their bound
        above = F.col("weight") * level > F.col("bound") if full >= 0 else F.lit(False)
        r = rows.agg(
            F.coalesce(F.sum(F.when(above, F.col("total") * most)), F.lit(0)).alias("held"),
            F.sum(F.when(~above, F.col("weight").cast("decimal(18,6)"))).alias("open"),
            F.count_if(above).alias("full")).first()
        if r.full == full or not r.open:
            break
        level, full = (whole - r.held) / float(r.open), r.full
    return rows.withColumn("target", F.least("bound", F.col("weight") * level)).drop("weight", "bound")


def rate(most: int):
    return F.least(F.lit(float(most)), F.exp(F.col("u") * F.col("size") / F.col("mean")))


def multipliers(histogram: DataFrame, groups: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """(place, u) that solve the dual: safeguarded Newton steps, all groups of a step in one job."""
    some = groups.where("total > 0 and target > 0")
    at_bound = F.col("target") >= F.col("total") * float(most)
    ratio = F.log(F.col("target") / F.col("total"))
    low, high = F.least(F.lit(0.0), F.col("mean") * ratio), F.when(ratio > 0, F.col("mean") * F.log(F.lit(float(most)))).otherwise(0.0)
    state = scratch.keep(some.select(
        "place", "mean", "target", low.alias("low"), high.alias("high"),
        F.when(at_bound, high).otherwise(0.0).alias("u"), (at_bound | (ratio == 0)).alias("done")))
    tokens = F.col("n") * F.col("size") * F.col("r")
    for _ in range(STEPS):
        if state.where("not done").isEmpty():
            break
        moments = (
            histogram.join(state.where("not done").select("place", "mean", "u"), "place").withColumn("r", rate(most))
            .groupBy("place").agg(
                F.sum(tokens.cast(EXACT)).cast("double").alias("taken"),
                F.sum(F.when(F.col("r") < most, tokens * F.col("size") / F.col("mean")).otherwise(0.0).cast(EXACT))
                .cast("double").alias("slope"))
        )
        over = F.col("taken") > F.col("target")
        step = F.col("u") - F.log(F.col("taken") / F.col("target")) * F.col("taken") / F.col("slope")
        moved = (
            state.join(moments, "place", "left")
            .withColumn("low", F.when(over | F.col("done"), F.col("low")).otherwise(F.col("u")))
            .withColumn("high", F.when(over & ~F.col("done"), F.col("u")).otherwise(F.col("high")))
            .withColumn("step", F.when((F.col("slope") > 0) & (F.col("taken") > 0), step))
            .withColumn("done", F.col("done") | (F.abs(F.col("taken") - F.col("target")) <= TOLERANCE * F.col("target"))
                        | (F.col("high") - F.col("low") <= 1e-15 * F.greatest(F.abs("low"), F.abs("high"))))
            .withColumn("u", F.when(F.col("done"), F.col("u")).when(
                (F.col("step") > F.col("low")) & (F.col("step") < F.col("high")), F.col("step"))
                .otherwise((F.col("low") + F.col("high")) / 2))
        )
        later = scratch.keep(moved.select(*state.columns))
        scratch.drop(state)
        state = later
    return state.select("place", "u")


def whole_copies(cells: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """``cells`` (place, size, slot, n, r, target) with ``copies`` of all their documents together."""
    order = Window.partitionBy("place").orderBy(F.desc("size"), "slot").rowsBetween(Window.unboundedPreceding, 0)
    want = (F.col("n") * F.col("r")).cast(EXACT)
    rows = (
        cells.withColumn("want", want).withColumn("copies", F.floor("want")).withColumn("part", F.col("want") - F.col("copies"))
        .withColumn("carried", F.sum("part").over(order))
        .withColumn("copies", F.col("copies") + F.floor(F.col("carried") + 0.5) - F.floor(F.col("carried") - F.col("part") + 0.5))
        .withColumn("copies", F.least(F.col("copies").cast("long"), F.col("n") * most))
    )
    rows = scratch.keep(rows.select(*cells.columns, "copies"))
    for _ in range(REPAIRS):
        miss = rows.groupBy("place").agg(
            (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("miss")).where("abs(miss) >= 0.5")
        room = F.when(F.col("miss") > 0, F.col("n") * most - F.col("copies")).otherwise(F.col("copies"))
        change = F.least(room, F.greatest(F.lit(1), F.floor(F.col("n") / 8)), F.round(F.abs("miss") / F.col("size")).cast("long"))
        best = (
            rows.where("size > 0").join(miss, "place").withColumn("change", change).where("change > 0")
            .withColumn("left", F.abs(F.abs("miss") - F.col("change") * F.col("size")))
            .where(F.col("left") < F.abs("miss"))
            .groupBy("place").agg(F.min(F.struct(
                "left", (-F.col("n")).alias("many"), "size", "slot",
                F.when(F.col("miss") > 0, F.col("change")).otherwise(-F.col("change")).alias("change"))).alias("b"))
            .select("place", "b.size", "b.slot", "b.change")
        )
        later = scratch.keep(rows.join(best, ["place", "size", "slot"], "left").select(
            *cells.columns, (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies")))
        scratch.drop(rows)
        rows = later
    return rows


def balance(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", group: str = "source",
    weights: tuple[float, ...] = WEIGHTS, most: int = MOST,
) -> DataFrame:
    """Per row: id, group, size, source_size, target, rate, copies, and taken (words of all copies).

    ``weights`` go to the groups in code point order, over and over; a target is at most ``most`` times
    its group, and no document is taken more often than ``most`` times.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(sizes(docs, id_col, text, group))
    classes = scratch.keep(rows.groupBy("grp", "size").agg(F.count("*").alias("n")))
    totals = classes.groupBy("grp").agg(F.sum(F.col("n") * F.col("size")).alias("total"), F.sum("n").alias("docs"))
    groups = with_targets(ranked(totals, scratch), weights, most)
    groups = scratch.keep(groups.withColumn("mean", F.greatest(F.col("total") / F.col("docs"), F.lit(1e-9))))
    keyed = groups.select(F.col("grp").alias("g"), "place", "total", "target", "mean")
    histogram = scratch.keep(classes.join(keyed, classes.grp.eqNullSafe(keyed.g)).select(
        "grp", "place", "size", "n", "mean", "total", "target", F.ceil(F.col("n") / CELL).alias("slots")))
    solved = multipliers(histogram.where("size > 0").select("place", "size", "n"), groups, most, scratch)
    rated = histogram.join(solved, "place", "left").withColumn("r", F.coalesce(rate(most), F.lit(1.0)))

    of = rated.select(F.col("grp").alias("g"), F.col("size").alias("z"), "place", "slots", "r", "total", "target")
    dealt = scratch.keep(
        rows.join(of, rows.grp.eqNullSafe(of.g) & (rows["size"] == of.z))
        .select("id", "grp", "size", "h", "place", "r", "total", "target", F.pmod("h", "slots").alias("slot")))
    cells = dealt.groupBy("place", "size", "slot").agg(F.count("*").alias("n"), F.first("r").alias("r"), F.first("target").alias("target"))
    copied = whole_copies(scratch.keep(cells), most, scratch).select("place", "size", "slot", "n", "copies")
    by_hash = Window.partitionBy("place", "size", "slot").orderBy("h", "id")
    each = F.floor(F.col("copies") / F.col("n")) + F.when(
        F.row_number().over(by_hash) <= F.col("copies") % F.col("n"), 1).otherwise(0)
    return (
        dealt.join(copied, ["place", "size", "slot"]).withColumn("copies", each.cast("long"))
        .select(
            F.col("id").alias(id_col), F.col("grp").alias("group"), "size", F.col("total").cast("long").alias("source_size"),
            "target", F.col("r").alias("rate"), "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(
    docs: DataFrame, text: str = "text", group: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``balance`` gives it copies."""
    scratch = Scratch(docs.sparkSession)
    key = "row_key"
    while key in docs.columns:
        key += "_"
    keyed = scratch.keep(docs.withColumn(key, F.monotonically_increasing_id()))  # written, so that a row keeps its key
    copies = balance(keyed, key, text, group, weights, most).where("copies > 0").select(
        F.col(key).alias("mixed_key"), F.expr("sequence(1L, copies)").alias("mixed_copies"))
    return keyed.join(copies, F.col(key) == F.col("mixed_key")).select(
        *(F.col(f"`{c}`") for c in docs.columns), F.explode("mixed_copies").alias("mixed_copy")).drop("mixed_copy")
