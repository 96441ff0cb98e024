"""Near-duplicate vectors by a robust-pruned flat graph.

1. Vectors are normalised in double precision; equal ones become one node with a multiplicity.
2. Nodes are dealt to overlapping shards: each to the ``overlap`` nearest of the centres of a
   spherical k-means on a bounded sample. A shard above ``SHARD_MOST`` nodes is dealt on to the two
   nearest of centres of its own, level by level, so that no task holds an unbounded group. Where
   nearness does not cut a shard, its nodes are dealt so that every two meet in some part.
3. Within a shard each node is joined to the robustly pruned list of its nearest nodes and some
   random ones (a near node hides those it is closer to by the factor ``ALPHA``), both ways.
4. The adjacency lists of all shards are united.
5. Every node is searched in its shards on the united graph: greedily from the shard's medoid, then
   expanding from everything within the range until nothing new is within it. Neighbours that lie
   in other shards are carried on by joins, round by round.
6. Recall is audited: hash-chosen nodes, more of them until enough have links, are compared with
   all vectors by brute force. Below ``RECALL`` the graph is built again with more overlap, up to
   the nearest ``MOST_OVERLAP`` centres; if that does not do, all vectors are compared with all,
   chunk by chunk. Every link is verified by its cosine in double precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing and keep a row; vectors of different length never link; repeated rows link like copies; a
row with a null id gets null as its component unless it has copies or links with an id; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.common import Scratch, components, mix

COSINE = 0.95
SAMPLE = 8192
CENTRES = 2048
SHARD_SIZE, SHARD_MOST = 700, 2500
NEAR, RANDOM, DEGREE, ALPHA = 40, 12, 20, 1.2
BEAM = 12
SLACK = 0.03
#: Nodes of a shard dealt on that each of its centres should get, centres of one step, and the share of its
#: shard above which a part counts as not cut.
PART_SIZE, STEP_CENTRES, UNCUT = SHARD_MOST // 2, 1 << 16, 0.5
#: Audits ask so many nodes, the larger numbers only while fewer than AUDIT_LINKED of them have links.
AUDIT, AUDIT_LINKED, RECALL = (256, 2048, 16384), 100, 0.95
MOST_OVERLAP = 5
#: Nodes compared with all others in one pass, and rows of them multiplied at once.
CHUNK, CHUNK_ROWS = 4096, 1024


def unit_rows(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, unit): the normalised vector as doubles in bytes, null where it has no direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes | None] = []
            for item in batch.column(1):
                row = item.values if item.is_valid else None
                if row is None or len(row) == 0 or row.null_count:
                    out.append(None)
                    continue
                x = row.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all() or not x.any():
                    out.append(None)
                    continue
                x = x / np.abs(x).max()  # no overflow in the square
                out.append((x / np.sqrt((x * x).sum()) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "unit"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>")).mapInArrow(
        run, "id long, unit binary")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_py(), np.float64) for x in column])


def k_means(x: np.ndarray, count: int) -> np.ndarray:
    """Centres of a spherical k-means."""
    k = min(count, len(x))
    centres = x[:: max(1, len(x) // k)][:k].copy()
    for _ in range(6):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1)
        full = size > 0
        centres[full] = sums[full] / size[full, None]
    return centres


def centres_of(nodes: DataFrame, count: int) -> np.ndarray:
    """Centres of the ``SAMPLE`` nodes with the least hash."""
    sample = nodes.select("unit").orderBy(F.xxhash64("unit"), "unit").limit(SAMPLE).toArrow()
    return k_means(matrix(sample.column("unit")), count)


def deal(nodes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """(shard, node, unit): each node once for each of its nearest centres."""
    shared = nodes.sparkSession.sparkContext.broadcast(centres)
    take = min(overlap, len(centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.argsort(-(matrix(batch.column(1)) @ shared.value.T), axis=1, kind="stable")[:, :take]
            rows = np.repeat(np.arange(batch.num_rows), take)
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.reshape(-1).astype(np.int64)), batch.column(0).take(pa.array(rows)),
                 batch.column(1).take(pa.array(rows))], names=["shard", "node", "unit"])

    return nodes.select("node", "unit").mapInArrow(run, "shard long, node long, unit binary")


def parts_of(size: int) -> int:
    return -(-size // PART_SIZE)


def own_centres(dealt: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """Centres of each of the given shards, from a hash-chosen sample of bounded size."""
    counts = {s: min(CENTRES, 2 * parts_of(n)) for s, n in sizes.items()}
    rates = {s: min(1.0, min(SAMPLE, 32 * counts[s]) / n) for s, n in sizes.items()}
    shared = dealt.sparkSession.sparkContext.broadcast((counts, rates))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rates_ = shared.value[1]
        for batch in batches:
            at = mix(batch.column(1).to_numpy().view(np.uint64)) / 2.0**64
            rate = np.array([rates_.get(s, 0.0) for s in batch.column(0).to_pylist()])
            yield batch.filter(pa.array(at < rate))

    def fit(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        x = matrix(table.column("unit"))[np.argsort(table.column("node").to_numpy())]
        return pa.table({"shard": [shard], "centres": [k_means(x, shared.value[0][shard]).tobytes()]})

    rows = (
        dealt.select("shard", "node", "unit").mapInArrow(sample, "shard long, node long, unit binary")
        .groupBy("shard").applyInArrow(fit, "shard long, centres binary").collect()  # at most STEP_CENTRES or one shard's
    )
    dims = len(dealt.select("unit").first().unit) // 8
    return {r.shard: np.frombuffer(r.centres, np.float64).reshape(-1, dims) for r in rows}


def split_large(dealt: DataFrame, scratch: Scratch) -> DataFrame:
    """Shards above the bound dealt on, each node to the two nearest of its shard's own centres, until all parts
    are below it; (shard, part, node, unit). Parts that stay about as large as their shard are dealt by hash into
    blocks, and every two blocks make a part."""
    context = dealt.sparkSession.sparkContext
    out: list[DataFrame] = []
    level, next_shard = dealt, CENTRES
    parent: dict[int, int] = {}  # of shards dealt on: first part to size
    firsts = np.empty(0, np.int64)
    while True:
        sizes = {r.shard: r["count"] for r in level.groupBy("shard").count().where(F.col("count") > SHARD_MOST).collect()}
        if not sizes:
            out.append(level.withColumn("part", F.lit(0).cast("long")))
            break
        before = {s: parent[int(firsts[np.searchsorted(firsts, s, side="right") - 1])] if len(firsts) else None for s in sizes}
        uncut = {s: n for s, n in sizes.items() if before[s] is not None and n > UNCUT * before[s]}
        todo = {s: n for s, n in sizes.items() if s not in uncut}
        out.append(_chosen(level, np.array(sorted(sizes)), False).withColumn("part", F.lit(0).cast("long")))
        if uncut:
            out.append(scratch.keep(in_block_pairs(level, uncut)))
        if not todo:
            break
        parent, deeper, step, held = {}, [], {}, 0
        steps = []
        for s, n in sorted(todo.items()):
            step[s] = n
            held += min(CENTRES, 2 * parts_of(n))
            if held >= STEP_CENTRES:
                steps.append(step)
                step, held = {}, 0
        for step in [*steps, step] if step else steps:
            centres = own_centres(level, step)
            plan = {}
            for s in sorted(step):
                plan[s] = (next_shard, centres[s])
                parent[next_shard] = step[s]
                next_shard += max(len(centres[s]), 1)
            deeper.append(scratch.keep(_deal_on(level, context.broadcast(plan))))
        firsts = np.array(sorted(parent), np.int64)
        level = deeper[0]
        for more in deeper[1:]:
            level = level.union(more)
    whole = out[0].select("shard", "part", "node", "unit")
    for more in out[1:]:
        whole = whole.union(more.select("shard", "part", "node", "unit"))
    return whole


def _chosen(dealt: DataFrame, shards: np.ndarray, wanted: bool) -> DataFrame:
    shared = dealt.sparkSession.sparkContext.broadcast(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(np.isin(batch.column(0).to_numpy(), shared.value) == wanted))

    return dealt.select("shard", "node", "unit").mapInArrow(run, "shard long, node long, unit binary")


def _deal_on(dealt: DataFrame, shared) -> DataFrame:
    """The nodes of the planned shards, each once for each of the two nearest of its shard's centres."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            shard = batch.column(0).to_numpy()
            for own in np.unique(shard).tolist():
                if own not in plan:
                    continue
                first, centres = plan[own]
                some = np.flatnonzero(shard == own)
                units = batch.column(2).take(pa.array(some))
                near = np.argsort(-(matrix(units) @ centres.T), axis=1, kind="stable")[:, :2]
                rows = pa.array(np.repeat(some, near.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first + near.reshape(-1).astype(np.int64)), batch.column(1).take(rows),
                     batch.column(2).take(rows)], names=["shard", "node", "unit"])

    return dealt.select("shard", "node", "unit").mapInArrow(run, "shard long, node long, unit binary")


def in_block_pairs(dealt: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """The nodes of the given shards with a part for every pair of blocks their block is in."""
    shared = dealt.sparkSession.sparkContext.broadcast({s: parts_of(n) for s, n in sizes.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = shared.value
        for batch in batches:
            hashes = mix(batch.column(1).to_numpy().view(np.uint64))
            for row, own in enumerate(batch.column(0).to_pylist()):
                if (p := blocks.get(own, 0)) < 2:
                    continue
                block = int(hashes[row] % np.uint64(p))
                other = np.delete(np.arange(p), block)
                rows = pa.array(np.full(p - 1, row))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array(np.minimum(other, block) * p + np.maximum(other, block)),
                     batch.column(1).take(rows), batch.column(2).take(rows)], names=["shard", "part", "node", "unit"])

    return dealt.select("shard", "node", "unit").mapInArrow(run, "shard long, part long, node long, unit binary")


def robust_prune(similar: np.ndarray, candidates: np.ndarray) -> list[np.ndarray]:
    """For every row the kept candidates: nearest first, each hiding those closer to it than to the row."""
    m, width = candidates.shape
    rows = np.arange(m)[:, None]
    far = 1.0 - similar
    to_row = far[rows, candidates]
    order = np.argsort(to_row, axis=1, kind="stable")
    candidates, to_row = np.take_along_axis(candidates, order, 1), np.take_along_axis(to_row, order, 1)
    alive = candidates != rows
    chosen: list[list[int]] = [[] for _ in range(m)]
    for _ in range(DEGREE):
        pick = alive.argmax(1)
        some = np.flatnonzero(alive[np.arange(m), pick])
        if not len(some):
            break
        best = candidates[some, pick[some]]
        for row, node in zip(some.tolist(), best.tolist(), strict=True):
            chosen[row].append(node)
        hidden = ALPHA * far[best[:, None], candidates[some]] <= to_row[some]
        alive[some] &= ~hidden
        alive[some, pick[some]] = False
    return [np.array(c, np.int64) for c in chosen]


def shard_graph(x: np.ndarray) -> list[set[int]]:
    """Both-way pruned lists of the rows of one shard."""
    m = len(x)
    similar = x @ x.T
    near = np.argpartition(-similar, min(NEAR, m - 1), axis=1)[:, : min(NEAR + 1, m)]
    far = np.random.default_rng(m).integers(0, m, (m, min(RANDOM, m)))
    lists = robust_prune(similar, np.concatenate([near, far], axis=1))
    out = [set(own.tolist()) for own in lists]
    for row, own in enumerate(lists):
        for node in own.tolist():
            out[node].add(row)
    return out


def medoid(x: np.ndarray) -> int:
    return int((x @ x.sum(0)).argmax())


def range_search(x: np.ndarray, lists: list[np.ndarray], start: int, query: np.ndarray, cosine: float) -> np.ndarray:
    """Local nodes with at least the cosine that greedy search from ``start`` and range expansion reach."""
    seen = np.zeros(len(x), bool)
    seen[start] = True
    first = float(x[start] @ query)
    open_ = [(-first, start)]
    beam = [first]
    inside: list[int] = []
    edge = cosine - SLACK
    while open_:
        gain, node = heapq.heappop(open_)
        if -gain >= cosine:
            inside.append(node)
        if -gain < edge and len(beam) >= BEAM and -gain < beam[0]:
            break  # nothing left that is near enough to be in the beam or in the range
        new = lists[node]
        new = new[~seen[new]]
        if not len(new):
            continue
        seen[new] = True
        for gain, other in zip((x[new] @ query).tolist(), new.tolist(), strict=True):
            if len(beam) < BEAM:
                heapq.heappush(beam, gain)
            elif gain > beam[0]:
                heapq.heapreplace(beam, gain)
            elif gain < edge:
                continue
            heapq.heappush(open_, (-gain, other))
    return np.array(inside, np.int64)


def find_links(nodes: DataFrame, scratch: Scratch, cosine: float, overlap: int, centres: np.ndarray) -> DataFrame:
    """(a, b) with a < b: the verified links between nodes."""
    spark = nodes.sparkSession
    members = scratch.keep(split_large(scratch.keep(deal(nodes, centres, overlap)), scratch))

    def build(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        lists = shard_graph(matrix(table.column("unit")))
        source = np.repeat(node, [len(s) for s in lists])
        target = node[np.fromiter((j for s in lists for j in s), np.int64, len(source))]
        return pa.table({"node": source, "other": target})

    edges = members.groupBy("shard", "part").applyInArrow(build, "node long, other long")
    graph = scratch.keep(edges.distinct().groupBy("node").agg(F.collect_list("other").alias("others")))

    def search(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        x = matrix(table.column("unit"))
        order = np.argsort(node)
        held = table.column("others").to_pylist()
        inner, outer = [], []
        for others in held:
            others = np.array(others or [], np.int64)
            at = np.minimum(np.searchsorted(node, others, sorter=order), len(node) - 1)
            here = node[order[at]] == others
            inner.append(order[at[here]])
            outer.append(others[~here])
        start = medoid(x)
        found, leaving = [], []
        for i in range(len(node)):
            near = range_search(x, inner, start, x[i], cosine)
            found.append(near[near != i])
            leaving.append(np.unique(np.concatenate([outer[j] for j in [*near.tolist(), i]])))
        source = np.concatenate([np.repeat(node, list(map(len, found))), np.repeat(node, list(map(len, leaving)))])
        target = np.concatenate([node[np.concatenate(found)], np.concatenate(leaving)])
        sure = np.arange(len(source)) < sum(map(len, found))
        return pa.table({"a": source, "b": target.astype(np.int64), "sure": sure})

    reached = scratch.keep(
        members.join(graph, "node").groupBy("shard", "part").applyInArrow(search, "a long, b long, sure boolean"))
    links = scratch.keep(ordered(reached.where("sure")))
    todo = scratch.keep(ordered(reached.where("not sure")).join(links, ["a", "b"], "left_anti"))
    tried = todo
    while not todo.isEmpty():
        new = scratch.keep(verified(todo, nodes, cosine))
        links = links.union(new)
        both = new.union(new.select("b", "a"))
        further = ordered(both.join(graph, both.b == graph.node).select("a", F.explode("others").alias("b")))
        todo = scratch.keep(further.join(links, ["a", "b"], "left_anti").join(tried, ["a", "b"], "left_anti"))
        tried = tried.union(todo)
    del spark
    return links


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                len(x.as_py()) == len(y.as_py())
                and float(np.frombuffer(x.as_py(), np.float64) @ np.frombuffer(y.as_py(), np.float64)) >= cosine
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    units = nodes.select("node", "unit")
    return (
        pairs.join(units.select(F.col("node").alias("a"), F.col("unit").alias("x")), "a")
        .join(units.select(F.col("node").alias("b"), F.col("unit").alias("y")), "b")
        .select("a", "b", "x", "y").mapInArrow(run, "a long, b long")
    )


def beside(nodes: DataFrame, asked: pa.Table, cosine: float, once: bool) -> DataFrame:
    """(a, b) of the asked nodes and all others within the cosine; with ``once`` only where a < b."""
    shared = nodes.sparkSession.sparkContext.broadcast(
        (asked.column("node").to_numpy(), matrix(asked.column("unit"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, x = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(low, CHUNK_ROWS)
                node = part.column(0).to_numpy()
                row, col = np.nonzero(matrix(part.column(1)) @ x.T >= cosine)
                keep = own[col] < node[row] if once else own[col] != node[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[col][keep]), pa.array(node[row][keep])], names=["a", "b"])

    return nodes.select("node", "unit").mapInArrow(run, "a long, b long")


def audit(nodes: DataFrame, links: DataFrame, cosine: float, n: int) -> float:
    """Mean share of its true links that were found, over hash-chosen nodes that have any."""
    both = links.select("a", "b").union(links.select("b", "a")).withColumn("got", F.lit(1))
    linked, share = 0, None
    for size in AUDIT:
        asked = nodes.orderBy(F.xxhash64(F.lit("audit"), "node"), "node").select("node", "unit").limit(size).toArrow()
        per_node = beside(nodes, asked, cosine, False).join(both, ["a", "b"], "left").groupBy("a").agg(
            (F.count("got") / F.count("*")).alias("share"))
        linked, share = per_node.agg(F.count("*"), F.avg("share")).first()
        if linked >= AUDIT_LINKED or size >= n:
            break
    return share if linked else 1.0


def all_links(nodes: DataFrame, scratch: Scratch, cosine: float, n: int) -> DataFrame:
    """(a, b) with a < b of all pairs within the cosine: every chunk of nodes compared with all nodes."""
    chunks = -(-n // CHUNK)
    dealt = scratch.keep(nodes.select(
        "node", "unit", F.pmod(F.xxhash64(F.lit("chunk"), "node"), F.lit(chunks)).alias("chunk")))
    links: DataFrame | None = None
    for chunk in range(chunks):
        asked = dealt.where(F.col("chunk") == chunk).toArrow()
        if asked.num_rows:
            own = scratch.keep(beside(dealt, asked, cosine, True))
            links = own if links is None else links.union(own)
    return links


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """Per vector: n_links (other vectors within the cosine), component_id (least id reachable), kept."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = scratch.keep(unit_rows(vectors, id_col, vector))
    classes = scratch.keep(
        rows.where("unit is not null").groupBy("unit").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.xxhash64("unit")).withColumn("dims", F.length("unit"))
    )
    links: DataFrame | None = None
    for (dims,) in classes.select("dims").distinct().orderBy("dims").collect():  # lengths of vectors, not vectors
        nodes = classes.where(F.col("dims") == dims)
        n = nodes.count()
        centres = centres_of(nodes, min(CENTRES, -(-n // SHARD_SIZE)))
        for overlap in range(2, MOST_OVERLAP + 1):
            own = find_links(nodes, scratch, cosine, overlap, centres)
            recall = audit(nodes, own, cosine, n)
            if overlap >= len(centres) or recall >= RECALL:
                break
        if recall < RECALL:
            own = all_links(nodes, scratch, cosine, n)
        links = own if links is None else links.union(own)
    if links is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = scratch.keep(links)
    label = components(spark, links, scratch)
    size = classes.select("node", "copies")
    both = links.union(links.select("b", "a"))
    linked = both.join(size, both.b == size.node).groupBy("a").agg(F.sum("copies").alias("others"))
    described = (
        classes.join(linked, classes.node == linked.a, "left")
        .join(label.withColumnRenamed("node", "l"), F.col("node") == F.col("l"), "left")
        .select("unit", "least", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("part"))
    )
    described = scratch.keep(described)
    least = described.groupBy("part").agg(F.min("least").alias("component_id"))
    found = described.join(least, "part").select(F.col("unit").alias("key"), "n_links", "component_id")
    return rows.join(found, rows.unit == found.key, "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(False)).alias("kept"))
