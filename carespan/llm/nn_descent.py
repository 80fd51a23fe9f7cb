"""Approximate nearest neighbours by NN-descent, in Spark joins.

Equal vectors are one node, so copies cost nothing. A first graph comes from a few
random orders of the nodes: rows are laid out by the signs of random projections, and
neighbours in the line are compared in blocks. Then each round brings every node's
neighbours, and the nodes it is a neighbour of, together with their vectors, compares
them with one another and offers each node the ones that are nearer than its worst
neighbour. Rounds go on, however many, until few offers are taken up.

A query walks greedily from its own node: of the nearest nodes it knows, those not yet
visited are visited and their neighbours scored, until the nearest are all visited.
Scores are cosines in double precision on the vectors as they came.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespan.sources.staging import stage, stage_and_measure

BLOCK = 2048  # nodes of a line that are compared with one another
SIGNS = 10  # random projections whose signs lay out a line
PAIRS = "node long, other long, sim float"


def unit_halves(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in half precision: what the graph is built on."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # else the square of a large component is infinite
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float16)


def halves(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.float16).reshape(len(column), -1).astype(np.float32)


def usable_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(uid, vec_id, vec) of the rows whose vector has a direction; staged.

    Null vectors, vectors of zeros, and vectors with a component that is null or not
    finite take no part, nor do vectors of another length than most have.
    """
    vec = F.col(vector).cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.monotonically_increasing_id().alias("uid"), F.col(key).cast("long").alias("vec_id"), vec.alias("vec"))
    rows = rows.filter(F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0))
    # 0.0 and -0.0 are one value
    rows = stage(rows.withColumn("vec", F.transform("vec", lambda x: x + 0.0)), "vectors")
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vec") == (common.n if common else 0))


def node_table(rows: DataFrame, copies: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, vec, unit), and their members (node, uid, vec_id): the ``copies`` least ids of each."""
    line = Window.partitionBy("vec").orderBy(F.col("vec_id").asc_nulls_last(), "uid")
    first = rows.withColumn("place", F.row_number().over(line)).filter(F.col("place") <= copies)
    first = stage(first.withColumn("node", F.first("uid").over(line)), "members")

    def add_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = unit_halves(b.column("vec").flatten().to_numpy().reshape(b.num_rows, -1))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in x], pa.binary())], ["node", "vec", "unit"])

    nodes = first.filter("place = 1").select("node", "vec")
    nodes = stage(nodes.mapInArrow(add_unit, "node long, vec array<double>, unit binary"), "nodes")
    return nodes, first.select("node", "uid", "vec_id")


def nearest(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest entries of each row, without the diagonal."""
    n = len(sims)
    np.fill_diagonal(sims, -np.inf)
    k = min(k, n - 1)
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.repeat(np.arange(n), k), at.reshape(-1)


def pair_batch(node: np.ndarray, other: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(other, pa.int64()), pa.array(sim, pa.float32())], ["node", "other", "sim"])


def first_graph(nodes: DataFrame, k: int, lines: int, seed: int) -> DataFrame:
    """Pairs from blocks of neighbours in random orders of the nodes."""

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = halves(b.column("unit"))
            planes = np.random.default_rng(seed).normal(size=(x.shape[1], lines, SIGNS + 1)).astype(np.float32)
            signs = np.einsum("nd,dls->nls", x, planes)
            for i in range(lines):
                code = ((signs[:, i, :SIGNS] > 0) * (1 << np.arange(SIGNS))).sum(1).astype(np.int64)
                along = np.clip((signs[:, i, SIGNS] / 16 + 0.5) * (1 << 20), 0, (1 << 20) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, i, np.int32)), pa.array((code << 20) | along), b.column("node"), b.column("unit")],
                    ["line", "code", "node", "unit"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for b in batches:
            kept.append(b)
            if sum(x.num_rows for x in kept) >= 2 * BLOCK:
                rows = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                whole = rows.num_rows // BLOCK * BLOCK
                yield from blocks(rows.slice(0, whole))
                kept = [rows.slice(whole)] if whole < rows.num_rows else []
        for rows in pa.Table.from_batches(kept).combine_chunks().to_batches() if kept else []:
            yield from blocks(rows)

    def blocks(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, lines_ = rows.column("node").to_numpy(), rows.column("line").to_numpy()
        x = halves(rows.column("unit"))
        for at in range(0, len(ids), BLOCK):
            for i in np.unique(lines_[at : at + BLOCK]):  # a block holds one line's nodes
                own = at + np.flatnonzero(lines_[at : at + BLOCK] == i)
                if len(own) > 1:
                    sims = x[own] @ x[own].T
                    a, b = nearest(sims, k // 2)
                    yield pair_batch(ids[own[a]], ids[own[b]], sims[a, b])

    laid = nodes.select("node", "unit").mapInArrow(lay_out, "line int, code long, node long, unit binary")
    laid = laid.repartitionByRange("line", "code", "node").sortWithinPartitions("line", "code", "node")
    return laid.mapInArrow(compare, PAIRS)


def best_of(pairs: DataFrame, k: int, group: str = "node", other: str = "other") -> DataFrame:
    """The k nearest of each node; the limit is kept before rows are shuffled, too."""
    pairs = pairs.groupBy(group, other).agg(F.max("sim").alias("sim"))
    line = Window.partitionBy(group).orderBy(F.desc("sim"), other)
    return pairs.withColumn("place", F.row_number().over(line)).filter(F.col("place") <= k).drop("place")


def both_ways(graph: DataFrame, k: int) -> DataFrame:
    """(centre, member): each node's neighbours and up to k nodes that it is a neighbour of."""
    line = Window.partitionBy("other").orderBy(F.xxhash64("node", "other"), "node")
    back = graph.withColumn("place", F.row_number().over(line)).filter(F.col("place") <= k)
    forth = graph.select(F.col("node").alias("centre"), F.col("other").alias("member"))
    return forth.union(back.select(F.col("other").alias("centre"), F.col("node").alias("member"))).distinct()


def offers(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (centre, member, unit, worst), by centre, to pairs nearer than a member's worst.

    A centre's rows are at most a few dozen; the last centre of a batch is kept for the
    next one, which may have more of its rows.
    """
    kept: list[pa.RecordBatch] = []

    def compare(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        centres, ids = rows.column("centre").to_numpy(), rows.column("member").to_numpy()
        worst = rows.column("worst").to_numpy()
        x = halves(rows.column("unit"))
        edges = np.flatnonzero(np.diff(centres)) + 1
        found: list[tuple[np.ndarray, ...]] = []
        for own in np.split(np.arange(len(ids)), edges):
            if len(own) > 1:
                sims = x[own] @ x[own].T
                a, b = nearest(sims, k)
                s = sims[a, b]
                better = s > worst[own[a]]
                found.append((ids[own[a[better]]], ids[own[b[better]]], s[better]))
        if found:
            yield pair_batch(*(np.concatenate(c) for c in zip(*found, strict=True)))

    for b in batches:
        if not b.num_rows:
            continue
        rows = pa.Table.from_batches([*kept, b]).combine_chunks().to_batches()[0]
        centres = rows.column("centre").to_numpy()
        last = int(np.searchsorted(centres, centres[-1]))
        yield from compare(rows.slice(0, last)) if last else ()
        kept = [rows.slice(last)]
    for rows in kept:
        yield from compare(rows)


def neighbour_graph(
    nodes: DataFrame, *, k: int = 20, lines: int = 16, taken: float = 0.005, seed: int = 5
) -> DataFrame:
    """(node, other, sim): the k nearest other nodes found for each node.

    Rounds end when a share of at most ``taken`` of all neighbours is new. They do end:
    a neighbour gives way to nearer ones only.
    """
    n = nodes.count()
    graph = stage(best_of(first_graph(nodes, k, lines, seed), k), "graph")
    while True:
        # a node with fewer than k neighbours takes all that is offered
        full = F.when(F.count(F.lit(1)) == k, F.min("sim")).otherwise(F.lit(-2.0)).cast("float")
        worst = graph.groupBy("node").agg(full.alias("worst"))
        carried = nodes.select("node", "unit").join(worst, "node").withColumnRenamed("node", "member")
        groups = both_ways(graph, k).join(stage(carried, "carried"), "member")
        groups = groups.repartition("centre").sortWithinPartitions("centre", "member")
        offered = groups.select("centre", "member", "unit", "worst").mapInArrow(lambda b: offers(b, k), PAIRS)  # more than k of a centre cannot stay
        old = graph.withColumn("old", F.lit(1))
        merged = best_of(graph.union(offered), k).join(old.select("node", "other", "old"), ["node", "other"], "left")
        graph, seen = stage_and_measure(merged.select("node", "other", "sim", "old"), "graph", new=F.count_if(F.col("old").isNull()))
        graph = graph.drop("old")
        if seen["new"] <= taken * n * k:
            return graph


def score_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(query, node) with ``sim``, from unit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sim = np.einsum("nd,nd->n", halves(b.column("uq")), halves(b.column("un")))
                yield pa.RecordBatch.from_arrays([b.column("query"), b.column("node"), pa.array(sim, pa.float32())], ["query", "node", "sim"])

    sides = pairs.join(nodes.select("node", F.col("unit").alias("un")), "node")
    sides = sides.join(nodes.select(F.col("node").alias("query"), F.col("unit").alias("uq")), "query")
    return sides.select("query", "node", "uq", "un").mapInArrow(run, "query long, node long, sim float")


def walk(queries: DataFrame, graph: DataFrame, nodes: DataFrame, *, k: int, width: int, step: int, steps: int) -> DataFrame:
    """(query, node, sim): the ``width`` nearest nodes that greedy search finds for each.

    Each step visits, for every query, up to ``step`` nodes not visited yet among the
    ``width`` nearest known; it ends when there are none. Only these are carried along;
    which nodes were scored before is looked up in the parts of the steps before.
    """
    ways = both_ways(graph, k).groupBy("centre").agg(F.collect_list("member").alias("next"))  # 2 k at most
    ways = stage(ways.withColumnRenamed("centre", "node"), "ways")
    own = queries.select("query", F.col("query").alias("node"))
    pool = stage(own.select("query", "node", F.lit(1.0).cast("float").alias("sim"), F.lit(False).alias("visited")), "pool")
    scored = stage(own, "scored")
    line = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    turn = Window.partitionBy("query", "visited").orderBy(F.desc("sim"), "node")
    for _ in range(steps):
        marked = pool.withColumn("turn", F.row_number().over(turn))
        marked = marked.withColumn("now", ~F.col("visited") & (F.col("turn") <= step)).drop("turn")
        marked, seen = stage_and_measure(marked, "frontier", now=F.count_if("now"))
        if not seen.get("now"):
            break
        frontier = marked.filter("now").select("query", "node")
        reached = frontier.join(ways, "node").select("query", F.explode("next").alias("node")).distinct()
        fresh = stage(score_pairs(reached.join(scored, ["query", "node"], "left_anti"), nodes), "fresh")
        scored = scored.union(fresh.select("query", "node"))
        been = marked.select("query", "node", "sim", (F.col("visited") | F.col("now")).alias("visited"))
        both = been.union(fresh.withColumn("visited", F.lit(False)))
        both = both.withColumn("place", F.row_number().over(line)).filter(F.col("place") <= width)
        pool = stage(both.drop("place"), "pool")
    return pool.select("query", "node", "sim")


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return np.einsum("nd,nd->n", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def exact_scores(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(query, node, score) from the original vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sides = [b.column(c).flatten().to_numpy().reshape(b.num_rows, -1) for c in ("vq", "vn")]
                yield pa.RecordBatch.from_arrays([b.column("query"), b.column("node"), pa.array(cosine(*sides))], ["query", "node", "score"])

    sides = pairs.join(nodes.select("node", F.col("vec").alias("vn")), "node")
    sides = sides.join(nodes.select(F.col("node").alias("query"), F.col("vec").alias("vq")), "query")
    return sides.select("query", "node", "vq", "vn").mapInArrow(run, "query long, node long, score double")


def search(
    df: DataFrame,
    is_query: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    nearest_: int = 5,
    k: int = 20,
    width: int = 64,
    step: int = 32,
    steps: int = 12,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each query row.

    ``is_query`` is a condition on ``vec_id``. Every other usable row is a candidate,
    copies of the query too; ties go to the smaller id. A query with fewer candidates
    gets them all. An empty table gives no rows. Rows that share an id are separate.
    """
    rows = usable_vectors(df, key, vector)
    nodes, members = node_table(rows, nearest_ + 1)
    graph = neighbour_graph(nodes, k=k)
    asked = rows.filter(is_query).join(nodes.select("node", "vec"), "vec").select("uid", "vec_id", F.col("node").alias("query"))
    asked = stage(asked, "asked")
    known = walk(asked.select("query").distinct(), graph, nodes, k=k, width=width, step=step, steps=steps)
    line = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    best = known.withColumn("place", F.row_number().over(line)).filter(F.col("place") <= 4 * nearest_ + 1)
    scored = stage(exact_scores(best.select("query", "node"), nodes), "scored")
    own = asked.select(F.col("uid").alias("query_uid"), F.col("vec_id").alias("query_id"), "query")
    found = own.join(scored, "query").join(members, "node").filter(F.col("uid") != F.col("query_uid"))
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= nearest_)
        .select("query_id", "rank", "vec_id", "score")
    )
