"""Vector codes: k-means codebooks of vector parts, trained exactly with cover trees.

A component x becomes the integer floor(4096 * x), and a vector is cut into equal parts,
each with a codebook of its own. Vectors are packed into chunks, inside the tasks that read
them, and each chunk has a cover tree for each part:

* Points are taken far from all taken before, so the first of them are a net at every scale:
  those taken at a distance beyond 2^l are over 2^l apart and have all others within 2^l.
  These are the nodes of level l. A node's parent is the nearest node of the level above.
* Points lie in the order of the tree's leaves, so what is below a node is a range, and
  cumulative sums give its sum. A node knows the largest distance to a point below it.

In a round, a node whose nearest codebook entry stays the nearest for all that is below it,
by the triangle inequality, adds its sum to that entry at once. Otherwise its children go
on, with those entries alone that can still win; what reaches the leaves is compared in
integers, so codes are exactly those of a comparison with every entry. Sums and counts per
entry are all that leaves the chunks in a round; the codebooks go with the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from carespan.plans.skew import attach, row_count
from carespan.sources.staging import stage

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
CHUNK = 2048  # vectors of a chunk
NET = 8  # one node of the lowest level for so many vectors
LARGEST = 1 << 27  # of an integer component, so that sums of squares stay in 64 bits
SLACK = 1e-3  # by which a bound must hold, above the error of a distance in doubles
TREE = "order binary, points binary, sizes array<int>, starts binary, nodes binary, radii binary"
ARROW_TREE = pa.struct(
    [(c, pa.list_(pa.int32()) if c == "sizes" else pa.binary()) for c in ("order", "points", "sizes", "starts", "nodes", "radii")]
)
Tree = dict  # as arrays: order, points, and a list of (starts, nodes, radii) by level


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every other, as exact integers."""
    out = np.zeros((len(points), len(others)), np.int64)
    for i in range(points.shape[1]):
        step = points[:, i, None] - others[None, :, i]
        out += step * step
    return out


def greedy_net(points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` points, each the farthest from those before it, and that distance."""
    taken, reach = [0], [np.inf]
    left = np.sqrt(distances(points, points[:1])[:, 0])
    while len(taken) < most and left.max() > 0:
        taken.append(int(left.argmax()))
        reach.append(left[taken[-1]])
        left = np.minimum(left, np.sqrt(distances(points, points[taken[-1:]])[:, 0]))
    return np.array(taken), np.array(reach)


def nearest(points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each point its nearest node, some hundreds of points at a time."""
    found = [distances(points[at : at + 512], nodes).argmin(1) for at in range(0, len(points), 512)]
    return np.concatenate(found)


def cover_tree(points: np.ndarray) -> Tree:
    """The tree over the points of one part of a chunk."""
    taken, reach = greedy_net(points, max(1, len(points) // NET))
    net = points[taken]
    # how many of the net are nodes of a level, from the root down
    scale = np.ceil(np.log2(reach[1:])) if len(reach) > 1 else np.zeros(0)
    sizes = [1, *[1 + int((scale >= s).sum()) for s in np.unique(scale)[::-1]]]
    # above[l][j] is the node of level l over node j of the next one, itself if it is there
    above = []
    for few, many in zip(sizes, sizes[1:], strict=False):
        parent = np.arange(many)
        parent[few:] = nearest(net[few:many], net[:few])
        above.append(parent)
    over = nearest(points, net[: sizes[-1]])  # of each point, level by level
    ancestors = [over]
    for parent in reversed(above):
        ancestors.append(parent[ancestors[-1]])
    ancestors.reverse()
    order = np.lexsort(ancestors[::-1])
    points, levels = points[order], []
    for level in ancestors:
        at = level[order]
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        away = np.sqrt(((points - net[at]) ** 2).sum(1))
        levels.append((starts, net[at[starts]], np.maximum.reduceat(away, starts)))
    return {"order": order, "points": points, "levels": levels}


def assign(tree: Tree, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ranges of the tree's points and the entry nearest to all of a range: starts, ends, entries."""
    n, levels = len(tree["points"]), tree["levels"]
    at = np.arange(len(levels[0][0]))
    can = np.ones((len(at), len(book)), bool)
    for i, (starts, nodes, radii) in enumerate(levels):
        ends = np.append(starts[1:], n)
        away = np.where(can, np.sqrt(distances(nodes[at], book)), np.inf)
        best, reach = away.min(1), radii[at]
        # an entry can win below if it may be as near as the best entry may be far
        can &= away - reach[:, None] <= (best + reach)[:, None] + SLACK
        sure = can.sum(1) == 1
        yield starts[at[sure]], ends[at[sure]], can[sure].argmax(1)
        at, can = at[~sure], can[~sure]
        # children: the ranges of the next level inside this one, at last the points
        below = levels[i + 1][0] if i + 1 < len(levels) else np.arange(n)
        first, last = np.searchsorted(below, starts[at]), np.searchsorted(below, ends[at])
        many = last - first
        can = np.repeat(can, many, axis=0)
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
    away = np.where(can, distances(tree["points"][at], book), np.iinfo(np.int64).max)
    yield at, at + 1, away.argmin(1)  # of equally near ones the first


def summed(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many points each entry is nearest to, and their sums."""
    width = tree["points"].shape[1]
    run = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(tree["points"], axis=0)])
    count, total = np.zeros(len(book), np.int64), np.zeros((len(book), width), np.int64)
    for starts, ends, entries in assign(tree, book):
        np.add.at(count, entries, ends - starts)
        np.add.at(total, entries, run[ends] - run[starts])
    return count, total


def codes(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's entry and squared distance, in the order of the chunk."""
    code = np.zeros(len(tree["points"]), np.int64)
    for starts, ends, entries in assign(tree, book):
        many = ends - starts
        where = np.repeat(starts - (np.cumsum(many) - many), many) + np.arange(many.sum())
        code[where] = np.repeat(entries, many)
    step = tree["points"] - book[code]
    out = np.zeros((2, len(code)), np.int64)
    out[:, tree["order"]] = code, (step * step).sum(1)
    return out[0], out[1]


def bounds(width: int) -> list[tuple[int, int]]:
    """First and last component of each part; equal parts where the width allows it."""
    edges = [width * i // PARTS for i in range(PARTS + 1)]
    return list(zip(edges, edges[1:], strict=False))


def packed_tree(tree: Tree) -> dict:
    starts, nodes, radii = zip(*tree["levels"], strict=True)
    return {
        "order": tree["order"].astype(np.int32).tobytes(),
        "points": tree["points"].astype(np.int32).tobytes(),
        "sizes": [len(s) for s in starts],
        "starts": np.concatenate(starts).astype(np.int32).tobytes(),
        "nodes": np.concatenate(nodes).astype(np.int32).tobytes(),
        "radii": np.concatenate(radii).tobytes(),
    }


def unpacked_tree(row: dict, width: int) -> Tree:
    whole = lambda c: np.frombuffer(row[c], np.int32).astype(np.int64)
    cuts = np.cumsum(row["sizes"])[:-1]
    nodes = whole("nodes").reshape(sum(row["sizes"]), width)
    levels = zip(np.split(whole("starts"), cuts), np.split(nodes, cuts), np.split(np.frombuffer(row["radii"]), cuts), strict=True)
    order = whole("order")
    return {"order": order, "points": whole("points").reshape(len(order), width), "levels": list(levels)}


def packed_rows(width: int, label: pa.DataType):
    """(id, label, q) to chunks, each with a tree for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                held.append(b.slice(at, CHUNK))
                n += held[-1].num_rows
                while n >= CHUNK:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    yield chunk(whole.slice(0, CHUNK), width, label)
                    held, n = whole.slice(CHUNK).to_batches(), n - CHUNK
        if n:
            yield chunk(pa.Table.from_batches(held).combine_chunks(), width, label)

    return run


def chunk(rows: pa.Table, width: int, label: pa.DataType) -> pa.RecordBatch:
    q = rows.column("q").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, width)
    trees = [packed_tree(cover_tree(q[:, a:b])) for a, b in bounds(width)]
    packed = [[rows.column("id").to_pylist()], [rows.column("label").to_pylist()], [trees]]
    types = [pa.list_(pa.int64()), pa.list_(label), pa.list_(ARROW_TREE)]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(packed, types, strict=True)], ["ids", "labels", "trees"])


def trees_of(row, width: int) -> list[Tree]:
    return [unpacked_tree(t, b - a) for t, (a, b) in zip(row, bounds(width), strict=True)]


def sum_rows(books: list[np.ndarray], width: int):
    """Chunks to (part, entry, place, n, total) of what a task has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [(np.zeros(len(k), np.int64), np.zeros(k.shape, np.int64)) for k in books]
        for b in batches:
            for row in b.column("trees"):
                for tree, book, (count, total) in zip(trees_of(row.as_py(), width), books, sums, strict=True):
                    more, above = summed(tree, book)
                    count += more
                    total += above
        for part, (count, total) in enumerate(sums):
            entry, place = (x.reshape(-1) for x in np.indices(total.shape))
            used = count[entry] > 0
            columns = [np.full(len(entry), part), entry, place, count[entry], total.reshape(-1)]
            yield pa.RecordBatch.from_arrays([pa.array(c[used]) for c in columns], ["part", "entry", "place", "n", "total"])

    return run


def code_rows(books: list[np.ndarray], width: int):
    """Chunks to (id, label, code, error)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                found = [codes(t, k) for t, k in zip(trees_of(b.column("trees")[i].as_py(), width), books, strict=True)]
                digits = np.stack([c for c, _ in found], 1).astype(np.uint8)
                text = pa.array([d.tobytes().hex() for d in digits])
                error = pa.array(sum(e for _, e in found))
                yield pa.RecordBatch.from_arrays([b.column("ids")[i].values, b.column("labels")[i].values, text, error], ["id", "label", "code", "error"])

    return run


def whole_numbers(vector: Column) -> Column:
    """floor(SCALE * x) of each component; null if a component is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))).cast("long"))
    return F.when(fine & (F.size(vector) > 0), scaled)


def checked(c: Column) -> Column:
    """The integer vector; an error where a component is beyond LARGEST."""
    far = F.exists(c, lambda x: F.abs(x) >= LARGEST)
    return F.when(far, F.raise_error("a component is too large for exact sums")).otherwise(c)


def first_books(rows: list[Row], width: int) -> list[np.ndarray]:
    q = np.array([r.q for r in rows], np.int64).reshape(len(rows), width)
    return [q[:, a:b].copy() for a, b in bounds(width)]


def trained(chunks: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after all rounds; a round brings one row per part, entry and place."""
    schema = "part int, entry int, place int, n long, total long"
    for _ in range(ROUNDS):
        rows = chunks.select("trees").mapInArrow(sum_rows(books, width), schema.replace("int", "long"))
        new = [k.copy() for k in books]
        for r in rows.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            new[r.part][r.entry, r.place] = r.total // r.n
        books = new
    return books


def compress(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every vector that takes part.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor
    do those whose length is not that of the vector of the smallest id. The codebooks begin
    with the ENTRIES vectors of smallest id; rows without an id come last, rows alike in id
    are ordered by their components, so neither their order nor their tasks matter; with
    fewer vectors there are fewer entries. Rows that share an id, and equal vectors, are
    rows of their own. ``label_error`` sums over equal labels, all rows without one
    together. A length that is no multiple of eight gives parts whose lengths differ by
    one. An integer component of 2^27 or more is an error. Other columns are not read. An
    empty table gives no rows.
    """
    kept = rows.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), whole_numbers(F.col(vector)).alias("q"))
    kept = kept.filter("q IS NOT NULL").withColumn("q", checked(F.col("q")))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "q").limit(1).collect()
    width = len(first[0].q) if first else PARTS
    kept = kept.filter(F.size("q") == width)
    books = first_books(kept.orderBy(F.col("id").asc_nulls_last(), "q").limit(ENTRIES).collect(), width)
    label_type = kept.schema["label"].dataType.simpleString()
    arrow_type = kept.select("label").limit(0).toArrow().schema.field("label").type
    packed = kept.mapInArrow(packed_rows(width, arrow_type), f"ids array<long>, labels array<{label_type}>, trees array<struct<{TREE}>>")
    chunks = stage(packed, "cover-trees")
    if first:
        books = trained(chunks, books, width)
    named = ",".join(str(x) for book in books for x in book.reshape(-1))
    digest = hashlib.sha256(named.encode()).hexdigest()
    coded = stage(chunks.mapInArrow(code_rows(books, width), f"id long, label {label_type}, code string, error long"), "codes")
    totals = coded.groupBy("label").agg(row_count(), F.sum("error").alias("label_error"))
    placed = attach(coded, totals, ["label"], null_safe=True)
    return placed.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
