"""Near-duplicates by SetSketch registers, banded, estimated and then verified.

A document's set is its distinct word shingles. A register holds how far below 1 the
least of exponential variables over the set lies, on a scale of powers of BASE, so
registers of a union are the larger ones of its parts, and two sets agree in a register
about as often as their Jaccard similarity says. The steps:

1. Documents with the same set form a class; one row of each class goes on.
2. Bands of ROWS registers are hashed; classes that share a band are candidates.
3. In each band value one class, the hub, is paired with the others. Pairs whose
   similarity, by the likelihood of all registers together, cannot be the threshold are
   left out; the rest is verified on full sets. Links join components. Groups of copies
   are joined by their hubs, so their pairs are never listed.
4. In band values whose other classes still lie in more than one component, all pairs
   across components are looked at: as rows where a band value has few classes; in
   blocks, inside tasks, where it has many. So every two classes that share a band are
   verified or lie in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import kept_text
from carespan.operators.identity import connected
from carespan.sources.staging import stage

WIDTH = 5  # words of a shingle
M, ROWS = 256, 5  # registers; registers of a band
BANDS = M // ROWS
BASE, RATE, LARGEST = 1.001, 20.0, 2**16 - 1  # scale of the registers
THRESHOLD = (75, 100)  # least share of the union that is common, as a fraction
MARGIN = 6  # standard deviations that an estimate may lie below the threshold
SMALL = 32  # classes of a band value whose pairs are made as rows
CHUNK_ROWS, CHUNK_BYTES = 128, 8 << 20  # of a group's members that are compared at once
GROUP_WORDS = 200_000  # of texts handled together
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_MULTIPLIERS = np.random.default_rng(11).integers(1, 2**63, (2, 64), np.uint64) * np.uint64(2) + np.uint64(1)


def scrambled(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit mix of 64-bit numbers."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit digests of words, kept for the words to come."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        digest = self[word] = xxhash.xxh64_intdigest(word)
        return digest


def shingle_sets(texts: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts in a row, as sorted digests, and how many each has.

    A text of fewer than WIDTH words has its whole sequence as its one shingle, an empty
    text none. Words are split at the ASCII white space that bytes.split knows: space,
    tab, line feed, vertical tab, form feed and carriage return.
    """
    words = [t.encode().translate(_LOWER).split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    total = int(lengths.sum())
    h = np.fromiter((hashes[x] for w in words for x in w), np.uint64, total)
    shingles = np.maximum(lengths - WIDTH + 1, 0)
    short = (lengths > 0) & (lengths < WIDTH)
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(texts)), shingles)
    first = np.cumsum(shingles) - shingles
    at = starts[owner] + np.arange(len(owner)) - first[owner]
    mixed = np.zeros(len(at), np.uint64)
    for i in range(WIDTH):
        mixed += scrambled(h[at + i], i + 1) * _MULTIPLIERS[0, i]
    if short.any():
        extra = []
        for d in np.flatnonzero(short):
            own = h[starts[d] : starts[d] + lengths[d]]
            salted = np.concatenate([scrambled(own[i : i + 1], i + 1) for i in range(len(own))])
            extra.append(np.sum(salted * _MULTIPLIERS[1, : len(own)], dtype=np.uint64))
        owner = np.concatenate([owner, np.flatnonzero(short)])
        mixed = np.concatenate([mixed, np.array(extra, np.uint64)])
    mixed = scrambled(mixed)
    order = np.lexsort((mixed, owner))
    owner, mixed = owner[order], mixed[order]
    keep = np.ones(len(owner), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (mixed[1:] != mixed[:-1])
    return mixed[keep], np.bincount(owner[keep], minlength=len(texts))


def set_digests(elements: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that tell sets apart."""
    out = []
    for salt in (21, 22):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(scrambled(elements, salt), dtype=np.uint64)])
        ends = np.cumsum(sizes)
        out.append(sums[ends] - sums[ends - sizes])
    return out[0], out[1]


def register(k: int, order: np.ndarray) -> np.ndarray:
    """The k-th register of each element, by the bits of ``order``: all come once, in no progression.

    Odd factors, sums and exclusive ors with higher bits are one-to-one on M registers.
    """
    at = np.full(len(order), k, np.int64)
    for turn in range(3):
        bits = order >> (20 * turn)
        at = (at * (2 * (bits & 1023) + 1) + ((bits >> 10) & 1023)) & (M - 1)
        at ^= at >> (3 + turn % 2)
    return at


def registers(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sketch of each set, one row of M registers.

    Each element draws M exponential variables in ascending order, by their spacings, for
    registers in an order of its own. It is done with as soon as its next variable is
    beyond the largest minimum of its set, so a large set costs a few draws an element.
    """
    n = len(sizes)
    least = np.full((n, M), np.inf)
    owner = np.repeat(np.arange(n), sizes)
    x = np.zeros(len(elements))
    order = scrambled(elements, 31).astype(np.int64)  # its bits choose the element's order of registers
    element = elements
    flat = least.reshape(-1)
    for k in range(M):
        u = ((scrambled(element, 100 + k) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        x = x - np.log(u) / (RATE * (M - k))
        np.minimum.at(flat, owner * M + register(k, order), x)
        if k < 16 or k % 8 == 7:
            going = x < least.max(1)[owner]
            if not going.all():
                x, owner, order, element = x[going], owner[going], order[going], element[going]
            if not len(x):
                break
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, LARGEST).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    used = sketches[:, : BANDS * ROWS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    out = scrambled(np.arange(BANDS, dtype=np.uint64), 41)[None, :] + np.zeros((len(sketches), 1), np.uint64)
    for i in range(ROWS):
        out = scrambled(out ^ used[:, :, i], 42 + i)
    return out.astype(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity that makes the registers of both most likely, given both sizes."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    u = size_a / (size_a + size_b)
    v = 1 - u
    scale = (BASE - 1) / BASE

    def share(x: np.ndarray) -> np.ndarray:  # of registers that are larger by an excess x
        return -np.log1p(-np.clip(x, 1e-12, 1) * scale) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = share(u - v * j), share(v - u * j)
        return above * np.log(p) + below * np.log(q) + equal * np.log(np.maximum(1 - p - q, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        x, y = low + (high - low) / 3, high - (high - low) / 3
        up = likelihood(x) < likelihood(y)
        low, high = np.where(up, x, low), np.where(up, high, y)
    return (low + high) / 2


def text_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches, each with its texts, of some GROUP_WORDS words."""
    for b in batches:
        start, size, texts = 0, 0, []
        for i, t in enumerate(b.column(column)):
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= 6 * GROUP_WORDS or i + 1 == b.num_rows:
                yield b.slice(start, i + 1 - start), texts
                start, size, texts = i + 1, 0, []


def sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, id, text) to (uid, id, h1, h2, n, keys, sketch); no keys below three shingles."""
    hashes = WordHashes()
    for b, texts in text_groups(batches, "text"):
        elements, sizes = shingle_sets(texts, hashes)
        h1, h2 = set_digests(elements, sizes)
        sketches = registers(elements, sizes)
        # two sets of which one has one or two elements can share 3/4 of their union
        # only if they are equal
        banded = sizes >= 3
        offsets = np.concatenate([[0], np.cumsum(np.where(banded, BANDS, 0))]).astype(np.int32)
        keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(band_keys(sketches[banded]).reshape(-1)))
        sketch = [s.tobytes() if k else None for s, k in zip(sketches, banded, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [b.column("uid"), b.column("id"), pa.array(h1.astype(np.int64)), pa.array(h2.astype(np.int64)),
             pa.array(sizes.astype(np.int64)), keys, pa.array(sketch, pa.binary())],
            ["uid", "id", "h1", "h2", "n", "keys", "sketch"],
        )


SKETCH_ROWS = "uid long, id long, h1 long, h2 long, n long, keys array<long>, sketch binary"


def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose estimate may belong to the threshold: a, b."""
    least = THRESHOLD[0] / THRESHOLD[1]
    least -= MARGIN * np.sqrt(least * (1 - least) / M)
    for b in batches:
        if b.num_rows:
            sides = [np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, M) for c in ("sa", "sb")]
            sizes = [b.column(c).to_numpy().astype(np.float64) for c in ("na", "nb")]
            keep = pa.array(estimate(*sides, *sizes) >= least)
            yield b.select(["a", "b"]).filter(keep)


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, h1, h2, text) to (cid, elements), of rows whose set is the class's."""
    hashes = WordHashes()
    for b, texts in text_groups(batches, "text"):
        elements, sizes = shingle_sets(texts, hashes)
        h1, h2 = set_digests(elements, sizes)
        same = (h1.astype(np.int64) == b.column("h1").to_numpy()) & (h2.astype(np.int64) == b.column("h2").to_numpy())
        ends = np.cumsum(sizes)
        raw = [elements[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
        rows = pa.RecordBatch.from_arrays([b.column("cid"), pa.array(raw, pa.binary())], ["cid", "elements"])
        yield rows.filter(pa.array(same))


def enough(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets share the threshold's part of their union."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return THRESHOLD[1] * common >= THRESHOLD[0] * (len(x) + len(y) - common)


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, ea, eb) to the linked pairs a, b, on full sets."""
    for b in batches:
        sides = ([np.frombuffer(e.as_buffer(), np.uint64) for e in b.column(c)] for c in ("ea", "eb"))
        keep = [enough(x, y) for x, y in zip(*sides, strict=True)]
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def near(a: Column, b: Column) -> Column:
    """Whether two sizes leave room for the threshold."""
    return THRESHOLD[1] * F.least(a, b) >= THRESHOLD[0] * F.greatest(a, b)


def sketched(docs: DataFrame, key: str, text: str, number: Column) -> DataFrame:
    """Every row, by its number, with its set's digests, size, band keys and sketch; staged."""
    rows = docs.select(
        number.alias("uid"),
        F.col(key).cast("long").alias("id"),
        kept_text(F.col(text)).alias("text"),
    )
    return stage(rows.mapInArrow(sketch_rows, SKETCH_ROWS), "sketches")


def full_sets(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(cid, elements) of the classes ``wanted`` (cid, id, h1, h2), from their texts."""
    texts = docs.select(F.col(key).cast("long").alias("id"), kept_text(F.col(text)).alias("text"))
    rows = texts.join(wanted, texts.id.eqNullSafe(wanted.id)).select("cid", "h1", "h2", "text")
    return stage(rows.mapInArrow(set_rows, "cid long, elements binary"), "sets")


def links(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that the likelihood lets pass and the full sets confirm."""
    side = lambda t, c, as_: t.select(F.col("cid").alias(as_), *c)
    both = pairs.join(side(sketches, [F.col("n").alias("na"), F.col("sketch").alias("sa")], "a"), "a")
    both = both.join(side(sketches, [F.col("n").alias("nb"), F.col("sketch").alias("sb")], "b"), "b")
    left = stage(both.mapInArrow(possible, "a long, b long"), "possible")
    full = left.join(side(sets, [F.col("elements").alias("ea")], "a"), "a")
    full = full.join(side(sets, [F.col("elements").alias("eb")], "b"), "b")
    return stage(full.mapInArrow(verified, "a long, b long").distinct(), "links")


def relabelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` (node, root) after the links ``found`` (a, b) have joined components."""
    a, b = (labels.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    bridges = found.join(a, "a").join(b, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    tops = connected(bridges).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return stage(labels.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "labels")


def named(side: str) -> list[Column]:
    """A member's columns as those of one side of a pair."""
    return [F.col("cid").alias(side), F.col("root").alias(f"root_{side}"), F.col("n").alias(f"n_{side}")]


def paired(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (a, b) of one band that lie in different components and may be alike."""
    pairs = left.select("band", *named("a")).join(right.select("band", *named("b")), "band")
    apart = (F.col("root_a") != F.col("root_b")) & (F.col("a") < F.col("b"))
    return pairs.filter(apart & near(F.col("n_a"), F.col("n_b"))).select("a", "b").distinct()


def unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (band, cid, n, root, size) of the bands that hold more than one component."""
    left = members.select("band", "cid", "n").join(labels.withColumnRenamed("node", "cid"), "cid")
    open_ = left.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
    open_ = open_.filter("low != high").select("band", "size")
    return stage(left.join(open_, "band"), "members")


def compare_block(rows: pa.Table) -> pa.Table:
    """Links between the members of two chunks of a group, or inside one.

    The sketches of all pairs are compared, and the sets of those that may be alike.
    """
    chunk, i, j = (rows.column(c).to_numpy() for c in ("chunk", "i", "j"))
    cid, root, n = (rows.column(c).to_numpy() for c in ("cid", "root", "n"))
    sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint16).reshape(-1, M)
    first, second = np.flatnonzero(chunk == i[0]), np.flatnonzero(chunk == j[0])
    least = THRESHOLD[0] / THRESHOLD[1]
    least -= MARGIN * np.sqrt(least * (1 - least) / M)
    found = []
    for x in first:
        fits = (root[second] != root[x]) & (THRESHOLD[1] * np.minimum(n[second], n[x]) >= THRESHOLD[0] * np.maximum(n[second], n[x]))
        others = second[fits & ((cid[second] > cid[x]) | (i[0] != j[0]))]
        # registers agree at least as often as elements are shared
        others = others[(sketches[others] == sketches[x]).sum(1) >= least * M]
        found.append(np.column_stack([np.full(len(others), x), others]))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), int)
    x, y = pairs[:, 0], pairs[:, 1]
    if len(pairs):
        alike = estimate(sketches[x], sketches[y], n[x].astype(float), n[y].astype(float)) >= least
        x, y = x[alike], y[alike]
    sets = [np.frombuffer(e.as_buffer(), np.uint64) for e in rows.column("elements")]
    linked = np.array([enough(sets[a], sets[b]) for a, b in zip(x, y, strict=True)], bool)
    return pa.table({"a": np.minimum(cid[x], cid[y])[linked], "b": np.maximum(cid[x], cid[y])[linked]})


def block_links(members: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of large bands that no hub has joined.

    Members of bands that overlap form a group; a group is cut into chunks, and each
    two chunks are compared in one task, so pairs are never rows.
    """
    hub = members.groupBy("band").agg(F.min("cid").alias("a"))
    groups = connected(members.join(hub, "band").select("a", F.col("cid").alias("b")).distinct())
    rows = members.select("cid", "root").distinct().join(groups.select(F.col("node").alias("cid"), F.col("root").alias("group")), "cid")
    rows = stage(rows.join(sketches, "cid").join(sets, "cid"), "group-members")
    weight = F.count(F.lit(1)) / CHUNK_ROWS, F.sum(F.length("elements")) / CHUNK_BYTES
    chunks = rows.groupBy("group").agg(F.ceil(F.greatest(*weight)).cast("int").alias("chunks"))
    rows = rows.join(chunks, "group").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}).drop("chunks", "other")
    return stage(rows.groupBy("group", "i", "j").applyInArrow(compare_block, "a long, b long"), "links")


def class_components(docs: DataFrame, rows: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """(node, root) for the classes that share a band with another class."""
    reps = rows.join(classes.select(F.col("cid").alias("uid")), "uid", "left_semi").filter(F.size("keys") > 0)
    reps = reps.select(F.col("uid").alias("cid"), "id", "h1", "h2", "n", "keys")
    bands = reps.select("cid", "n", F.explode("keys").alias("band"))
    shared = bands.groupBy("band").agg(F.min("cid").alias("low"), F.max("cid").alias("high"))
    shared = shared.filter("low != high").select("band", F.col("low").alias("hub"))
    # a row for each class and band value that it shares
    members = stage(bands.join(shared, "band").withColumn("root", F.col("cid")), "members")
    nodes = stage(members.select("cid").distinct(), "nodes")
    # staged, so that its size is known: texts are shuffled only where it is too large to be sent to them
    wanted = stage(reps.drop("keys", "n").join(nodes, "cid", "left_semi"), "wanted")
    sets = full_sets(docs, key, text, wanted)
    sketches = rows.select(F.col("uid").alias("cid"), "n", "sketch").join(nodes, "cid", "left_semi")
    sketches = stage(sketches, "candidate-sketches")
    labels = stage(nodes.select(F.col("cid").alias("node"), F.col("cid").alias("root")), "labels")

    # each band's hub with the others; most groups of copies are one component after it
    hubs = members.filter(F.col("cid") == F.col("hub"))
    pairs = stage(paired(hubs, members), "pairs")
    labels = relabelled(labels, links(pairs, sketches, sets))
    left = unresolved(members.filter(F.col("cid") != F.col("hub")), labels)
    small = left.filter(F.col("size") <= SMALL)
    # all further pairs of a small band, at most half of SMALL a member
    rest = stage(paired(small, small.select(*small.columns)).join(pairs, ["a", "b"], "left_anti"), "pairs")
    found = links(rest, sketches, sets)
    return relabelled(labels, found.union(block_links(left.filter(F.col("size") > SMALL), sketches, sets)))


def placed_rows(docs: DataFrame, key: str, text: str, number: Column | None = None) -> DataFrame:
    """Every row's number and id, its set's digests and size, its component's root and least id.

    Rows without shingles have no root and their own id. ``number`` tells rows apart.
    """
    rows = sketched(docs, key, text, F.monotonically_increasing_id() if number is None else number)
    digest = ["h1", "h2", "n"]
    classes = rows.filter("n > 0").groupBy(*digest).agg(F.min("uid").alias("cid"), F.min("id").alias("least"))
    classes = stage(classes, "classes")
    labels = class_components(docs, rows, classes, key, text)
    placed = classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    placed = stage(placed.withColumn("root", F.coalesce("root", "cid")), "classes")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = stage(placed.join(least, "root").select(*digest, "root", "component_id"), "classes")
    narrow = rows.select("uid", "id", *digest)
    full = narrow.filter("n > 0").join(of_class, digest)
    empty = narrow.filter("n = 0").withColumns({"root": F.lit(None).cast("long"), "component_id": F.col("id")})
    return full.unionByName(empty)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Rows whose sets share three quarters of their union are linked; ``component_id`` is
    the least id reachable by links. Null and empty texts have no shingles and are
    linked with nothing. Rows that share an id are separate rows, joined only if their
    texts are. A row without an id has the least id of its component, null if there is
    none, and is never ``kept``.
    """
    return placed_rows(docs, key, text).select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all columns: the one of the least id.

    Rows without an id come after all others in a component; of rows alike in id and
    set, one stays. Rows without words are linked with nothing and all stay.
    """
    numbered = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("uid")), "numbered")
    inner = numbered.select("uid", F.col("row").getField(key).alias("key"), F.col("row").getField(text).alias("text"))
    found = placed_rows(inner, "key", "text", F.col("uid"))
    order = F.struct(F.col("id").isNull(), F.coalesce("id", F.lit(0)), "h1", "h2", "n", "uid")
    first = found.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min_by("uid", order).alias("uid")).select("uid")
    kept = stage(first.unionByName(found.filter(F.col("root").isNull()).select("uid")), "kept")
    return numbered.join(kept, "uid", "left_semi").select("row.*")
