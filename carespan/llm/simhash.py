"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint has one bit for each bit of a 64-bit digest: set where over half of the
digests of the text's word shingles have it set. Two texts are linked if their
fingerprints differ in at most RADIUS bits.

Equal fingerprints are one row from the start. A fingerprint is cut into segments; if two
of them differ in few bits, they differ in very few in one segment at least. So each
fingerprint asks, in a table of segment values, for all values of a small Hamming ball
around its own, and whole distances decide. Of two fingerprints the one with the lower
segment value asks. Few fingerprints with one segment value are met by a join; many, in
blocks of two chunks inside tasks, which give a spanning forest of a block's links, so that
pairs of a large group are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import kept_text
from carespan.llm.graph import components
from carespan.plans.skew import attach, row_count
from carespan.sources.staging import stage

WIDTH, SEED = 4, 42  # words of a shingle; seed of the digests
RADIUS = 4  # bits in which linked fingerprints may differ
SEGMENTS = 3  # about 64 / log2(different fingerprints) keeps a segment value's rows few
SMALL = 64  # fingerprints of a segment value that are met by a join
CHUNK = 4096  # fingerprints on a side of a block
SHINGLES = 1 << 16  # digests that are counted at once
ROWS_A_TASK = 1_000_000  # of one fingerprint, above which its documents are dealt out
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_digests(text: bytes) -> np.ndarray:
    """The digest of each shingle of a text, repeats included."""
    words = text.translate(_LOWER).split()  # at space, tab, LF, VT, FF and CR
    if not words:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= WIDTH:
        return np.array([digest(line, SEED)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    spans = zip([0, *ends], ends[WIDTH - 1 :], strict=False)
    return np.fromiter((digest(line[a : b - 1], SEED) for a, b in spans), np.uint64, len(words) - WIDTH + 1)


def set_bits(digests: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each bit is set in the digests from each start to the next."""
    bits = np.unpackbits(digests.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """The fingerprint of each text; zero for a text without words."""
    sizes, counts = np.zeros(len(texts), np.int64), np.zeros((len(texts), 64), np.int64)
    parts, owners, held = [], [], 0
    for i, text in enumerate(texts):
        digests = shingle_digests(text)
        sizes[i] = len(digests)
        for at in range(0, len(digests), SHINGLES):
            parts.append(digests[at : at + SHINGLES])
            owners.append(i)
            held += len(parts[-1])
        if parts and (held >= SHINGLES or i + 1 == len(texts)):
            starts = np.cumsum([0, *[len(p) for p in parts[:-1]]])
            np.add.at(counts, owners, set_bits(np.concatenate(parts), starts))
            parts, owners, held = [], [], 0
    if parts:
        starts = np.cumsum([0, *[len(p) for p in parts[:-1]]])
        np.add.at(counts, owners, set_bits(np.concatenate(parts), starts))
    ones = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").reshape(-1).view(np.uint64)


def fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, fp)."""
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            b = whole.slice(at, 500)
            texts = b.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fingerprints(texts).view(np.int64))], ["id", "fp"])


def segment_bounds(segments: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius of the ball) of each segment.

    With RADIUS = segments * q + a, two fingerprints within RADIUS are within q in one of
    the first a + 1 segments, or within q - 1 in one of the rest.
    """
    q, a = divmod(RADIUS, segments)
    edges = [64 * i // segments for i in range(segments + 1)]
    radii = [q if i <= a else q - 1 for i in range(segments)]
    return [(lo, hi - lo, r) for lo, hi, r in zip(edges, edges[1:], radii, strict=False) if r >= 0]


def segment_value(c: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(c, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def segment_key(number: int, value: Column) -> Column:
    """A segment's value with the segment's number above it; a segment has 32 bits at most."""
    return value.bitwiseOR(F.lit(number << 40).cast("long"))


def table_rows(prints: DataFrame, segments: int) -> DataFrame:
    """(key, fp): each fingerprint under the value of each of its segments."""
    keys = [segment_key(i, segment_value(F.col("fp"), lo, n)) for i, (lo, n, _) in enumerate(segment_bounds(segments))]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def larger_keys(number: int, value: Column, masks: Column) -> Column:
    """The keys of the values that differ from ``value`` by a mask and are larger."""
    others = F.filter(F.transform(masks, lambda m: value.bitwiseXOR(m)), lambda x: x > value)
    return F.transform(others, lambda x: segment_key(number, x))


def ball_rows(prints: DataFrame, segments: int) -> DataFrame:
    """(key, fp): each fingerprint under the larger other values of its segments' balls."""
    keys = F.array().cast("array<long>")
    for i, (lo, n, radius) in enumerate(segment_bounds(segments)):
        flips = [sum(1 << b for b in bits) for k in range(1, radius + 1) for bits in combinations(range(n), k)]
        if flips:
            value = segment_value(F.col("fp"), lo, n)
            masks = F.array(*[F.lit(m).cast("long") for m in flips])
            keys = F.concat(keys, larger_keys(i, value, masks))
    return prints.select(F.explode(keys).alias("key"), "fp")


def close(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= RADIUS


def forest(rows: pa.Table) -> pa.Table:
    """Links that join what all links between the two chunks of a block join.

    Rows with ``asks`` are one side of the block, the others the other side.
    """
    asks = rows.column("asks").to_numpy().astype(bool)
    fp = rows.column("fp").to_numpy().view(np.uint64)
    left, right = np.unique(fp[asks]), np.unique(fp[~asks])
    label = np.unique(np.concatenate([left, right]), return_inverse=True)[1]  # one label for both copies of a print
    of_left, of_right = label[: len(left)].copy(), label[len(left) :].copy()
    found_a, found_b = [], []
    for at in range(0, len(left), 256):
        near = np.bitwise_count(left[at : at + 256, None] ^ right[None, :]) <= RADIUS
        for x in np.flatnonzero(near.any(1)):
            others = np.flatnonzero(near[x])
            own = of_left[at + x]
            groups, first = np.unique(of_right[others], return_index=True)
            new = groups != own
            if not new.any():
                continue
            found_a.append(np.full(new.sum(), left[at + x]))
            found_b.append(right[others[first[new]]])
            of_left[np.isin(of_left, groups[new])] = own
            of_right[np.isin(of_right, groups[new])] = own
    a, b = (np.concatenate(f).view(np.int64) if f else np.zeros(0, np.int64) for f in (found_a, found_b))
    return pa.table({"a": a, "b": b})


def block_links(asked: DataFrame, table: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links between what asks for large segment values and what they hold.

    Both sides of a value are dealt into chunks, and each two chunks meet in one task.
    """
    asked = stage(asked.join(sizes, "key").withColumn("asks", F.lit(True)), "asked")
    askers = asked.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("askers"))
    sizes = sizes.join(askers, "key").withColumn("holders", F.ceil(F.col("held") / CHUNK).cast("int"))
    dealt = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    met = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = asked.drop("held").join(sizes, "key").withColumns({"i": dealt("askers"), "j": met("holders")})
    other = table.join(sizes, "key").withColumn("asks", F.lit(False)).withColumns({"i": met("askers"), "j": dealt("holders")})
    names = ["key", "i", "j", "fp", "asks"]
    return one.select(*names).union(other.select(*names)).groupBy("key", "i", "j").applyInArrow(forest, "a long, b long")


def links(prints: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a, b) of different fingerprints within RADIUS that join all such pairs."""
    table = stage(table_rows(prints, segments), "segments")
    large = table.groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > SMALL)
    large = stage(large, "large-segments")
    asked = stage(ball_rows(prints, segments), "balls")
    few = table.join(large, "key", "left_anti").withColumnRenamed("fp", "b")
    asks = asked.withColumnRenamed("fp", "a").join(few, "key").filter(close(F.col("a"), F.col("b")))
    own = few.withColumnRenamed("b", "a").join(few, "key").filter((F.col("a") < F.col("b")) & close(F.col("a"), F.col("b")))
    found = asks.select("a", "b").union(own.select("a", "b"))
    return found.union(block_links(asked.union(table), table, large)).distinct()


def with_components(rows: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """(fp, id, component_id) for every row (id, fp), which can be read more than once."""
    prints = stage(rows.groupBy("fp").agg(row_count(), F.min("id").alias("least")), "prints")
    labels = components(links(prints.select("fp"), segments)).withColumnRenamed("node", "fp")
    rooted = prints.join(labels, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stage(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return attach(rows, rooted.drop("least").join(least, "root").drop("root"), ["fp"], limit=ROWS_A_TASK)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", segments: int = SEGMENTS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the least id reachable by
    links. Null and empty texts, and those of white space only, have the fingerprint zero,
    and are linked like any other. A very long text is counted piece by piece, so its
    digests alone are held at once. Rows that share an id are rows of their own; rows
    without an id take part and have the least id of their component, null if there is
    none. Other columns are not read, whatever their names. An empty table gives no rows.
    The result does not depend on ``segments``.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), kept_text(F.col(text)).alias("text"))
    rows = stage(rows.mapInArrow(fingerprint_rows, "id long, fp long"), "fingerprints")
    return with_components(rows, segments).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
