"""Token ids as binary files with keyed access through minimal perfect hashes.

Layout of a folder:

* ``ids/``: raw shards in ascending key order. A shard is a header, the keys and
  lengths of its documents and then nothing but their ids, 2 or 4 bytes each, and a
  line feed that the writer puts at a file's end. Shards end at a number of ids, so a
  long document makes a long shard, but none is ever split.
* ``index/``: Parquet rows (bucket, blob), sorted by bucket. A key's digest names its
  bucket; the bucket's minimal perfect hash names one slot; the slot holds a 32-bit
  fingerprint of the key, the shard, and where in its ids the document begins and how
  many ids it has. So an access reads one blob and one shard, however many keys there are.
* ``shards/``: Parquet rows (piece, seq, path, start, n_ids): each shard's file, and the
  number of ids in all shards before it.

The hash is built level by level: keys that are alone at their place in a bit array are
settled, the others go on to the next, smaller array; a settled key's slot is the number
of set bits before its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carespan.llm.common import kept_text
from carespan.llm.word_cache import of_tokenizer

MAGIC = b"TOKIDS01"
HEADER = np.dtype([("magic", "S8"), ("width", "<u4"), ("piece", "<u4"), ("seq", "<u4"), ("docs", "<u8"), ("ids", "<u8")])
SLOT = np.dtype([("mark", "<u4"), ("piece", "<u4"), ("seq", "<u4"), ("at", "<u8"), ("n", "<u8")])
GAMMA = 2.0  # bits of a level for each key that reaches it
BLOCK = 512  # bits between stored counts


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """64-bit digests of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 0) >> np.uint64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    """Maps each of n distinct keys to its own slot in 0..n-1; other keys anywhere, or -1."""

    sizes: list[int]  # bits of each level
    bits: np.ndarray  # of all levels, one after another

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], np.asarray(keys, np.int64)
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            at = (mixed(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    @cached_property
    def before(self) -> np.ndarray:
        """Set bits before each block."""
        padded = np.pad(self.bits, (0, -len(self.bits) % BLOCK)).reshape(-1, BLOCK)
        return np.concatenate([[0], np.cumsum(padded.sum(1))])

    def slots(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys, np.int64)
        place, base = np.full(len(keys), -1, np.int64), 0
        for level, size in enumerate(self.sizes):
            open_ = np.flatnonzero(place < 0)
            at = base + (mixed(keys[open_], level + 1) % np.uint64(size)).astype(np.int64)
            place[open_] = np.where(self.bits[at], at, -1)
            base += size
        return np.array([self.rank(p) if p >= 0 else -1 for p in place], np.int64)

    def rank(self, place: int) -> int:
        block = place // BLOCK
        return int(self.before[block] + np.count_nonzero(self.bits[block * BLOCK : place]))

    def to_bytes(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], "<u8").tobytes() + np.packbits(self.bits).tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> tuple[PerfectHash, int]:
        """The hash and the number of bytes it took."""
        n = int(np.frombuffer(blob, "<u8", 1)[0])
        sizes = np.frombuffer(blob, "<u8", n, 8).astype(int).tolist()
        start, size = 8 * (n + 1), sum(sizes)
        end = start + (size + 7) // 8
        return cls(sizes, np.unpackbits(np.frombuffer(blob[start:end], np.uint8), count=size).astype(bool)), end


def index_blob(keys: np.ndarray, slots: np.ndarray) -> bytes:
    """A bucket's hash and its filled slots; ``slots`` comes in the order of ``keys``."""
    hashed = PerfectHash.build(keys)
    table = np.zeros(len(keys), SLOT)
    table[hashed.slots(keys)] = slots
    return hashed.to_bytes() + table.tobytes()


def find_keys(blob: bytes, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the keys, and whether each key is there (by its fingerprint)."""
    hashed, end = PerfectHash.from_bytes(blob)
    table = np.frombuffer(blob, SLOT, offset=end)
    at = hashed.slots(keys)
    found = table[np.maximum(at, 0)]
    return found, (at >= 0) & (found["mark"] == fingerprint(np.asarray(keys, np.int64)))


@dataclass
class Shard:
    piece: int
    seq: int
    known: np.ndarray  # whether a document has a key
    keys: np.ndarray
    lengths: np.ndarray
    ids: np.ndarray  # all documents' ids in a row

    def to_bytes(self) -> bytes:
        head = np.array([(MAGIC, self.ids.itemsize, self.piece, self.seq, len(self.keys), len(self.ids))], HEADER)
        return b"".join(
            [head.tobytes(), self.known.astype(np.uint8).tobytes(), self.keys.astype("<i8").tobytes(), self.lengths.astype("<u8").tobytes(), self.ids.tobytes()]
        )

    @classmethod
    def from_bytes(cls, blob: bytes) -> Shard:
        head = np.frombuffer(blob, HEADER, 1)[0]
        if head["magic"] != MAGIC:
            raise ValueError("not a shard of token ids")
        n, at = int(head["docs"]), HEADER.itemsize
        known = np.frombuffer(blob, np.uint8, n, at).astype(bool)
        keys = np.frombuffer(blob, "<i8", n, at + n)
        lengths = np.frombuffer(blob, "<u8", n, at + 9 * n).astype(np.int64)
        ids = np.frombuffer(blob, f"<u{head['width']}", int(head["ids"]), at + 17 * n)
        return cls(int(head["piece"]), int(head["seq"]), known, keys, lengths, ids)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths


def encoder(tokenizer_path: str, end_id: int, shard_ids: int):
    """Encodes rows (key, text) and packs them into shards, in the order they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, piece, seq = of_tokenizer(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], words.dtype).tobytes()
        keys: list[int | None] = []
        parts: list[bytes] = []
        size = 0

        def shard() -> pa.RecordBatch:
            known = np.array([k is not None for k in keys], bool)
            blob = b"".join(parts)
            out = Shard(
                piece, seq, known, np.array([k or 0 for k in keys], np.int64),
                np.array([len(p) // words.dtype.itemsize for p in parts], np.int64), np.frombuffer(blob, words.dtype),
            )
            return pa.RecordBatch.from_arrays([pa.array([out.to_bytes()], pa.binary())], ["blob"])

        for b in batches:
            texts = (t.as_py() for t in b.column(1))
            for key, ids in zip(b.column(0).to_pylist(), words.encode(texts), strict=True):
                keys.append(key)
                parts.append(ids + end)
                size += len(parts[-1])
                if size >= shard_ids * words.dtype.itemsize:
                    yield shard()
                    keys, parts, size, seq = [], [], 0, seq + 1
        if keys:
            yield shard()

    return run


ENTRY = "piece int, seq int, path string, row long, key long, at long, n long, ids_crc32 long"


def read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document of the shards, with the checksum of its ids."""
    for b in batches:
        for path, blob in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
            s = Shard.from_bytes(blob.as_buffer())
            ids, n = s.ids.astype("<u4"), len(s.keys)
            sums = [zlib.crc32(ids[i : i + k]) for i, k in zip(s.starts.tolist(), s.lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, s.piece, np.int32)),
                    pa.array(np.full(n, s.seq, np.int32)),
                    pa.array([path] * n, pa.string()),
                    pa.array(np.arange(n, dtype=np.int64)),
                    pa.array(s.keys, pa.int64(), mask=~s.known),
                    pa.array(s.starts),
                    pa.array(s.lengths),
                    pa.array(sums, pa.int64()),
                ],
                ["piece", "seq", "path", "row", "key", "at", "n", "ids_crc32"],
            )


def build_bucket(rows: pa.Table) -> pa.Table:
    slots = np.zeros(rows.num_rows, SLOT)
    keys = rows.column("key").to_numpy()
    slots["mark"] = fingerprint(keys)
    for name in ("piece", "seq", "at", "n"):
        slots[name] = rows.column(name).to_numpy()
    return pa.table({"bucket": rows.column("bucket").slice(0, 1), "blob": pa.array([index_blob(keys, slots)], pa.binary())})


def look_up_bucket(wanted: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    keys = wanted["key"].to_numpy(np.int64)
    slots, there = np.zeros(len(keys), SLOT), np.zeros(len(keys), bool)
    if len(index):
        slots, there = find_keys(index["blob"].iloc[0], keys)
    out = pd.DataFrame({"key": keys, "found": there})
    for name in ("piece", "seq", "at", "n"):
        out[name] = slots[name].astype(np.int64)
    return out


@dataclass
class TokenFiles:
    """A written folder. Everything below is read from its files."""

    spark: SparkSession
    folder: str
    buckets: int

    @classmethod
    def write(
        cls,
        docs: DataFrame,
        folder: str,
        *,
        tokenizer_path: str,
        key: str = "doc_id",
        text: str = "text",
        end_id: int = 0,
        shard_ids: int = 1_000_000,
        bucket_keys: int = 2_000,
    ) -> TokenFiles:
        """Encode ``docs`` in ascending key order, ``end_id`` after each document.

        A null text is empty: its ids are the end alone. Rows without a key come first
        and cannot be looked up. Rows that share a key are all written, in an order
        that their text settles; the key leads to the first of them. An empty table
        makes no shard. A lost executor's task is run again and its files replaced.
        """
        spark = docs.sparkSession
        # bounds are drawn before the texts are encoded, so each is encoded once
        rows = docs.select(F.col(key).cast("long").alias("key"), kept_text(F.col(text)).alias("text"))
        line = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
        rows = rows.repartitionByRange(*line[:2]).sortWithinPartitions(*line)
        blobs = rows.mapInArrow(encoder(tokenizer_path, end_id, shard_ids), "blob binary")
        # a text writer writes bytes as they are; one row a file
        blobs.select(F.col("blob").cast("string")).write.option("maxRecordsPerFile", 1).text(f"{folder}/ids")

        out = cls(spark, folder, 0)
        out.documents().drop("ids_crc32").write.parquet(f"{folder}/entries")
        entries = spark.read.parquet(f"{folder}/entries")
        out._write_shards(entries)
        out.buckets = max(1, -(-entries.count() // bucket_keys))
        place = F.struct("piece", "seq", "row", "at", "n")
        first = entries.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min(place).alias("place"))
        index = (
            first.select("key", "place.*", out._bucket().alias("bucket"))
            .groupBy("bucket")
            .applyInArrow(build_bucket, "bucket long, blob binary")
        )
        index.repartitionByRange("bucket").sortWithinPartitions("bucket").write.parquet(f"{folder}/index")
        return out

    def _bucket(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets))

    def _write_shards(self, entries: DataFrame) -> None:
        """Running totals: over pieces (one row a shuffle partition), then inside each."""
        shards = entries.groupBy("piece", "seq", "path").agg(F.sum("n").alias("n_ids"))
        before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        pieces = shards.groupBy("piece").agg(F.sum("n_ids").alias("total"))
        pieces = pieces.select("piece", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
        inside = Window.partitionBy("piece").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
        shards.join(pieces, "piece").select("piece", "seq", "path", start.alias("start"), "n_ids").write.parquet(
            f"{self.folder}/shards"
        )

    def documents(self) -> DataFrame:
        """Every document of the files: shard, place and checksum of its ids."""
        files = self.spark.read.format("binaryFile").load(f"{self.folder}/ids").filter(F.col("length") > 0)
        return files.select("path", "content").mapInArrow(read_shards, ENTRY)

    def look_up(self, keys: DataFrame) -> DataFrame:
        """(key, found, piece, seq, at, n) for each key, by the index alone.

        A key that was never written is taken for another once in 2**32 times.
        """
        wanted = keys.filter(F.col("key").isNotNull()).select("key", self._bucket().alias("bucket"))
        index = self.spark.read.parquet(f"{self.folder}/index")
        return (
            wanted.groupBy("bucket")
            .cogroup(index.groupBy("bucket"))
            .applyInPandas(look_up_bucket, "key long, found boolean, piece long, seq long, at long, n long")
        )

    def get(self, key: int) -> np.ndarray | None:
        """The ids of one document: one index row, one shard."""
        bucket = self.spark.range(1).select(F.lit(key).cast("long").alias("key")).select(self._bucket()).first()[0]
        row = self.spark.read.parquet(f"{self.folder}/index").filter(F.col("bucket") == bucket).first()
        if row is None:
            return None
        slots, there = find_keys(bytes(row.blob), np.array([key], np.int64))
        if not there[0]:
            return None
        shards = self.spark.read.parquet(f"{self.folder}/shards")
        here = (F.col("piece") == int(slots["piece"][0])) & (F.col("seq") == int(slots["seq"][0]))
        blob = self.spark.read.format("binaryFile").load(shards.filter(here).first().path).first().content
        at, n = int(slots["at"][0]), int(slots["n"][0])
        return Shard.from_bytes(bytes(blob)).ids[at : at + n]

    def report(self, keys: DataFrame) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32, indexed) of each document in the files.

        ``keys`` (column ``key``) are looked up through the index; ``indexed`` says
        whether the place that the index gives is where the document lies. Of rows
        that share a key only the first is indexed.
        """
        found = self.look_up(keys.distinct()).filter("found").select("key", "piece", "seq", "at", F.col("n").alias("looked"))
        shards = self.spark.read.parquet(f"{self.folder}/shards").select("piece", "seq", "start")
        documents = self.documents().drop("path").join(shards, ["piece", "seq"])
        same = ["key", "piece", "seq", "at"]
        return documents.join(found, same, "left").select(
            F.col("key").alias("doc_id"),
            (F.col("start") + F.col("at")).alias("start"),
            F.col("n").alias("n_tokens"),
            "ids_crc32",
            (F.coalesce(F.col("looked") == F.col("n"), F.lit(False))).alias("indexed"),
        )


def checked(report: DataFrame) -> dict[str, Any]:
    """How many documents the index led to, of how many."""
    return report.agg(F.count(F.lit(1)).alias("documents"), F.count_if("indexed").alias("indexed")).first().asDict()
