"""What the operators of this subpackage share."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: a word is a run of anything but space, tab, line feed, vertical tab, form feed, return
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies: in the folder TOKENIZER_FOLDER, if set, or that of the package."""
    folder = os.environ.get("TOKENIZER_FOLDER")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    return F.translate(c, UPPER, LOWER)


def id_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; an id of null counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def kept_text(c: Column) -> Column:
    """Null is the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, *, fold: int = 5, per_class: int, longest: int = 100_000
) -> list[tuple[bytes, int]]:
    """A bounded sample of (text, label) to fit a classifier on, the same in every run.

    Only ids whose crc32 is no multiple of ``fold`` are taken: of each class the
    ``per_class`` of smallest digest, with texts of up to ``longest`` bytes. At most
    2 * per_class texts come to the driver. A document with both labels counts as 1.
    Equal texts come once.
    """
    usable = labels.filter((id_remainder(F.col("doc_id"), fold) != 0) & F.col(label).isin(0, 1))
    usable = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    digest = F.xxhash64("doc_id")
    chosen = None
    for value in (0, 1):
        some = usable.filter(F.col("label") == value).orderBy(digest, "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.union(some)
    rows = (
        docs.select("doc_id", kept_text(F.col("text")).alias("text"))
        .filter(F.octet_length("text") <= longest)
        .join(F.broadcast(chosen), "doc_id")  # 2 * per_class short rows
        .orderBy(digest, "doc_id", F.xxhash64("text"))
        .limit(2 * per_class)
        .collect()
    )
    found = {r.text.encode(): r.label for r in rows}
    return list(found.items())


def small_batches(spark: SparkSession) -> None:
    """Sends few texts at a time to Python from now on: the buffers on both sides stay small.

    By default a batch may be ten thousand texts, or 64 MB, on its way in and again out.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def small_slices(batches, rows: int = 500):
    """Batches in slices, so that few texts are unpacked at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def score_texts(docs: DataFrame, score, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, score): ``score`` gets a list of whole texts as bytes, null as empty."""

    def run(batches):
        for b in small_slices(batches):
            texts = [t.encode() for t in b.column(1).to_pylist()]
            s = pa.array(np.asarray(score(texts), np.float64), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), s], ["key", "score"])

    rows = docs.select(F.col(key).alias("key"), kept_text(F.col(text)).alias("text"))
    return rows.mapInArrow(run, rows.drop("text").schema.add("score", "double"))


def keep_rows(docs: DataFrame, keep, *, text: str = "text") -> DataFrame:
    """The rows whose text ``keep`` says to keep; it gets a list of texts as bytes.

    The rows pass through the function whole, so no key has to be unique.
    """

    def run(batches):
        for b in small_slices(batches):
            texts = [(t or "").encode() for t in b.column(text).to_pylist()]
            yield b.filter(pa.array(np.asarray(keep(texts), bool)))

    return docs.mapInArrow(run, docs.schema)
