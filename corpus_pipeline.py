"""A corpus pipeline over ``documents``: stages of the operators in ``carespan.llm``.

Each stage works on all that the one before it kept, and is written as Parquet and
read again, so a lost executor costs a stage's own tasks only.

In every stage but the last a row is kept or dropped whole, with all columns of
``documents``, whatever other columns there are. A null text counts as empty; very long
texts are worked on whole; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carespan.llm import mixing, quality, sentencepiece_codec, setsketch, toxicity
from carespan.llm.common import small_batches, table, tokenizer_file
from carespan.sources.staging import new_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects.

    Empty texts have a score like any other. Rows alike in text stay or go together,
    whatever their ids; ids decide only which labelled rows the classifier learns from.
    """
    small_batches(spark)
    return quality.without_poor(docs, table(spark, sf_dir, "labels"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity classifier rejects.

    Empty texts have a score like any other; rows alike in text stay or go together.
    """
    small_batches(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least id.

    Texts without words are no duplicates and stay. Of rows that share the least id and the
    text one stays; rows without an id come after all others.
    """
    small_batches(spark)
    return setsketch.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight says, none included.

    Rows without a source are a source of their own. An empty text takes no words, and is
    taken as often as others of its source; a source of empty texts alone is not taken.
    Ties in size are ordered by id, so that a second run gives the same rows.
    """
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them; empty texts have none.

    Rows are encoded one by one, repeated ones too.
    """
    small_batches(spark)
    encoded = sentencepiece_codec.encode_rows(docs, tokenizer_file("piece_bpe_32k.model"))
    return encoded.drop("text", "n_chars")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_dedup", keep_one_of_each),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: a classifier's and a sketch's decisions have no SQL; tests compare with plain programs
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
