import zlib

import numpy as np
import pytest
from conftest import rows
from data import documents, odd_texts
from pyspark.sql import functions as F

from carespan.llm import token_files as t
from carespan.llm import word_cache
from carespan.llm.common import tokenizer_file
from carespan.sources.staging import new_path

PATH = tokenizer_file("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def write(spark, df, **options):
    return t.TokenFiles.write(df, new_path(spark, "tokens"), tokenizer_path=PATH, **options)


def test_every_document_comes_back(spark, plain):
    texts = odd_texts()
    df = documents(spark, texts).repartition(3)
    files = write(spark, df, shard_ids=300, bucket_keys=4)
    got = {r.doc_id: r for r in files.report(df.select(F.col("doc_id").alias("key"))).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = np.array([*plain(text), 0], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        assert got[i].indexed
        start += len(ids)
    for i in (0, 7, 13):
        assert files.get(i).tolist() == [*plain(texts[i]), 0]
    assert files.get(10**9) is None
    assert t.checked(files.report(df.select(F.col("doc_id").alias("key")))) == {"documents": len(texts), "indexed": len(texts)}


def test_missing_keys_are_not_found(spark):
    files = write(spark, documents(spark))
    found = files.look_up(spark.range(10_000, 12_000).select(F.col("id").alias("key"))).filter("found")
    assert found.count() == 0


def test_repeated_and_missing_ids(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c"), (0, None)], "doc_id long, text string")
    got = write(spark, df.withColumn("key", F.lit("x"))).report(df.select(F.col("doc_id").alias("key")))
    assert rows(got, "doc_id", "start", "n_tokens", "indexed") == [
        (None, 0, 2, False), (None, 2, 2, False), (0, 4, 1, True), (1, 5, 2, True), (1, 7, 2, False),
    ]


def test_empty_table(spark):
    df = documents(spark, [])
    assert write(spark, df).report(df.select(F.col("doc_id").alias("key"))).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 50, 5000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(2**62, n, replace=False) - 2**61
    hashed = t.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(n))
    again, size = t.PerfectHash.from_bytes(hashed.to_bytes() + b"rest")
    assert again.slots(keys).tolist() == hashed.slots(keys).tolist()
    assert size == len(hashed.to_bytes())


def test_shard_round_trip():
    s = t.Shard(3, 4, np.array([True, False]), np.array([-5, 0]), np.array([2, 1]), np.array([1, 2, 65000], "<u2"))
    back = t.Shard.from_bytes(s.to_bytes() + b"\n")
    assert (back.piece, back.seq, back.known.tolist(), back.keys.tolist()) == (3, 4, [True, False], [-5, 0])
    assert (back.lengths.tolist(), back.ids.tolist(), back.starts.tolist()) == ([2, 1], [1, 2, 65000], [0, 2])
    with pytest.raises(ValueError, match="shard"):
        t.Shard.from_bytes(b"x" * 100)


def test_word_cache_encodes_as_the_library(plain):
    words = word_cache.of_tokenizer(PATH)
    odd = [
        "", " ", "  a", "a  b", "a\n b", "a \n\n b", "a\t b c  ", "it's I'll 12 a1 _b b_ c", "\u3000a\u3000 b\x85 c\x1c d",
        " \u00e9 n\u0301 \u00df", "a" * 50 + " " + "b" * 50 + "\r\n\r\n  ", "l' 's 't ' s", "x\u0250y \u0250 \u4e00a a\u4e00", "ʰa aʰ ªb",
    ]
    texts = [*odd, *(x or "" for x in odd_texts())]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(ids, words.dtype).tolist() == plain(text), text[:40]


def test_word_cache_forgets(monkeypatch, plain):
    monkeypatch.setattr(word_cache, "WORDS_KEPT", 3)
    monkeypatch.setattr(word_cache, "GROUP_CHARS", 5)
    words = word_cache.of_tokenizer.__wrapped__(PATH)
    texts = ["the cat sat", "on the mat", "the end of it", "cat the"] * 3
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(ids, words.dtype).tolist() == plain(text)
    assert len(words.known) <= 8


def test_a_word_is_merged_once_whatever_stands_behind_it(plain):
    from tokenizers import Tokenizer

    tokenizer, asked = Tokenizer.from_file(PATH), []

    class Counted:
        encode_batch_fast = tokenizer.encode_batch_fast

        class model:
            @staticmethod
            def tokenize(word):
                asked.append(word)
                return tokenizer.model.tokenize(word)

    encode = word_cache.word_encoder(Counted, np.dtype("<u2"))
    parts = [" straße", " straße,", " straße.\n\n", ",\n", "", " a\nb", " naïve 7", " 漢字", " x"]
    for some in (parts, [" straße;", " x!", " straße"], []):
        assert encode(some) == [np.array(plain(p), "<u2").tobytes() for p in some]
    assert len(asked) == len(set(asked)) == 4
