import re
from collections import Counter

import numpy as np
import pytest
from data import CAPITALS, documents, edited, odd_texts, prose

from carespan.llm import stripes


def plain(rows, best=2000):
    """The contract by counting phrases of one to three words."""
    counts = {}
    for lang, text in rows:
        f = counts.setdefault(lang or "und" if lang != "" else "", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(CAPITALS)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                f.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        longer = [p for p, c in f.items() if len(p) == 3 and c >= 10]
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < 10:
                continue
            if len(p) == 2 and any(p in (q[:2], q[1:]) and 100 * f[q] >= 50 * a for q in longer):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def corpus():
    r = np.random.default_rng(4)
    words = ["the", "of", "new", "York", "city", "hall", "Ana", "über", "漢字", "a", "a b", "x"]
    texts = []
    for i in range(120):
        t = " ".join(r.choice(words, 80, p=np.arange(1, 13) / 78))
        texts.append(t.replace("hall x", "hall. x").replace("the", "The" if i % 2 else "the\t"))
    texts += ["a a a a a a a a a a a a a a a", "San  Francisco bay,\nSan Francisco Bay\x0bx! y?" * 12, *odd_texts()]
    return texts


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_counts(spark, monkeypatch, small):
    if small:  # many slices and buckets, all stripes dealt out, few mark bits
        monkeypatch.setattr(stripes, "SLICE", 3000)
        monkeypatch.setattr(stripes, "BUCKET_WORDS", 700)
        monkeypatch.setattr(stripes, "HOT_WORD", 5)
        monkeypatch.setattr(stripes, "SHARDS", 3)
        monkeypatch.setattr(stripes, "MARK_BITS", (1, 6))
    df = documents(spark, corpus()).repartition(3)
    want = plain([(r.lang, r.text) for r in df.collect()])
    assert rows_of(stripes.collocations(df)) == want
    assert {w[0] for w in want} == {"en", "und"} and len(want) > 50


def test_best_are_cut_by_order(spark):
    df = documents(spark, corpus())
    assert rows_of(stripes.collocations(df, best=7)) == plain([(r.lang, r.text) for r in df.collect()], 7)


def test_odd_tables(spark):
    schema = "lang string, text string, word string, n int, id string, bucket int, a int, first string"
    odd = [(None, "one two three. " * 20, "w", 1, "i", 1, 1, "f"), ("und", "One two", "w", 1, "i", 1, 1, "f"), ("", "one two " * 30, "w", 1, "i", 1, 1, "f"), ("xx", None, "", 0, "", 0, 0, ""), ("yy", " .\n", "", 0, "", 0, 0, "")]
    df = spark.createDataFrame(odd, schema)
    assert rows_of(stripes.collocations(df)) == plain([r[:2] for r in odd])
    assert stripes.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert stripes.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).collect() == []


def test_long_text_and_copies(spark):
    long = prose(3, 30_000)
    texts = [long, edited(long, 2, 0.3), *["the same few words again"] * 40]
    df = documents(spark, texts)
    assert rows_of(stripes.collocations(df)) == plain([(r.lang, r.text) for r in df.collect()])


def test_scores_pass_64_bits(spark):
    one = spark.createDataFrame([(2 * 10**12, 5 * 10**12, 7 * 10**12)], "a long, l1 long, r1 long")
    got = one.select(stripes.cut("l1", "r1", 1).alias("c")).first().c
    assert got.score == 10**6 * (2 * 10**12) ** 2 // (35 * 10**24)


def test_digest_is_spark_xxhash64(spark):
    import xxhash

    words = ["", "a", "über", "x" * 100, "漢字\n1"]
    got = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("xxhash64(w) AS h").collect()
    assert [r.h % 2**64 for r in got] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_marks_hold_what_they_were_given(spark):
    words = spark.range(0, 10_000, 7).selectExpr("xxhash64(id) AS id")
    found = stripes.marks(words, 1429)
    ids = np.array([r.id for r in words.collect()], np.int64)
    others = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    assert found.holds(ids).all() and found.holds(others).mean() < 0.1
