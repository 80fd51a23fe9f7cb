import random

import numpy as np
import pytest
from conftest import rows
from data import documents, odd_texts, prose
from pyspark.sql import functions as F

from carespan.llm import quality, toxicity

BAD = ["worthless", "stupidity", "disgusting"]


def toxic_text(i):
    r = random.Random(i)
    return " ".join(w if r.random() > 0.06 else r.choice(BAD) for w in prose(i, 120).split())


def junk(i):
    return " ".join(f"{w}{'*&$#'[k % 4] * 3}" for k, w in enumerate(prose(i, 120).split()))


def corpus(spark, bad, label):
    texts = [bad(i) if i % 3 == 0 else prose(i, 120) for i in range(400)]
    docs = spark.createDataFrame([*enumerate(texts), *((1000 + i, t) for i, t in enumerate(odd_texts()))], "doc_id long, text string")
    low = 1 if label == "toxic" else 0
    labels = spark.createDataFrame([(i, low if i % 3 == 0 else 1 - low) for i in range(400)], f"doc_id long, {label} int")
    return docs, labels


CASES = [
    (toxicity.score_toxicity, toxic_text, "toxic", 1, 0.5),
    (quality.score_quality, junk, "quality", 0, 0.3),
]


@pytest.mark.parametrize(("score", "bad", "label", "low", "cut"), CASES)
def test_held_out_documents(spark, score, bad, label, low, cut):
    docs, labels = corpus(spark, bad, label)
    got = score(docs, labels).collect()
    assert len(got) == 400 + len(odd_texts())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    right = sum(r.predicted == (low if r.doc_id % 3 == 0 else 1 - low) for r in held)
    assert len(held) > 50 and right >= 0.95 * len(held)
    by = {r.doc_id - 1000: r.score for r in got if r.doc_id >= 1000}
    assert by[0] == by[1]  # null as the empty text
    assert by[7] == by[8]


@pytest.mark.parametrize(("score", "bad", "label", "low", "cut"), CASES)
def test_learns_nothing_from_held_out_labels(spark, score, bad, label, low, cut):
    docs, labels = corpus(spark, bad, label)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn(label, F.when(held, 1 - F.col(label)).otherwise(F.col(label)))
    assert rows(score(docs, labels)) == rows(score(docs, flipped))


@pytest.mark.parametrize(("score", "label", "known"), [(toxicity.score_toxicity, "toxic", 0.0), (quality.score_quality, "quality", 1.0)])
def test_without_labels_or_rows(spark, score, label, known):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 7)], f"doc_id long, {label} int")
    docs = documents(spark).withColumns({"score": F.lit(9), "key": F.lit(9), "label": F.lit(9)})
    got = score(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert {r.score for r in got.collect()} == {known}
    assert score(docs.filter("doc_id < 0"), labels).count() == 0


def test_stages_keep_whole_rows(spark):
    docs, labels = corpus(spark, toxic_text, "toxic")
    docs = docs.withColumn("keep", F.lit("x")).unionAll(docs.withColumn("keep", F.lit("y")))
    got = toxicity.without_toxic(docs, labels)
    assert got.columns == docs.columns
    kept = {(r.doc_id, r.keep) for r in got.filter("doc_id < 400").collect()}
    assert sum(i % 3 != 0 for i, _ in kept) >= 0.97 * 2 * 266
    assert sum(i % 3 == 0 for i, _ in kept) <= 0.05 * 2 * 134
    docs, labels = corpus(spark, junk, "quality")
    kept = {r.doc_id for r in quality.without_poor(docs, labels).collect()}
    assert {i for i in range(400) if i % 3} <= kept and len([i for i in kept if i < 400]) <= 275


def test_a_toxic_window_gains(spark):
    model = toxicity.learn([(toxic_text(i).encode(), 1) for i in range(150)] + [(prose(1000 + i, 120).encode(), 0) for i in range(300)])
    assert b"worthless" in model.toxic and b"worthless" not in model.ordinary
    gains = model.gains([b"of the worthless ing er the disgusting tion ou", prose(7, 8).encode()])
    assert gains[0] > gains[1]
    texts = [b"", b"a", prose(1, 5000).encode(), toxic_text(2).encode()]
    alone = np.concatenate([model.scores([t]) for t in texts])
    assert model.scores(texts) == pytest.approx(alone)


def test_windows_cover_the_text():
    for n in (0, 1, 63, 64, 65, 96, 97, 1000):
        text = bytes(range(256)) * 4
        own = toxicity.windows(text[:n])
        covered = set()
        for i, w in enumerate(own):
            covered |= set(range(i * toxicity.STRIDE, i * toxicity.STRIDE + len(w)))
        assert covered == set(range(n))


def test_attention_gradients():
    rng = np.random.default_rng(0)
    x, sizes = rng.normal(size=(7, 5)), np.array([3, 1, 3])
    model = quality.AttentionModel.new(x)
    starts, owner = quality.layout(sizes)
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        p, _ = model.forward(x, starts, owner)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = model.gradients(x, starts, owner, y)
    for name, g in grads.items():
        at = tuple(rng.integers(0, s) for s in model.w[name].shape)
        keep = model.w[name][at]
        model.w[name][at] = keep + 1e-5
        up = loss()
        model.w[name][at] = keep - 1e-5
        down = loss()
        model.w[name][at] = keep
        assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-6), name


def test_attention_sums_to_one_and_scores_alone_as_together():
    x = np.random.default_rng(1).normal(size=(6, 5))
    model = quality.AttentionModel.new(x)
    starts, owner = quality.layout(np.array([2, 4]))
    _, c = model.forward(x, starts, owner)
    assert np.add.reduceat(c["alpha"], starts) == pytest.approx([1, 1])
    texts = [b"", b"abc def", prose(3, 900).encode()]
    model = quality.AttentionModel.new(np.concatenate([quality.passage_features(t) for t in texts]))
    assert model.scores(texts) == pytest.approx(np.concatenate([model.scores([t]) for t in texts]))
