import random

import corpus_pipeline
import pytest
import sentencepiece
from data import SCHEMA, edited, odd_texts, prose, words
from test_classifiers import BAD, junk
from test_setsketch import plain_components

from carespan.llm import mixing
from carespan.llm.common import tokenizer_file


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(0)
    texts = []
    for i in range(500):
        text = prose(i, 80)
        if i % 10 == 1:
            text = junk(i)
        elif i % 10 == 2:
            text = " ".join(w if r.random() > 0.08 else r.choice(BAD) for w in text.split())
        elif i % 10 == 3:
            text = edited(prose(i - 3, 80), i, 0.01)
        texts.append(text)
    texts += odd_texts()
    path = tmp_path_factory.mktemp("corpus")
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 10 != 1), int(i % 10 == 2)) for i in range(500)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert docs.count() == docs.select("doc_id").distinct().count()
        seen.append({r.doc_id: r.text for r in docs.collect()})
    first, good, clean, single = seen
    lost = {i for i in first if i < 500} - {i for i in good}
    assert {i for i in range(500) if i % 10 == 1} == lost
    lost = {i for i in good if i < 500} - {i for i in clean}
    toxic = {i for i in range(500) if i % 10 == 2}
    assert len(lost & toxic) >= 0.9 * len(toxic) and len(lost - toxic) <= 10
    ids = sorted(clean)
    _, root = plain_components([clean[i] for i in ids])
    assert set(single) == {i for k, i in enumerate(ids) if root[k] == k or not words(clean[i])}
    copies = {r[0]["doc_id"]: r.copies for r in mixing.mix(docs).select("row", "copies").collect()}
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, folder)
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: c for i, c in copies.items() if c}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    for r in corpus_pipeline.STAGES[4][1](spark, mixed, folder).collect():
        assert r.ids == library.encode(single[r.doc_id] or "") and r.round_trip and r.parity


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    again = corpus_pipeline.run(spark, folder)
    assert got.count() > 100
    assert got.exceptAll(again).count() == 0 and again.exceptAll(got).count() == 0


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
