import pytest
from conftest import rows
from data import documents, prose
from pyspark.sql import functions as F

from carespan.llm import mixing


def targets(sizes, weights=(1, 2, 3), most=3):
    """Share again until no source is above its cap, as told."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level >= most * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def corpus(spark):
    texts, sources = [], []
    for i in range(600):
        sources.append([None, "a", "b", "Z", "é"][0 if i < 10 else 1 if i < 400 else 2 + i % 3])
        texts.append(None if i % 50 == 3 else prose(i, 3 + i * 7 % 40))
    data = [(i, t, s) for i, (t, s) in enumerate(zip(texts, sources, strict=True))]
    return spark.createDataFrame(data, "doc_id long, text string, source string")


def test_targets_and_taken_words(spark):
    got = mixing.mix(corpus(spark)).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert len(got) == 600
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = targets(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        taken = sum(r.copies * r["size"] for r in own)
        assert own[0].source_size == sizes[s]
        assert own[0].target == pytest.approx(want[s])
        assert abs(taken - want[s]) <= 3 * max(r["size"] for r in own)
        expected = own[0].target / own[0].source_size
        assert all(expected - 1 < r.copies < expected + 1 and r.copies <= 3 for r in own)


def test_reruns_and_layouts_agree(spark):
    df = corpus(spark)
    once = rows(mixing.mix(df).select("row.doc_id", "copies"))
    assert rows(mixing.mix(df.repartition(7)).select("row.doc_id", "copies")) == once


def test_rows_pass_whole_with_clashing_columns(spark):
    df = documents(spark).withColumns({c: F.lit(c) for c in ("size", "copies", "row", "at", "piece", "missing")})
    got = mixing.mixed_rows(df)
    assert got.columns == df.columns
    assert got.filter("piece != 'piece'").count() == 0


def test_repeated_rows_are_separate(spark):
    df = documents(spark, ["a b c"] * 50)
    assert mixing.mix(df.union(df)).count() == 100


@pytest.mark.parametrize("texts", [[], [None, "", " "]])
def test_nothing_to_mix(spark, texts):
    got = mixing.mix(documents(spark, texts)).select("size", "source_size", "target", "copies")
    assert rows(got) == [(0, 0, 0.0, 0)] * len(texts)


def test_rows_are_shuffled_once(spark):
    """What is joined to the wide rows has a known size, and is sent to them."""
    plan = mixing.mix(corpus(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
