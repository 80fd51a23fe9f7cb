import numpy as np
from pyspark.sql import functions as F

from carespan.llm import nn_descent as n


def table(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def plain(vectors, query):
    x = {i: np.array(np.float32(v), np.float64) for i, v in vectors}
    q = x[query]
    scores = [(-(q @ v) / (np.linalg.norm(q) * np.linalg.norm(v)), i) for i, v in x.items() if i != query]
    return [(i, -s) for s, i in sorted(scores)]


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(1500, 32)))]
    got = found(n.search(table(spark, vectors), F.col("vec_id") % 50 == 0))
    assert set(got) == set(range(0, 1500, 50))
    hits = 0
    for q, answer in got.items():
        best = plain(vectors, q)
        true = dict(best)
        assert len(answer) == 5
        for i, score in answer:
            assert abs(true[i] - score) < 1e-12
        hits += len({i for i, _ in answer} & {i for i, _ in best[:5]})
    assert hits >= 0.95 * 5 * len(got)


def test_recall_where_the_first_graph_is_poor(spark, monkeypatch):
    """Blocks that are small against the table: the rounds have to find the neighbours."""
    monkeypatch.setattr(n, "BLOCK", 8)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 12))
    df = table(spark, list(enumerate(x)))
    nodes, _ = n.node_table(n.usable_vectors(df, "vec_id", "embedding"), 6)
    ids = {r.node: i for r, i in ((r, tuple(r.vec)) for r in nodes.collect())}
    place = {tuple(map(float, np.float32(v))): i for i, v in enumerate(x)}
    graph = {}
    for r in n.neighbour_graph(nodes, k=10, lines=2).collect():
        graph.setdefault(place[ids[r.node]], set()).add(place[ids[r.other]])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -2)
    hits = sum(len(graph[i] & set(np.argsort(-sims[i])[:10])) for i in range(len(x)))
    assert hits >= 0.95 * 10 * len(x), hits / 10 / len(x)


def test_vectors_without_a_direction_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [(0, [1, 0]), (1, None), (2, [0, 0]), (3, [1, None]), (50, [nan, 1]), (100, [inf, 1]), (4, [0, 1]), (5, [1]), (6, [])]
    got = found(n.search(table(spark, vectors), F.col("vec_id") % 50 == 0))
    assert got == {0: [(4, 0.0)]}


def test_ties_and_copies(spark):
    vectors = [(i, [1, 2, 3]) for i in range(60)] + [(100 + i, [3, 2, 1]) for i in range(3)]
    got = found(n.search(table(spark, vectors), F.col("vec_id") % 50 == 0))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
    assert [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in got[100]] == [101, 102, 0, 1, 2]


def test_large_and_small_components(spark):
    vectors = [(0, [1e30, 1e30]), (1, [1e-30, 1e-30]), (2, [1e30, -1e30])]
    got = found(n.search(table(spark, vectors), F.col("vec_id") == 0))
    assert [i for i, _ in got[0]] == [1, 2]
    assert abs(got[0][0][1] - 1) < 1e-12


def test_fewer_candidates_than_asked_and_none(spark):
    assert found(n.search(table(spark, [(0, [1, 1]), (1, [1, 0])]), F.col("vec_id") == 0))[0][0][0] == 1
    assert n.search(table(spark, [(0, [1, 1])]), F.col("vec_id") == 0).count() == 0
    assert n.search(table(spark, []), F.col("vec_id") == 0).count() == 0
    assert n.search(table(spark, [(1, [1, 1])]), F.col("vec_id") == 0).count() == 0


def test_repeated_ids_are_separate_rows(spark):
    df = table(spark, [(0, [1, 0]), (0, [1, 0]), (1, [0, 1])]).withColumns({"uid": F.lit(1), "node": F.lit(2), "vec": F.lit(3)})
    got = n.search(df, F.col("vec_id") == 0).orderBy("rank", "vec_id").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 0), (0, 1, 0), (0, 2, 1), (0, 2, 1)]
