import hashlib
import math

import numpy as np
import pytest

from carespan.llm import cover_lloyd

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, rounds=6):
    """The contract, vector by vector and entry by entry."""
    kept = [
        (i, label, [math.floor(4096 * float(np.float32(x))) for x in v])
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) if kept else 8
    kept = [r for r in kept if len(r[2]) == width]
    cut = [(width * p // 8, width * (p + 1) // 8) for p in range(8)]
    books = [[q[a:b] for _, _, q in kept[:16]] for a, b in cut]

    def best(part, book):
        d = [sum((x - y) ** 2 for x, y in zip(part, e, strict=True)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p, (a, b) in enumerate(cut):
            groups = {}
            for _, _, q in kept:
                groups.setdefault(best(q[a:b], books[p])[0], []).append(q[a:b])
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out, totals = [], {}
    for i, label, q in kept:
        found = [best(q[a:b], books[p]) for p, (a, b) in enumerate(cut)]
        out.append((i, label, "".join(f"{c:02x}" for c, _ in found), sum(d for _, d in found)))
        totals[label] = totals.get(label, 0) + out[-1][3]
    sha = hashlib.sha256(",".join(str(x) for k in books for e in k for x in e).encode()).hexdigest()
    return sorted(((i, c, e, totals[label], sha) for i, label, c, e in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, dim=16, seed=0, copies=1):
    r = np.random.default_rng(seed)
    v = (r.normal(size=(n, dim)) * r.choice([0.05, 0.3, 1.5], (n, 1))).round(3)
    v = np.repeat(v, copies, axis=0)[:n]
    return [(int(i), [float(x) for x in row], int(i) % 3 if i % 7 else None) for i, row in enumerate(v)]


@pytest.mark.parametrize(("n", "dim", "copies"), [(300, 16, 1), (200, 8, 40), (40, 20, 1), (5, 16, 1)])
def test_equals_plain_lloyd(spark, monkeypatch, n, dim, copies):
    monkeypatch.setattr(cover_lloyd, "CHUNK", 64)
    rows = vectors(n, dim, n, copies)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(cover_lloyd.compress(df)) == plain(rows)


def test_odd_rows(spark):
    rows = vectors(60, 16, 3)
    bad = [None, [], [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] + [0.0] * 15, [0.5] * 7]
    rows += [(100 + i, v, 1) for i, v in enumerate(bad)]
    rows += [(3, rows[9][1], 2), (3, rows[3][1], None), (None, rows[5][1], 0), (None, None, None), (-5, [0.0] * 16, 0)]
    df = spark.createDataFrame([(*r, "x", 1, "c", 0) for r in rows], SCHEMA + ", id string, q int, code string, error int")
    assert got(cover_lloyd.compress(df)) == plain(rows)


def test_empty_and_unusable(spark):
    assert cover_lloyd.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert cover_lloyd.compress(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []


def test_tree_invariants():
    r = np.random.default_rng(1)
    points = r.integers(-400, 400, (700, 8))
    points[100:200] = points[0]
    tree = cover_lloyd.cover_tree(points)
    assert (np.sort(tree["order"]) == np.arange(700)).all() and (points[tree["order"]] == tree["points"]).all()
    before = None
    for starts, nodes, radii in tree["levels"]:
        ends = np.append(starts[1:], 700)
        for s, e, node, radius in zip(starts, ends, nodes, radii, strict=True):
            away = np.sqrt(((tree["points"][s:e] - node) ** 2).sum(1))
            assert away.max() <= radius + 1e-9
        d = np.sqrt(cover_lloyd.distances(nodes, nodes)) + np.where(np.eye(len(nodes)), np.inf, 0)
        assert before is None or len(starts) >= before
        assert len(nodes) == 1 or d.min() > 0
        before = len(starts)


def test_whole_subtrees_are_assigned():
    """Far clusters are settled above the leaves; few nodes are looked at."""
    r = np.random.default_rng(2)
    centres = r.integers(-100_000, 100_000, (16, 8))
    points = centres[r.integers(0, 16, 2000)] + r.integers(-50, 50, (2000, 8))
    tree = cover_lloyd.cover_tree(points)
    ranges = [len(s) for s, _, _ in cover_lloyd.assign(tree, centres)]
    assert ranges[-1] == 0 and sum(ranges) < 300
    code, error = cover_lloyd.codes(tree, centres)
    want = cover_lloyd.distances(points, centres)
    assert (code == want.argmin(1)).all() and (error == want.min(1)).all()


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        cover_lloyd.compress(spark.createDataFrame([(1, [1e9] * 8, 1)], SCHEMA)).collect()
