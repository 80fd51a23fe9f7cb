import itertools

import numpy as np
import pytest
from conftest import rows
from data import documents, edited, odd_texts, prose, words
from pyspark.sql import functions as F

from carespan.llm import setsketch as s
from carespan.llm.graph import components


def plain_set(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def plain_components(texts):
    sets = [plain_set(t) for t in texts]
    root = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            old, new = max(root[i], root[j]), min(root[i], root[j])
            root = [new if r == old else r for r in root]
    return sets, root


def check(spark, texts):
    sets, root = plain_components(texts)
    got = {r.doc_id: r for r in s.near_duplicates(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i in got:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), root[i], root[i] == i), i


def near_copies(n, share, seed=0):
    base = prose(seed, 90)
    return [base, *[edited(base, seed * 1000 + i, share) for i in range(1, n)]]


def test_odd_texts(spark):
    check(spark, odd_texts())


def test_groups_of_near_copies(spark, monkeypatch):
    texts = near_copies(25, 0.02, 1) + near_copies(25, 0.05, 2) + [prose(50 + i, 60) for i in range(20)]
    check(spark, texts * 2)
    monkeypatch.setattr(s, "SMALL", 1)  # every band in blocks
    monkeypatch.setattr(s, "CHUNK_ROWS", 5)
    check(spark, texts)


def test_threshold_is_exact(spark):
    # 3 of 4 shingles in common is enough, 5 of 7 is not
    w = [f"w{i}" for i in range(30)]
    check(spark, [" ".join(w[:7]), " ".join(w[:8]), " ".join(w[10:19]), " ".join(w[10:17] + ["x", "y"]), "a b c d", "a b c d e"])


def test_repeated_and_missing_ids(spark):
    text = prose(1, 30)
    rows_in = [(1, text), (1, "other words here"), (None, text), (None, "alone a b c d e"), (3, text)]
    df = spark.createDataFrame(rows_in, "doc_id long, text string")
    got = s.near_duplicates(df)
    assert rows(got, "doc_id", "component_id", "kept") == [
        (None, None, False), (None, 1, False), (1, 1, True), (1, 1, True), (3, 1, False),
    ]
    kept = s.without_near_duplicates(df)
    assert rows(kept) == [(None, "alone a b c d e"), (1, "other words here"), (1, text)]


def test_stage_keeps_one_whole_row_of_each_group(spark):
    texts = odd_texts()
    _, root = plain_components(texts)
    df = documents(spark, texts).withColumns({c: F.lit(c) for c in ("h1", "n", "row", "copy", "id", "w0")})
    got = s.without_near_duplicates(df.union(df))
    assert got.columns == df.columns
    ids = sorted(r.doc_id for r in got.collect())
    empty = [i for i, t in enumerate(texts) if not words(t)]
    assert ids == sorted([i for i in range(len(texts)) if root[i] == i] + empty)


def test_empty_table(spark):
    df = documents(spark, [])
    assert s.near_duplicates(df).count() == 0
    assert s.without_near_duplicates(df).count() == 0
    assert s.near_duplicates(documents(spark, [None, ""])).filter("kept").count() == 2


def sketch_of(numbers):
    elements = s.scrambled(np.array(numbers, np.uint64))
    return s.registers(elements, np.array([len(numbers)]))


def test_registers_merge():
    a, b = list(range(300)), list(range(200, 900))
    assert (s.merged(sketch_of(a), sketch_of(b)) == sketch_of(sorted({*a, *b}))).all()
    assert (sketch_of([]) == 0).all()


@pytest.mark.parametrize(("na", "nb", "common"), [(400, 400, 343), (100, 130, 90), (1000, 1000, 100), (5, 6, 5)])
def test_estimate(na, nb, common):
    rng, got = np.random.default_rng(na), []
    for _ in range(30):
        x = rng.choice(2**60, na + nb, replace=False)
        a, b = sketch_of(x[:na]), sketch_of(np.concatenate([x[:common], x[na : na + nb - common]]))
        got.append(s.estimate(a, b, np.array([na]), np.array([nb]))[0])
    true = common / (na + nb - common)
    assert np.mean(got) == pytest.approx(true, abs=4 * np.sqrt(true * (1 - true) / s.M / 30) + 0.005)


def test_components(spark):
    chain = [(i, i + 1) for i in range(10, 40)] + [(50, 51), (53, 51), (60, 60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 10 for i in range(10, 41)}, 50: 50, 51: 50, 53: 50}


def test_every_element_visits_all_registers_in_an_order_of_its_own():
    orders = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 500)
    visits = np.stack([s.register(k, orders) for k in range(s.M)])
    assert (np.sort(visits, axis=0) == np.arange(s.M)[:, None]).all()
    steps = np.diff(visits, axis=0) % s.M
    assert ((steps == steps[0]).mean(axis=0) < 0.5).mean() > 0.95  # hardly any is a progression


@pytest.mark.parametrize(("size", "common"), [(4, 3), (8, 6)])
def test_small_sets_at_the_threshold_share_a_band(size, common):
    n = 4000
    elements = np.random.default_rng(size).integers(0, 2**63, (n, size)).astype(np.uint64)
    whole, part = (np.sort(e, axis=1).reshape(-1) for e in (elements, elements[:, :common]))
    a, b = (s.band_keys(s.registers(e, np.full(n, k))) for e, k in ((whole, size), (part, common)))
    assert (a == b).any(axis=1).all()


def test_texts_meet_a_table_of_known_size(spark, monkeypatch):
    """The rows whose sets are wanted are staged narrow, so texts are not shuffled to meet a few."""
    plans, full_sets = [], s.full_sets

    def seen(docs, key, text, wanted):
        plans.append(wanted._jdf.queryExecution().executedPlan().toString())
        assert sorted(wanted.columns) == ["cid", "h1", "h2", "id"]
        return full_sets(docs, key, text, wanted)

    monkeypatch.setattr(s, "full_sets", seen)
    assert s.near_duplicates(documents(spark)).count() > 0
    assert len(plans) == 1 and "Join" not in plans[0] and "parquet" in plans[0]
