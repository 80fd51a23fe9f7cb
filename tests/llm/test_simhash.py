import random

import numpy as np
import pytest
import xxhash
from data import documents, edited, odd_texts, prose, words

from carespan.llm import simhash


def plain_print(text):
    w = words(text)
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, ids):
    """By comparing every two fingerprints."""
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[top(i)] = top(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[top(i)] = min(x, least.get(top(i), x))
    return [least.get(top(i)) for i in range(len(prints))]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def want(texts, ids):
    prints = [plain_print(t) for t in texts]
    return sorted(zip(ids, [f"{p:016x}" for p in prints], plain_components(prints, ids), strict=True), key=str)


def test_equals_brute_force(spark):
    texts = odd_texts() + [edited(prose(s % 7, 150), s, 0.01) for s in range(60)]
    got = simhash.near_duplicates(documents(spark, texts))
    assert rows(got) == want(texts, range(len(texts)))


def clustered(n, seed):
    """Fingerprints in clouds around a few centres, many of them just within or beyond."""
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(4)]
    out = []
    for _ in range(n):
        p = r.choice(centres)
        for bit in r.sample(range(64), r.choice([0, 1, 2, 3, 4, 5, 6, 9])):
            p ^= 1 << bit
        out.append(p)
    return out


@pytest.mark.parametrize(("segments", "small", "chunk"), [(3, 64, 4096), (3, 2, 8), (2, 5, 16), (4, 1, 4096), (5, 2, 32)])
def test_links_at_every_way(spark, monkeypatch, segments, small, chunk):
    monkeypatch.setattr(simhash, "SMALL", small)
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    prints = clustered(250, segments) + [0, 2**64 - 1, 1 << 63]
    table = [(i, int(np.uint64(p).view(np.int64))) for i, p in enumerate(prints)]
    found = simhash.with_components(spark.createDataFrame(table, "id long, fp long"), segments)
    got = {r.id: r.component_id for r in found.collect()}
    assert [got[i] for i in range(len(prints))] == plain_components(prints, list(range(len(prints))))


def test_balls_and_segments_cover_all_close_pairs():
    r = random.Random(5)
    for segments in (1, 2, 3, 4, 5, 7):
        bounds = simhash.segment_bounds(segments)
        for _ in range(2000):
            diff = sum(1 << b for b in r.sample(range(64), r.randint(0, 4)))
            assert any(((diff >> lo) & ((1 << n) - 1)).bit_count() <= rad for lo, n, rad in bounds)


def test_a_block_gives_a_forest(spark):
    import pyarrow as pa

    prints = np.array(sorted(set(clustered(400, 9))), np.uint64)
    both = pa.table({"fp": np.concatenate([prints, prints]).view(np.int64), "asks": [True] * len(prints) + [False] * len(prints)})
    found = simhash.forest(both)
    assert found.num_rows < len(prints)  # no cycle
    pairs = zip(*(found.column(c).to_numpy().view(np.uint64) for c in "ab"), strict=True)
    assert all(0 < int(a ^ b).bit_count() <= 4 for a, b in pairs)


def test_odd_tables(spark):
    schema = "doc_id long, text string, id string, fp int, key string, least int, root int, component_id int"
    odd = [(None, "a b c d e", "x", 1, "k", 1, 1, 1), (7, "A  b\tc d e", "x", 1, "k", 1, 1, 1), (7, None, "", 0, "", 0, 0, 0), (None, " ", "", 0, "", 0, 0, 0)]
    got = rows(simhash.near_duplicates(spark.createDataFrame(odd, schema)))
    assert got == want([r[1] for r in odd], [r[0] for r in odd])
    assert rows(simhash.near_duplicates(spark.createDataFrame([(None, "only one here")], "doc_id long, text string"))) == want(["only one here"], [None])
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_copies_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS_A_TASK", 5)
    texts = [prose(1, 40)] * 60 + [prose(2, 40)]
    assert rows(simhash.near_duplicates(documents(spark, texts))) == want(texts, range(61))


def test_long_text_in_pieces(monkeypatch):
    text = prose(3, 5000)
    monkeypatch.setattr(simhash, "SHINGLES", 700)
    got = simhash.fingerprints([b"", text.encode(), b"one", text[:400].encode()])
    assert [int(x) for x in got] == [plain_print(t) for t in ("", text, "one", text[:400])]
