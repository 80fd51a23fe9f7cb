"""Persons by chains of identifiers."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from carespan.operators import identity
from carespan.plans import queries

SCHEMA = "n int, t string, g string, c string"
NAMES = ["t", "g", "c"]
FOLDER = "/root/testdata/sf0.001"


def person_of(data):
    """Row by row with a union-find over identifiers."""
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    nodes = {r[0]: [(i, v) for i, v in enumerate(r[1:]) if v not in (None, *identity.NO_IDENTIFIER)] for r in data}
    for own in nodes.values():
        for x in own[1:]:
            root[max(top(own[0]), top(x))] = min(top(own[0]), top(x))
    out = []
    for n, *values in data:
        if not nodes[n]:
            out.append((n, None, None))
            continue
        place, value = top(nodes[n][0])
        if place:
            source = f"CREATED FROM {[*NAMES, None][place]}"
        elif nodes[n][0][0]:
            source = "LINKED"
        else:
            source = "ORIGINAL" if values[0] == value else "MERGED"
        out.append((n, value, source))
    return sorted(out)


def got(df, **options):
    found = identity.person_by_links(df, identifiers=NAMES, person="p", key_source="s", **options)
    return sorted(tuple(r) for r in found.select("n", "p", "s").collect())


def random_rows(seed, n, values):
    r = random.Random(seed)
    pick = lambda p: r.choice([None, ".", "", " ", "-1", *[f"{p}{r.randrange(values)}"] * 6])
    return [(i, pick(""), pick("g"), pick("")) for i in range(n)]


@pytest.mark.parametrize(("seed", "n", "values"), [(1, 200, 400), (2, 300, 150), (3, 150, 40), (4, 60, 1000)])
def test_equals_union_find(spark, seed, n, values):
    data = random_rows(seed, n, values)
    assert got(spark.createDataFrame(data, SCHEMA)) == person_of(data)


def test_with_hot_keys(spark, hot):
    data = random_rows(5, 200, 60) + [(1000 + i, "5", None, None) for i in range(50)]
    assert got(spark.createDataFrame(data, SCHEMA)) == person_of(data)


def test_a_chain_of_two_identifiers(spark):
    data = [(1, "P2", "A", None), (2, None, "A", "C1"), (3, ".", "B", "C1"), (4, "P1", "B", "C9"), (5, None, None, "C7"), (6, "A", None, None)]
    assert got(spark.createDataFrame(data, SCHEMA)) == [
        (1, "P1", "MERGED"), (2, "P1", "LINKED"), (3, "P1", "LINKED"), (4, "P1", "ORIGINAL"),
        (5, "C7", "CREATED FROM c"), (6, "A", "ORIGINAL"),
    ]


def test_a_giant_component_and_a_long_chain(spark):
    n = 3000
    chain = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(n).select(F.lit(10**6).cast("long").alias("a"), (F.col("id") + 10**6).alias("b"))
    mixed = spark.range(2 * n).select((F.xxhash64("id") % 5000 + 2 * 10**7).alias("a"), (F.xxhash64(-F.col("id")) % 5000 + 2 * 10**7).alias("b"))
    found = identity.connected(chain.union(star).union(mixed))
    roots = {r.root for r in found.filter("node < 10000000").collect()}
    assert roots == {0, 10**6}
    edges = mixed.join(found.withColumnRenamed("node", "a"), "a").withColumnRenamed("root", "ra")
    edges = edges.join(found.withColumnRenamed("node", "b"), "b")
    assert edges.filter("ra != root").count() == 0
    assert found.filter("root > node").count() == 0
    assert found.join(found.select(F.col("node").alias("root"), F.col("root").alias("top")), "root").filter("top != root").count() == 0


def test_nothing_to_join(spark):
    none = spark.createDataFrame([(1, None, ".", "")], SCHEMA)
    assert got(none) == [(1, None, None)]
    assert got(none.limit(0)) == []
    assert identity.connected(spark.createDataFrame([(1, 1)], "a int, b int")).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(random_rows(1, 50, 20), SCHEMA)
    text = identity.person_by_links(df, identifiers=NAMES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables")
def test_the_registered_giant(spark):
    """All claims, of which nearly all are one person, against a union-find."""
    names = list(identity.PERSON_HIERARCHY)
    df = queries.QUERIES["person_by_links_giant"](spark, FOLDER)
    made = df.select(*names, "ID_PESSOA", "FONTE_ID_PESSOA").collect()
    want = person_of([(i, *r[:4]) for i, r in enumerate(made)])
    for r, (_, person, source) in zip(made, want, strict=True):
        assert r.ID_PESSOA == person and (r.FONTE_ID_PESSOA or "")[:7] == (source or "")[:7]
    largest = df.groupBy("ID_PESSOA").count().agg(F.max("count")).first()[0]
    assert largest > 0.9 * len(made)
