"""One person for all rows that share an identifier, directly or by a chain of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.values import is_filled
from carespan.operators.person import PERSON_HIERARCHY
from carespan.plans.skew import ROWS, attach, row_count
from carespan.sources.staging import stage, stage_and_measure

# What stands for no identifier: the tokens of the key's rules, and a blank.
NO_IDENTIFIER = (".", "", " ", "-1")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node reachable.

    In a round every node points at its least neighbour, if that is less than itself. These
    pointers make trees, whose nodes are led to their roots by doubling steps; then trees
    become nodes, and the edges between them are the next round's. So a long chain takes
    one round of log2(length) steps, and what is left shrinks from round to round. All
    tables are staged; a node with very many edges is merged from partial minima, and a hot
    side of a join is split by the adaptive join.
    """
    left, seen = _between(edges.select("a", "b"))
    ends = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stage(ends.withColumn("root", F.col("node")), "labels")
    while seen["n"]:
        roots = _tree_roots(left)
        of = roots.withColumnsRenamed({"node": "root", "to": "_top"})
        labels = stage(
            labels.join(of, "root", "left").select("node", F.coalesce("_top", "root").alias("root")),
            "labels",
        )
        a, b = (roots.select(F.col("node").alias(c), F.col("to").alias(f"_{c}")) for c in "ab")
        left, seen = _between(left.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    return labels


def _between(edges: DataFrame) -> tuple[DataFrame, dict]:
    """Different edges between different nodes, the lesser first; staged."""
    ordered = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return stage_and_measure(ordered.distinct(), "edges", n=F.count(F.lit(1)))


def _tree_roots(edges: DataFrame) -> DataFrame:
    """(node, to): each node of the edges with the root of its tree of least neighbours."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("to"))
    both = both.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("to")))
    roots = stage(both.groupBy("node").agg(F.least("node", F.min("to")).alias("to")), "trees")
    while True:
        above = roots.select(F.col("node").alias("to"), F.col("to").alias("_above"))
        moved = roots.join(above, "to").select("node", F.col("_above").alias("to"), (F.col("to") != F.col("_above")).alias("_moved"))
        moved, seen = stage_and_measure(moved, "trees", going=F.bool_or("_moved"))
        roots = moved.drop("_moved")
        if not seen["going"]:
            return roots


def _nodes(identifiers: Sequence[str], tokens: Sequence[str]) -> Column:
    """The filled identifiers of a row: the place of the column and the value, as one text."""
    named = [
        F.when(is_filled(c, tokens), F.concat(F.lit(f"{i:03d}"), F.col(f"`{c}`").cast("string")))
        for i, c in enumerate(identifiers)
    ]
    return F.array_compact(F.array(*named))


def person_by_links(
    df: DataFrame,
    *,
    identifiers: Sequence[str] = PERSON_HIERARCHY,
    person: str = "ID_PESSOA",
    key_source: str = "FONTE_ID_PESSOA",
    tokens: Sequence[str] = NO_IDENTIFIER,
) -> DataFrame:
    """Add the person of every row, and how it was found.

    Rows with an identifier in common are one person, and so are all rows that a chain of
    such rows joins. A person's id is the least value (by its bytes) of the first of
    ``identifiers`` that any of its rows has. ``key_source``: ``ORIGINAL`` where the row itself has that value in that
    column, ``LINKED`` where a row it is joined with has, ``MERGED`` where the row has
    another value in that column, ``CREATED FROM c`` where the person has none in the first
    column, and its id is of column c. Equal values of different columns are different
    identifiers. Rows without any have no person and no source.

    Different combinations of identifiers are joined, not rows; the rows are read for them
    and for the result, where those of a hot combination are dealt out.
    """
    identifiers = list(identifiers)
    df = df.drop(person, key_source)
    nodes = "_nodes"
    tuples = stage(df.groupBy(*[F.col(f"`{c}`") for c in identifiers]).agg(row_count()).withColumn(nodes, _nodes(identifiers, tokens)), "identifiers")
    linked = tuples.filter(F.size(nodes) > 1).select(F.get(nodes, F.lit(0)).alias("a"), F.explode(nodes).alias("b"))
    labels = connected(linked)
    first = F.get(F.col(nodes), F.lit(0))
    counted = tuples.filter(F.size(nodes) > 0).groupBy(first.alias("_first")).agg(F.sum(ROWS).alias(ROWS))
    lookup = counted.join(labels.withColumnRenamed("node", "_first"), "_first", "left")
    lookup = lookup.withColumn("root", F.coalesce("root", "_first"))
    marked = df.withColumn("_first", F.get(_nodes(identifiers, tokens), F.lit(0)))
    joined = attach(marked, lookup, ["_first"], how="left")

    found, place = F.substring("root", 4, 2**31 - 1), F.substring("root", 1, 3)
    own = F.col(f"`{identifiers[0]}`")
    names = F.array(*[F.lit(c) for c in identifiers])
    source = (
        F.when(F.col("root").isNull(), F.lit(None))
        .when(place != "000", F.concat(F.lit("CREATED FROM "), F.get(names, place.cast("int"))))
        .when(~is_filled(identifiers[0], tokens), "LINKED")
        .when(own.cast("string") == found, "ORIGINAL")
        .otherwise("MERGED")
    )
    return joined.withColumns({person: found, key_source: source}).drop("_first", "root")
