"""Mixing sources to target weights by systematic sampling.

A document's expected number of copies is its source's target over its source's size.
Within a source the documents are lined up by size; their expected copies are summed up
along the line, one random offset is added per source, and a document is emitted once
for every whole number that the sum passes at it. So a document gets its expected
number rounded down or up, and neighbours in the line, being of like size, balance out:
what a source yields misses its target by about one document.

The line of a source is laid out by a range shuffle, so a source with a third of all
rows spreads over as many tasks as its rows need. No window runs over a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespan.llm.common import WORD
from carespan.plans.numbering import running_total, stage_pieces
from carespan.sources.staging import stage

STEPS = 4096  # an offset is the middle of one of so many steps; a power of two: exact
ROW_BITS = 33  # of a monotonically increasing id: the row's place in its partition


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: str) -> Column:
    """In (0, 1), the same in every run: from a digest of the seed and the source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), source).cast("binary"))
    step = F.conv(F.substring(digest, 1, 3), 16, 10).cast("long")
    return (step + 0.5) / STEPS


def fill(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Add ``target`` to a table of (missing, source, source_size), one row a source.

    All sources share the total by weight; one that would get more than ``most`` times
    its size stops there, and the rest is shared again. Each pass is one small aggregate;
    passes end when no further source stops.
    """
    line = [F.col("missing"), F.col("source")]
    pieces, _ = stage_pieces(sources.repartitionByRange(*line).withColumn("one", F.lit(1)), "sources")
    place = (F.col("place") - 1) % len(weights)
    ranked = stage(
        running_total(pieces, line, "one", "place").select(
            *line,
            "source_size",
            F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).alias("weight"),
            (F.col("source_size") * most).alias("cap"),
        ),
        "sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        stops = F.col("cap") <= F.col("weight") * F.lit(level)
        n, capped, free = ranked.agg(
            F.count_if(stops), F.sum(F.when(stops, F.col("cap"))), F.sum(F.when(~stops, F.col("weight")))
        ).first()
        if n == stopped or not free:
            break
        level, stopped = (total - (capped or 0)) / free, n
    share = F.col("weight") * F.lit(level)
    return ranked.withColumn(
        "target", F.when(F.col("cap") <= share, F.col("cap").cast("double")).otherwise(share)
    ).drop("weight", "cap")


def mix(
    docs: DataFrame,
    *,
    source: Column | None = None,
    size: Column | None = None,
    order: Sequence[Column] | None = None,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """Rows (row, size, source_size, target, copies); ``row`` holds the document's columns.

    Sources are taken in code-point order, null last, and weigh ``weights``, repeated.
    Sizes are words unless ``size`` says otherwise; a null text has size 0. A source
    whose documents are all empty has target 0 and no copies. Equal rows are separate
    documents. ``order`` (default: doc_id) settles the line among documents of one size;
    a digest of the whole row settles what is left, so that reruns agree.
    """
    source = F.col("source").cast("string") if source is None else source
    size = word_count(F.col("text")) if size is None else size
    order = [F.col("doc_id")] if order is None else order
    settle = [c.alias(f"by{i}") for i, c in enumerate([*order, F.xxhash64(F.struct("*"))])]
    rows = docs.select(
        F.struct("*").alias("row"),
        source.isNull().alias("missing"),
        F.coalesce(source, F.lit("")).alias("source"),
        size.alias("size"),
        *settle,
    )
    line = ["missing", "source", "size", *(f"by{i}" for i in range(len(settle)))]
    laid = rows.repartitionByRange(*line).sortWithinPartitions(*line)
    # the sort is in the task that numbers, so the number is the place in the line
    numbered = laid.select("row", "missing", "source", "size", F.monotonically_increasing_id().alias("at"))
    numbered = stage(numbered, "mix")
    numbered = numbered.withColumn("piece", F.shiftright("at", ROW_BITS))

    key = ["missing", "source"]
    spans = numbered.groupBy("piece", *key).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words")
    )
    spans = stage(spans, "spans")  # a row for each piece and source in it
    targets = fill(spans.groupBy(*key).agg(F.sum("words").alias("source_size")), weights, most)
    before = Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    # staged, so that its size is known and the rows are not shuffled to meet it
    spans = stage(spans.join(targets, key).drop("rows", "words"), "spans")

    place = F.col("at") - F.col("first") + F.col("start")  # from 0, in the source
    expected = F.col("target") / F.nullif(F.col("source_size"), F.lit(0)).cast("double")
    start = offset(F.col("source"), seed)
    # every document of a source expects the same, so a sum along the line is a product
    passed = F.floor(start + (place + 1) * expected) - F.floor(start + place * expected)
    return numbered.join(spans, ["piece", *key]).select(
        "row",
        "size",
        "source_size",
        "target",
        F.coalesce(passed, F.lit(0)).cast("long").alias("copies"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document's row as often as it is taken."""
    return (
        mix(docs, **options)
        .filter(F.col("copies") > 0)
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("row.*")
    )
