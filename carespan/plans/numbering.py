"""A running total over a whole table, without sorting it in one task.

The rows are laid out in ordered pieces by a range shuffle and staged, each with
the number of its piece. A total per piece (as many rows as there are shuffle
partitions) gives each piece its start; the rest is a window inside the piece.
The pieces are staged because the bounds of a range shuffle are sampled: they
must be drawn once only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespan.sources.staging import stage_and_measure

PIECE = "_piece"


def stage_pieces(
    ranged: DataFrame, name: str, **measures: Column
) -> tuple[DataFrame, dict]:
    """Stage a range-shuffled table with the number of each row's piece."""
    measures = measures or {"rows": F.count(F.lit(1))}
    return stage_and_measure(
        ranged.withColumn(PIECE, F.spark_partition_id()), name, **measures
    )


def running_total(
    pieces: DataFrame, order: Sequence[Column], weight: str, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over all rows up to this one in ``order``.

    ``order`` must begin with the key the pieces were laid out by.
    """
    before = Window.orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy(PIECE)
        .agg(F.sum(weight).alias("_total"))
        .select(PIECE, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(PIECE).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        pieces.join(F.broadcast(starts), PIECE)  # one row per shuffle partition
        .withColumn(out, F.col("_start") + F.sum(weight).over(inside))
        .drop("_start", PIECE)
    )
