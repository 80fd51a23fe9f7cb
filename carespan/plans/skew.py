"""Lookups that hold when one key owns a large part of the rows.

A lookup table has one row (or a few, on ties) per key and carries, in ``ROWS``,
how many fact rows that key has; it comes from a ``groupBy`` on the facts, so the
counter is free. ``attach`` stages the lookup table, takes the largest count while
writing, and picks the join:

* no hot key: a plain join. The staged table has a known size, so Spark
  broadcasts it when it is under its own threshold and shuffles otherwise.
* hot keys: the rows of a hot key are dealt out over as many salts as the key has
  times ``limit`` rows, and its lookup rows are repeated once per salt. The facts
  are still read once, and no task gets more than about ``limit`` rows of a key.

The limit is how many rows of the facts' width fill ``TASK_BYTES``, whatever the size
of the table. The list of hot keys grows with the data (all rows over the limit at
most), so it is joined as Spark's size check decides.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampType

from carespan.sources.staging import stage_and_measure

ROWS = "_rows_of_key"
SALT, SALTS = "_salt", "_salts"
TASK_BYTES = 256 << 20  # what the rows of one key may fill in a task
FIXED = (NumericType, BooleanType, DateType, TimestampType)
TEXT_BYTES, VALUE_BYTES = 32, 8  # taken for a column that holds text or more, or a value


def row_count():
    return F.count(F.lit(1)).alias(ROWS)


def attach(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    how: str = "inner",
    null_safe: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Join ``lookup`` to ``facts`` on equally named ``keys``; facts' columns first.

    ``limit``: rows of a key that make it hot, if not as many as fill a task.
    """
    lookup, limit = stage_lookup(lookup, facts, limit)
    return attach_measured(facts, lookup, keys, limit, how=how, null_safe=null_safe)


def stage_lookup(
    lookup: DataFrame, facts: DataFrame, limit: int | None = None
) -> tuple[DataFrame, int | None]:
    """A staged lookup table and the hot limit of facts that it will be joined to."""
    lookup, seen = stage_and_measure(lookup, "lookup", top=F.max(ROWS))
    return lookup, hot_limit(seen, facts, limit)


def attach_measured(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    limit: int | None,
    *,
    sizes: DataFrame | None = None,
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """``attach`` where the hot limit of a repeatable ``lookup`` is known.

    ``sizes`` holds the keys' counts where the lookup does not.
    """
    keys = list(keys)
    if limit is None:
        return _join(facts, lookup.drop(ROWS), keys, how, null_safe)

    sizes = lookup if sizes is None else sizes
    hot = (
        sizes.filter(F.col(ROWS) > limit)
        .groupBy(*keys)
        .agg(F.ceil(F.max(ROWS) / limit).cast("int").alias(SALTS))
    )
    # null-safe, so that the rows without a key are dealt out when they are many
    facts_out = [F.col(f"`{c}`") for c in facts.columns]
    dealt = _join(facts, hot, keys, "left", True).select(
        *facts_out, _deal(facts).alias(SALT)
    )
    last = F.coalesce(F.col(SALTS), F.lit(1)) - 1
    repeated = _join(lookup.drop(ROWS), hot, keys, "left", True).withColumn(
        SALT, F.explode(F.sequence(F.lit(0), last))
    )
    return _join(dealt, repeated.drop(SALTS), [*keys, SALT], how, null_safe).drop(SALT)


def _deal(facts: DataFrame):
    """The salt of a row: 0 unless its key is hot.

    It depends on the row and on the number of its task, not on the order rows
    arrive in, so a task that is run again deals its rows out as before; the
    number of the task parts rows that are equal in every column.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns], F.spark_partition_id())
    hot = F.col(SALTS).isNotNull()
    return F.when(hot, F.pmod(row, F.col(SALTS))).otherwise(0).cast("int")


def hot_limit(seen: Mapping, facts: DataFrame, limit: int | None = None) -> int | None:
    """Rows above which a key is hot, or None where no key is; from the largest count."""
    limit = rows_a_task(facts) if limit is None else limit
    return limit if (seen.get("top") or 0) > limit else None


def rows_a_task(facts: DataFrame) -> int:
    wide = sum(VALUE_BYTES if isinstance(f.dataType, FIXED) else TEXT_BYTES for f in facts.schema)
    return max(1, TASK_BYTES // max(wide, 1))


def _join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool
) -> DataFrame:
    if not null_safe:
        return _in_order(left, left.join(right, keys, how))
    marked = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = None
    for k in keys:
        same = left[k].eqNullSafe(marked[f"_right_{k}"])
        on = same if on is None else on & same
    return left.join(marked, on, how).drop(*[f"_right_{k}" for k in keys])


def _in_order(left: DataFrame, joined: DataFrame) -> DataFrame:
    """A using-join puts the keys first; put the left columns back in order."""
    extra = [c for c in joined.columns if c not in left.columns]
    return joined.select(*left.columns, *extra)
