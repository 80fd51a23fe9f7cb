"""Completeness and rule checks: one pass over the table, one row per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.rules import RULES
from carespan.functions.values import COMPLETENESS_TOKENS, is_filled
from carespan.plans.claims import COLUMN_RULES, INDEX_COLUMN, MIN_FILLED

BROKEN = "_broken"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def completeness(
    df: DataFrame,
    limits: Mapping[str, float] | None = None,
    *,
    tokens: Sequence[str] = COMPLETENESS_TOKENS,
    failing_only: bool = False,
) -> DataFrame:
    """Filled share per column against its limit; columns without one have NULL."""
    limits = {INDEX_COLUMN: 1.0, **MIN_FILLED} if limits is None else limits
    shares = df.agg(
        *[
            F.avg(is_filled(_q(c), tokens).cast("double")).alias(f"s{i}")
            for i, c in enumerate(df.columns)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"s{i}").alias("filled_share"),
                F.lit(limits.get(c)).cast("double").alias("min_filled"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    out = shares.select(F.inline(rows)).withColumn(
        "passes", F.coalesce(F.col("filled_share") >= F.col("min_filled"), F.lit(True))
    )
    return out.filter(~F.col("passes")).drop("passes") if failing_only else out


def rule_violations(
    df: DataFrame, rules: Mapping[str, str] | None = None, *, failing_only: bool = True
) -> DataFrame:
    """Columns that break their rule, the type they should have, and how many rows do."""
    rules = _rules_for(df, rules)
    counts = df.agg(
        *[
            F.count_if(~RULES[rule][0](_q(c))).alias(f"n{i}")
            for i, (c, rule) in enumerate(rules.items())
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(RULES[rule][1]).alias("expected_type"),
                F.col(f"n{i}").alias("n_invalid"),
            )
            for i, (c, rule) in enumerate(rules.items())
        ]
    )
    out = counts.select(F.inline(rows))
    return out.filter(F.col("n_invalid") > 0) if failing_only else out


def invalid_values(
    df: DataFrame, rules: Mapping[str, str] | None = None, *, keys: Sequence[str] = ()
) -> DataFrame:
    """Every value that breaks its rule, as (keys…, column, value)."""
    rules = _rules_for(df, rules)
    # all cells, then a filter: a lambda over the array would keep Spark from compiling the rules
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                _q(c).cast("string").alias("invalid_value"),
                (~RULES[rule][0](_q(c))).alias(BROKEN),
            )
            for c, rule in rules.items()
        ]
    )
    return df.select(*keys, F.inline(cells)).filter(BROKEN).drop(BROKEN)


def _rules_for(df: DataFrame, rules: Mapping[str, str] | None) -> dict[str, str]:
    rules = COLUMN_RULES if rules is None else rules
    found = {c: r for c, r in rules.items() if c in df.columns}
    if not found:
        raise ValueError("the table has none of the columns the rules name")
    return found
