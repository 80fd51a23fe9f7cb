"""Rules read from a table: ordered value lists, the first that fits decides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.text import normalize
from carespan.operators.care import HASHED_MISSING
from carespan.sources.staging import stage_and_measure

# The accommodation columns in the order in which their lists are looked at.
ICU_COLUMNS = (
    "COD_ACOMODACAO_TISS",
    "COD_ACOMODACAO_TISS_PEDIDO",
    "NOME_ACOMODACAO_PEDIDO",
    "NOME_ACOMODACAO",
)


def rule_table(spark, lists: Sequence[tuple[str, Sequence, str]]) -> DataFrame:
    """(place, column, value, result) of lists that are in the caller's memory."""
    rows = [
        (place, column, str(value), result)
        for place, (column, values, result) in enumerate(lists)
        for value in values
    ]
    return spark.createDataFrame(rows, "place int, column string, value string, result string")


def first_rule(
    df: DataFrame,
    rules: DataFrame,
    columns: Sequence[str],
    *,
    out: str,
    default: str | None = None,
    read: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add the result of the first rule that fits, as a chain of ``when(isin)`` would.

    ``rules`` has (place, column, value, result): a rule fits a row if the row's ``column``
    has the ``value``, as text. The least place wins; of equal places the column that is
    first in ``columns``, then the least result. Rules of other columns, and those without
    a place or a value, fit no row; a NULL fits no rule. No fitting rule gives ``default``.

    The rules may be of any number. Each column's are reduced to one row per value and
    staged, so Spark's size check chooses the join: a short list goes to every task, a long
    one is shuffled, where the adaptive join splits a value that most rows have. Columns
    that no rule names are not joined.
    """
    read = read or {}
    kept = rules.filter(F.col("place").isNotNull() & F.col("value").isNotNull() & F.col("column").isin(list(columns)))
    best = F.min(F.struct("place", "result")).alias("_rule")
    kept, seen = stage_and_measure(
        kept.groupBy("column", F.col("value").cast("string").alias("_value")).agg(best),
        "rules",
        columns=F.array_sort(F.collect_set("column")),
    )
    joined, found = df, []
    for i, c in enumerate(columns):
        if c not in (seen.get("columns") or []):
            continue
        own = kept.filter(F.col("column") == c).select(F.col("_value").alias(f"_value{i}"), F.col("_rule").alias(f"_rule{i}"))
        value = read.get(c, F.col(f"`{c}`")).cast("string")
        joined = joined.join(own, value == F.col(f"_value{i}"), "left")
        rule = F.col(f"_rule{i}")
        fits = F.struct(rule["place"].alias("place"), F.lit(i).alias("column"), rule["result"].alias("result"))
        found.append(F.when(rule.isNotNull(), fits))
    first = F.array_min(F.array_compact(F.array(*found)))["result"] if found else F.lit(None).cast("string")
    fits_any = F.size(F.array_compact(F.array(*found))) > 0 if found else F.lit(False)
    kept_columns = [F.col(f"`{c}`") for c in df.columns if c != out]
    return joined.select(*kept_columns, F.when(fits_any, first).otherwise(F.lit(default)).alias(out))


def icu_day_by_table(
    df: DataFrame,
    rules: DataFrame,
    *,
    columns: Sequence[str] = ICU_COLUMNS,
    codes: Sequence[str] = ICU_COLUMNS[:2],
    missing: str = HASHED_MISSING,
    out: str = "CTI_DIARIA",
    mode: str = "observed",
) -> DataFrame:
    """``icu_day`` with its lists read from a table: ``SIM`` on a list, else ``NAO``.

    Rows with the missing token, or no value, in one of ``codes`` are dropped first.
    ``intended`` folds the names of the table as the text stage folded the data.
    """
    coded = None
    for c in codes:
        there = F.col(f"`{c}`").cast("string") != missing
        coded = there if coded is None else coded & there
    df = df if coded is None else df.filter(coded)
    if mode == "intended":
        name = ~F.col("column").isin(list(codes))
        rules = rules.withColumn("value", F.when(name, normalize(F.col("value"))).otherwise(F.col("value")))
    return first_rule(df, rules, columns, out=out, default="NAO")
