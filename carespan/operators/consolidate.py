"""Give every row of a unit the attribute found on its highest-value row.

The highest value is found with partial aggregation, so no unit is gathered in
one task, and the result is joined back with ``attach``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.values import read_value
from carespan.plans.skew import ROWS, attach, attach_measured, row_count, stage_lookup
from carespan.sources.staging import stage

FOUND = "_has_value"

# Accepted spellings of the two directions.
DIRECTIONS = {
    "MAX": "max",
    "max": "max",
    "maximum": "max",
    "MIN": "min",
    "min": "min",
    "minimum": "min",
}


def winner(
    attribute: str | Column, value: Column, agg: str = "max", where: Column | None = None
) -> Column:
    """Aggregate: the attribute of the extreme value; of equals, the largest.

    A missing attribute wins only where no row at that value has one.
    """
    attribute = F.col(attribute) if isinstance(attribute, str) else attribute
    known = value.isNotNull() if where is None else value.isNotNull() & where
    pair = F.struct(value.alias("v"), attribute.alias("a"))
    if agg == "max":
        return F.max(F.when(known, pair)).getField("a")
    # the smallest value, yet the largest attribute: negate the value
    pair = F.struct((-value).alias("v"), attribute.alias("a"))
    return F.max(F.when(known, pair)).getField("a")


def top_attributes(
    df: DataFrame,
    attributes: Sequence[str],
    unit: str,
    *,
    value: str = "VLR_PROD_MEDICA",
    agg: str = "max",
    parse: str = "money",
    suffix: str = "_CORRIGIDA",
) -> DataFrame:
    """One row per unit with each attribute's winner: one shuffle for all of them."""
    agg = DIRECTIONS[agg]
    if agg == "min" and parse == "text":
        raise ValueError("the lowest value needs a numeric reading")
    v = read_value(value, parse)
    return df.groupBy(unit).agg(
        row_count(),
        F.bool_or(v.isNotNull()).alias(FOUND),
        *[winner(a, v, agg).alias(a + suffix) for a in attributes],
    )


def _attach_tied(
    df: DataFrame,
    attribute: str,
    unit: str,
    *,
    value: str,
    agg: str,
    parse: str,
    how: str,
    out: str,
) -> DataFrame:
    """Attach every distinct attribute found at the unit's extreme value."""
    extreme = {"max": F.max, "min": F.min}[DIRECTIONS[agg]]
    v = read_value(value, parse)
    # facts shrink to one row per unit and attribute; tops and ties both come from it
    pairs = df.groupBy(unit, F.col(attribute).alias(out)).agg(
        extreme(v).alias("_value"), row_count()
    )
    found, tops, limit = tied_rows(df, pairs, unit, extreme("_value"))
    return attach_measured(df, found.select(unit, out), [unit], limit, sizes=tops, how=how)


def tied_rows(
    facts: DataFrame, pairs: DataFrame, unit: str, top: Column, value: str = "_value"
) -> tuple[DataFrame, DataFrame, int | None]:
    """The rows of ``pairs`` whose value is their unit's ``top``, the tops, the hot limit.

    ``pairs`` is staged: it is read for the tops and for the rows at them.
    """
    pairs = stage(pairs, "pairs")
    tops, limit = stage_lookup(
        pairs.groupBy(unit).agg(top.alias("_top"), F.sum(ROWS).alias(ROWS)), facts
    )
    best = tops.select(unit, "_top").filter(F.col("_top").isNotNull())
    found = pairs.drop(ROWS).join(best, unit).filter(F.col(value) == F.col("_top"))
    return found, tops, limit


def consolidate(
    df: DataFrame,
    *,
    attribute: str = "TP_REDE",
    unit: str = "COD_CLIENTE",
    value: str = "VLR_PROD_MEDICA",
    agg: str = "max",
    parse: str = "money",
    ties: str = "all",
    dedupe: bool | None = None,
    replace: bool = True,
    how: str = "inner",
    out: str | None = None,
) -> DataFrame:
    """Attach (or replace by) the attribute of each unit's extreme-value row.

    ``ties="all"`` keeps every attribute at that value, which multiplies rows, and
    drops duplicate rows unless ``dedupe=False``; rows of units without a value
    are lost. ``ties="one"`` keeps the number of rows, and the attribute of rows
    without a unit or in a unit without a value.
    """
    out = out or f"{attribute}_CORRIGIDA"
    df = df.drop(out)
    if ties == "all":
        result = _attach_tied(
            df, attribute, unit, value=value, agg=agg, parse=parse, how=how, out=out
        )
    elif ties == "one":
        lookup = top_attributes(df, [attribute], unit, value=value, agg=agg, parse=parse)
        lookup = lookup.withColumnRenamed(f"{attribute}_CORRIGIDA", out)
        result = attach(df, lookup, [unit], how="left").withColumn(
            out, F.when(F.col(FOUND), F.col(out)).otherwise(F.col(attribute))
        )
        result = result.drop(FOUND)
    else:
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")
    if dedupe if dedupe is not None else ties == "all":
        result = result.distinct()
    if replace:
        result = result.drop(attribute).withColumnRenamed(out, attribute)
    return result


def consolidate_birth_date(
    df: DataFrame,
    *,
    client: str = "COD_CLIENTE",
    birth_date: str = "DT_NASCIMENTO_CLIENTE",
    value: str = "VLR_PROD_MEDICA",
    out: str = "DT_NASCIMENTO_CORRIGIDA",
    mode: str = "observed",
) -> DataFrame:
    """The client's birth date on the highest-value row.

    ``observed`` compares values as text and keeps ties; ``intended`` compares
    numbers and picks one.
    """
    observed = mode == "observed"
    return consolidate(
        df,
        attribute=birth_date,
        unit=client,
        value=value,
        parse="text" if observed else "money",
        ties="all" if observed else "one",
        dedupe=False,
        replace=False,
        out=out,
    )


def change_report(
    df: DataFrame, *, attribute: str, corrected: str, value: str, parse: str = "money"
) -> DataFrame:
    """Per category: value before, value after, and rows that moved out of it.

    The facts shrink to one row per pair of categories; only the pairs count twice, once
    for the category before and once for the one after.
    """
    pairs = df.groupBy(F.col(attribute).alias("old"), F.col(corrected).alias("new")).agg(
        F.sum(read_value(value, parse)).alias("value"), F.count(F.lit(1)).alias("rows")
    )
    moved = F.when(F.col("old") != F.col("new"), F.col("rows")).otherwise(0)
    none = F.lit(None).cast("double")
    sides = F.array(
        F.struct(F.col("old").alias("category"), F.col("value").alias("before"), none.alias("after"), moved.alias("changed")),
        F.struct(F.col("new").alias("category"), none.alias("before"), F.col("value").alias("after"), F.lit(0).cast("long").alias("changed")),
    )
    return (
        pairs.select(F.explode(sides).alias("s"))
        .select("s.*")
        .groupBy("category")
        .agg(
            F.sum("before").alias("value_before"),
            F.sum("after").alias("value_after"),
            F.sum("changed").alias("changed_rows"),
        )
    )


def first_claim(
    df: DataFrame,
    *,
    stay: str = "ID_INTERNACAO",
    claim: str = "COD_CONTROLE",
    date: str = "DT_OCORR_EVENTO",
    out: str = "COD_CONTROLE2",
    mode: str = "intended",
) -> DataFrame:
    """The stay's first claim on every row; the date column must be a date."""
    lookup = df.groupBy(stay).agg(
        row_count(), first_claim_of(claim, date, mode).alias(out)
    )
    return attach(df.drop(out), lookup, [stay], how="left")


def first_claim_of(claim: str, date: str, mode: str = "intended") -> Column:
    """Aggregate: the claim of the earliest date; of equals, the smallest.

    ``observed`` takes the smallest claim, and only if it has a line on the
    earliest date.
    """
    c, d = F.col(claim), F.col(date)
    if mode == "intended":
        both = F.struct(d.alias("d"), c.alias("c"))
        return F.min(F.when(c.isNotNull() & d.isNotNull(), both)).getField("c")
    lowest = F.min(F.when(c.isNotNull(), F.struct(c.alias("c"), d.isNull(), d.alias("d"))))
    return F.when(lowest.getField("d") == F.min(d), lowest.getField("c"))


def discharge_and_stay_type(
    df: DataFrame,
    *,
    stay: str = "ID_INTERNACAO",
    claim: str = "COD_CONTROLE",
    discharge: str = "TIPO_ALTA",
    stay_type: str = "TIPO_INTERNACAO",
    value: str = "VLR_PROD_MEDICA",
    parse: str = "money",
    death: str = "OBITO",
    collapse_to_claim: bool = True,
    collapse: Callable[[DataFrame, Sequence[str], str], DataFrame] | None = None,
) -> DataFrame:
    """Death flag, numeric value, the stay's type by highest value, one row per claim.

    Where a (stay, claim) has many rows, the one of highest value is kept, then
    the smallest over all columns. Stays without any value are dropped.
    ``collapse`` stands in for ``one_row_per`` where some columns lie elsewhere.
    """
    base = df.withColumns(
        {
            death: F.when(F.col(discharge).like("%BITO%"), 1).otherwise(0),
            value: read_value(value, parse),
        }
    )
    lookup = (
        base.groupBy(stay)
        .agg(
            row_count(),
            F.bool_or(F.col(value).isNotNull()).alias(FOUND),
            winner(stay_type, F.col(value)).alias(stay_type),
        )
        .filter(FOUND)
        .drop(FOUND)
    )
    base = base.drop(stay_type)
    if collapse_to_claim:
        base = (collapse or one_row_per)(base, [stay, claim], value)
    return attach(base, lookup, [stay])


def one_row_per(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The highest-value row per key, then the smallest over all columns.

    An aggregate, not a window: partial results are merged, so a key that holds
    most of the rows never meets in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(
        F.isnull(value).alias("_no_value"),
        (-F.col(value)).alias("_minus_value"),
        *rest,
    )
    kept = df.groupBy(*keys).agg(F.min(order).alias("_row"))
    return kept.select(*[c if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def stay_type_report(
    before: DataFrame, after: DataFrame, *, stay_type: str = "TIPO_INTERNACAO"
) -> DataFrame:
    """Rows per stay type before and after."""
    old = before.groupBy(stay_type).agg(F.count(F.lit(1)).alias("n_before"))
    new = after.groupBy(stay_type).agg(F.count(F.lit(1)).alias("n_after"))
    both = old.withColumn("n_after", F.lit(None).cast("long")).unionByName(
        new.withColumn("n_before", F.lit(None).cast("long"))
    )
    return both.groupBy(stay_type).agg(
        F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after")
    )
