"""Summary reports: aggregated in Spark, only the groups leave it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cost_by_network(
    df: DataFrame, *, network: str = "TP_REDE_VIDAS", cost: str = "CUSTO_POTENCIAL"
) -> DataFrame:
    return df.groupBy(network).agg(F.sum(cost).alias(cost))


def count_by_accommodation(
    df: DataFrame,
    *,
    accommodation: str = "TP_ACOMODACAO_CIG",
    out: str = "QTD POR ACOMODAÇÃO",
) -> DataFrame:
    return df.groupBy(accommodation).agg(F.count(F.lit(1)).alias(out))


def share_by_accommodation(
    df: DataFrame, *, accommodation: str = "TP_ACOMODACAO_DETALHEVIDAS"
) -> DataFrame:
    """Rows per accommodation and their share; the window sees one row per group."""
    counts = df.groupBy(accommodation).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("percent_count", F.col("count") / total)


def total_cost(df: DataFrame, *, cost: str = "CUSTO_POTENCIAL") -> DataFrame:
    return df.agg(F.sum(cost).alias(cost))


# the four reports, by the columns that a grouping set leaves out
REPORTS = {
    0b011: "cost_by_network",
    0b101: "count_by_accommodation",
    0b110: "share_by_accommodation",
    0b111: "total_cost",
}


def summary_reports(
    df: DataFrame,
    *,
    network: str = "TP_REDE_VIDAS",
    accommodation: str = "TP_ACOMODACAO_CIG",
    detail: str = "TP_ACOMODACAO_DETALHEVIDAS",
    cost: str = "CUSTO_POTENCIAL",
) -> DataFrame:
    """The four reports in one table: (report, category, cost, count, share).

    ``share`` is of the rows of the report. Rows without a category are one, whose
    ``category`` is NULL, as is that of the total. An empty table gives no rows.

    The facts are scanned once, for four columns, and shrink to one row for each combination
    that occurs before the sets are formed, so they are neither cached nor repeated.
    """
    named = df.select(
        F.col(f"`{network}`").cast("string").alias("network"),
        F.col(f"`{accommodation}`").cast("string").alias("accommodation"),
        F.col(f"`{detail}`").cast("string").alias("detail"),
        F.col(f"`{cost}`").alias("cost"),
    )
    by = ["network", "accommodation", "detail"]
    cells = named.groupBy(*by).agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("n"))
    sets = cells.groupingSets([[c] for c in by] + [[]], *by).agg(
        F.grouping_id(*by).alias("left_out"),
        F.sum("cost").alias("cost"),
        F.sum("n").alias("count"),
    )
    name, category = F.lit(None), F.lit(None)
    for left_out, report in REPORTS.items():
        name = F.when(F.col("left_out") == left_out, report).otherwise(name)
    for i, c in enumerate(by):
        alone = 0b111 & ~(0b100 >> i)
        category = F.when(F.col("left_out") == alone, F.col(c)).otherwise(category)
    of_report = F.sum("count").over(Window.partitionBy("left_out"))  # a row per category
    return sets.select(
        name.alias("report"),
        category.alias("category"),
        "cost",
        "count",
        (F.col("count") / of_report).alias("share"),
    )
