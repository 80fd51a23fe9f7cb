"""Rules from a table against the chain of conditions they stand for."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carespan.operators import care, parameters

RULES = "place int, column string, value string, result string"
COLUMNS = ("a", "b", "c")


def chain(df, rules, default):
    """The rules as one chain of conditions."""
    order = {c: i for i, c in enumerate(COLUMNS)}
    usable = [r for r in rules if r[0] is not None and r[2] is not None and r[1] in order]
    out = None
    for _, column, value, result in sorted(usable, key=lambda r: (r[0], order[r[1]], r[3] is not None, r[3])):
        fits = F.col(column).cast("string") == value
        out = F.when(fits, result) if out is None else out.when(fits, result)
    return df.withColumn("r", F.lit(default) if out is None else out.otherwise(default))


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_chain(spark, seed):
    r = random.Random(seed)
    value = lambda: r.choice([None, *"uvwxyz", ""])
    df = spark.createDataFrame([(i, value(), value(), i % 4) for i in range(120)], "n int, a string, b string, c int")
    rules = [(r.choice([None, 0, 1, 2, 2]), r.choice([*COLUMNS, "other"]), r.choice([value(), "1", "2"]), r.choice(["S", "T", None])) for _ in range(12)]
    got = parameters.first_rule(df, spark.createDataFrame(rules, RULES), COLUMNS, out="r", default="N")
    assert rows(got) == rows(chain(df, rules, "N"))


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a")], "n int, a string")
    none = spark.createDataFrame([], RULES)
    assert rows(parameters.first_rule(df, none, ["a"], out="a", default="N")) == [(1, "N")]
    assert parameters.first_rule(df, none, ["a"], out="r").first().r is None
    some = spark.createDataFrame([(1, "a", "a", "S")], RULES)
    assert parameters.first_rule(df.limit(0), some, ["a"], out="r").collect() == []


def test_a_long_list_is_shuffled_a_short_one_is_not(spark):
    df = spark.range(100).withColumn("a", F.col("id").cast("string"))
    rules = spark.range(5000).select(F.lit(1).alias("place"), F.lit("a").alias("column"), F.col("id").cast("string").alias("value"), F.lit("S").alias("result"))
    text = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text(parameters.first_rule(df, rules, ["a", "id"], out="r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        long = parameters.first_rule(df, rules, ["a", "id"], out="r", default="N")
        assert len(re.findall("SortMergeJoin", text(long))) == 1  # no rule for id
        assert long.filter("r = 'S'").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_icu_day_by_table(spark):
    df = spark.createDataFrame(
        [
            ("51", "1", "", ""), ("1", "3", "", ""), ("1", "1", "UTI", ""), ("1", "1", "", "UTI PEDIÁTRICA"),
            ("1", "1", "UTI PEDIATRICA", ""), ("1", "1", "QUARTO", None), (None, "3", "UTI", "UTI"),
            (care.HASHED_MISSING, "3", "UTI", "UTI"), ("3", care.HASHED_MISSING, "", ""),
        ],
        "COD_ACOMODACAO_TISS string, COD_ACOMODACAO_TISS_PEDIDO string, NOME_ACOMODACAO string, NOME_ACOMODACAO_PEDIDO string",
    )
    lists = [(c, care.ICU_CODES if c.startswith("COD") else care.ICU_NAMES, "SIM") for c in parameters.ICU_COLUMNS]
    rules = parameters.rule_table(spark, lists)
    for mode in ("observed", "intended"):
        assert rows(parameters.icu_day_by_table(df, rules, mode=mode)) == rows(care.icu_day(df, mode=mode))
