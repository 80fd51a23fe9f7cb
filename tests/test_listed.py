"""Removal by a table of values, and the four reports from one scan."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carespan.operators import reports, shape


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(i % 7 if i % 5 else None, f"v{i}") for i in range(60)], "k int, v string")


@pytest.mark.parametrize(
    "listed", [[], [1], [1, 1, 3, 99], [None], [2, None, 2], list(range(1000))], ids=str
)
def test_as_not_in(spark, facts, listed):
    values = spark.createDataFrame([(x,) for x in listed], "x int")
    facts.createOrReplaceTempView("facts")
    values.createOrReplaceTempView("listed")
    want = spark.sql("SELECT * FROM facts WHERE k NOT IN (SELECT x FROM listed)")
    got = shape.remove_listed(facts, values, "k")
    assert rows(got) == rows(want) and got.columns == facts.columns
    assert rows(got) == rows(shape.remove_rows(facts, "k", listed))


def test_other_type_and_column(spark, facts):
    values = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", "3")], "k string, x string")
    got = shape.remove_listed(facts, values, "k", "x")
    assert rows(got) == rows(shape.remove_rows(facts, "k", [1, 3]))
    odd = facts.withColumnRenamed("k", "a.b")
    assert shape.remove_listed(odd, values, "a.b", "x").count() == got.count()


def test_anti_join_by_size(spark, facts, monkeypatch):
    values = spark.range(5).withColumn("pad", F.lit("x"))
    assert re.search(r"BroadcastHashJoin.*LeftAnti", plan(shape.remove_listed(facts, values, "k")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(shape.remove_listed(facts, values, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin.*LeftAnti", text) and "NestedLoop" not in text


@pytest.fixture
def costs(spark, tmp_path):
    path = str(tmp_path / "costs.parquet")
    made = [("R" if i % 3 else None, f"a{i % 2}", f"d{i % 4}", float(i), "wide") for i in range(40)]
    spark.createDataFrame(made, "n string, a string, d string, c double, pad string").write.parquet(path)
    return spark.read.parquet(path)


def summary(df):
    return reports.summary_reports(df, network="n", accommodation="a", detail="d", cost="c")


def test_reports_equal_the_single_ones(costs):
    got = {(r.report, r.category): r for r in summary(costs).collect()}
    for r in reports.cost_by_network(costs, network="n", cost="c").collect():
        assert got["cost_by_network", r.n].cost == r.c
    for r in reports.count_by_accommodation(costs, accommodation="a", out="q").collect():
        assert got["count_by_accommodation", r.a]["count"] == r.q
    for r in reports.share_by_accommodation(costs, accommodation="d").collect():
        assert got["share_by_accommodation", r.d].share == r.percent_count
    assert got["total_cost", None].cost == reports.total_cost(costs, cost="c").first().c
    assert len(got) == 2 + 2 + 4 + 1


def test_reports_scan_once(costs):
    text = plan(summary(costs))
    assert len(re.findall("FileScan", text)) == 1
    assert "ReadSchema: struct<n:string,a:string,d:string,c:double>" in text
    # the facts are aggregated before the sets are formed
    below = text[text.index("Expand") :]
    assert "HashAggregate" in below


def test_reports_of_one_column_and_of_nothing(costs):
    same = reports.summary_reports(costs, network="a", accommodation="a", detail="a", cost="c")
    assert same.count() == 7
    assert summary(costs.filter("c < 0")).collect() == []
