"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from carespan.operators import consolidate, normalize, person, quality, stays
from carespan.plans import skew
from carespan.plans.queries import QUERIES
from carespan.sources.staging import stage

NAMES = (
    "u, p, s, e, a, v, t, COD_ENTIDADE_TS_SEGURADO, NUM_AGR_INTER, NUM_PEDIDO_INTER, COD_CONTROLE"
)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts") / "facts.parquet")
    values = ", ".join(
        f"({i % 3}, 'p{i % 4}', date'2020-01-01', date'2020-01-02', 'a', {i}.0, 'é', "
        "'x', 'y', 'z', 'w')"
        for i in range(40)
    )
    spark.sql(f"SELECT * FROM VALUES {values} AS t({NAMES})").write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def operators(facts):
    yield normalize.normalize_text(facts)
    yield normalize.clean_descriptions(facts, ["t"])
    yield person.person_key(facts)
    yield person.person_key(facts, mode="intended")
    yield consolidate.consolidate(facts, attribute="a", unit="u", value="v", parse="number")
    yield consolidate.consolidate(
        facts, attribute="a", unit="u", value="v", parse="number", ties="one"
    )
    yield stays.number_stays(facts, person="p", start="s", end="e")
    yield quality.completeness(facts)


def test_no_python_and_no_cross_join(facts):
    for df in operators(facts):
        text = plan(df)
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text), text


def test_facts_never_go_to_one_task(facts):
    """Only the one-row-per-piece table of the stay numbering is gathered."""
    for df in operators(facts):
        for line in plan(df).splitlines():
            if "SinglePartition" in line:
                tail = plan(df).split(line, 1)[1]
                # whole-table aggregates arrive as one partial row per task, piece
                # totals as one row per piece
                assert re.search(r"partial_avg|partial_sum\(_adds|partial_sum\(_total|_piece", tail), line


def test_no_self_join_to_find_the_top_row(facts):
    lookup = consolidate.top_attributes(facts, ["a"], "u", value="v", parse="number")
    text = plan(lookup)
    assert "Join" not in text
    assert text.count("Exchange") == 1


def test_lookup_reads_its_columns_only(facts):
    lookup = consolidate.top_attributes(facts, ["a"], "u", value="v", parse="number")
    schema = re.search("ReadSchema: (.*)", plan(lookup)).group(1)
    assert schema == "struct<u:int,a:string,v:decimal(3,1)>"


def test_filters_reach_the_scan(facts):
    text = plan(normalize.normalize_text(facts, ["t"]).filter("u = 1").select("t"))
    assert "PushedFilters: [IsNotNull(u), EqualTo(u,1)]" in text
    assert "ReadSchema: struct<u:int,t:string>" in text


def test_ties_come_from_the_pair_table(facts, spark):
    """The facts are read for the pairs and for the result, never joined to their maxima."""
    read = []
    for df in (
        consolidate.consolidate(facts, attribute="a", unit="u", value="v", parse="number"),
        person.client_code(facts, client="COD_ENTIDADE_TS_SEGURADO", fallbacks=("NUM_AGR_INTER",), value="v", parse="number"),
    ):
        text = plan(df)
        read.append(len(set(re.findall(r"facts\.parquet", text))) and len(re.findall(r"Location: InMemoryFileIndex\S* ?\S*facts", text)))
    assert all(n == 1 for n in read), read


def test_no_salt_without_hot_keys(facts):
    df = consolidate.consolidate(facts, attribute="a", unit="u", value="v", parse="number", ties="one")
    assert skew.SALT not in plan(df)


def test_hot_keys_are_dealt_out(facts, hot):
    df = consolidate.consolidate(facts, attribute="a", unit="u", value="v", parse="number", ties="one")
    text = plan(df)
    assert skew.SALT in text
    # the facts are still scanned once
    assert text.count("facts.parquet") == 1


def test_copies_are_dealt_out_too(spark):
    """Rows equal in all columns part by the number of their task."""
    facts = spark.createDataFrame([("k", 1)] * 400, "k string, v int").repartition(8)
    dealt = facts.withColumn(skew.SALTS, F.lit(40)).select(skew._deal(facts).alias("salt"))
    assert dealt.distinct().count() > 4


def test_change_report_doubles_pairs_not_facts(facts):
    text = plan(consolidate.change_report(facts, attribute="a", corrected="u", value="v", parse="number"))
    # from the scan up: the facts are aggregated before anything is generated
    assert text.index("Generate") < text.rindex("HashAggregate") < text.index("FileScan")
    assert "ReadSchema: struct<u:int,a:string,v:decimal(3,1)>" in text


@pytest.mark.parametrize(
    "name",
    ["person_key_observed", "person_key_intended", "person_key_by_priority", "person_by_links_giant", "client_code_fill",
     "stays_from_text", "stays_running_max_nulls", "stays_session_nulls", "stays_without_dates", "readmission_gap",
     "readmission_gap_observed"],
)
def test_lines_and_orders_are_joined_once(spark, name):
    files = QUERIES[name](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not [f for f in files if "lineitem" in f or "orders" in f]


def test_tasks_of_shuffles_stay_small(spark):
    df = spark.range(4_000_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        parts = df.repartition("id").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert parts > 6  # about 200 MB on 4 cores, no task gets over 16 MB


def test_packed_lookups_are_not_taken_for_small(spark):
    """What a staged table fills in memory decides on a broadcast, not its packed files."""
    facts = spark.range(1_000_000).withColumn("k", F.col("id"))
    wide = spark.range(100_000).select(F.col("id").alias("k"), *[F.lit("same text again").alias(f"c{i}") for i in range(8)])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2m")
    try:
        for lookup, broadcast in ((wide, False), (wide.limit(10), True)):
            joined = facts.join(stage(lookup, "packed"), "k")
            assert ("BroadcastHashJoin" in plan(joined)) == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_reports_of_the_pipeline_do_not_broadcast_lookups_of_its_stays(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3k")
    try:
        text = plan(QUERIES["pipeline_reports"](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin [ID_INTERNACAO" in text and "BroadcastHashJoin" not in text
