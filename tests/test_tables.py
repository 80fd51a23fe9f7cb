from pathlib import Path
from urllib.parse import urlparse

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carespan.operators import care, quality, reports, shape
from carespan.plans.claims import FINAL_NAMES, MIN_FILLED, RAW_COLUMNS, RAW_SCHEMA
from carespan.sources import staging, tables


def test_layout():
    assert len(RAW_COLUMNS) == len(MIN_FILLED) == len(RAW_SCHEMA) == 78
    assert len(FINAL_NAMES) == 86


def test_care_type(spark):
    df = spark.createDataFrame(
        [(" ", "1"), (" ", "."), (" ", None), (".", "1"), ("", "1"), ("7", "0"), (None, "1")],
        "NUM_AGR_INTER string, REGIME_DOMICILIAR string",
    )
    got = [r.TIPO_ATENDIMENTO for r in care.care_type(df).collect()]
    assert got == [
        "REGIME DOMICILIAR", "AMBULATORIO", "AMBULATORIO", "INTERNACAO", "INTERNACAO",
        "INTERNACAO", "AMBULATORIO",
    ]


def test_icu_day(spark):
    df = spark.createDataFrame(
        [
            ("51", "1", "", ""),
            ("1", "3", "", ""),
            ("1", "1", "UTI", ""),
            ("1", "1", "", "UTI PEDIÁTRICA"),
            ("1", "1", "UTI PEDIATRICA", ""),
            ("1", "1", "QUARTO", None),
            (None, "3", "UTI", "UTI"),
            (care.HASHED_MISSING, "3", "UTI", "UTI"),
        ],
        "COD_ACOMODACAO_TISS string, COD_ACOMODACAO_TISS_PEDIDO string, "
        "NOME_ACOMODACAO string, NOME_ACOMODACAO_PEDIDO string",
    )
    assert [r.CTI_DIARIA for r in care.icu_day(df).collect()] == [
        "SIM", "SIM", "SIM", "SIM", "NAO", "NAO",
    ]
    assert [r.CTI_DIARIA for r in care.icu_day(df, mode="intended").collect()] == [
        "SIM", "SIM", "SIM", "NAO", "SIM", "NAO",
    ]
    got = care.icu_day(df, codes=[9], names=["QUARTO"])
    assert {r.CTI_DIARIA for r in got.collect()} == {"SIM", "NAO"}


def test_translate_remove_count(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert shape.translate_columns(df, {"k": "K", "zz": "Z"}).columns == ["K"]
    assert shape.translate_columns(df, {"k": "K"}, keep_unmapped=True).columns == ["K", "v"]
    assert rows(shape.remove_rows(df, "k", [1])) == [(2, "b")]
    assert rows(shape.remove_rows(df, "k", [1, *range(10, 2000)])) == [(2, "b")]
    assert shape.remove_rows(df.select("v", "k"), "k", [1, *range(10, 2000)]).columns == ["v", "k"]
    assert shape.remove_rows(df, "k", [1, None]).count() == 0
    assert shape.remove_rows(df, "k", [None, *range(10, 2000)]).count() == 0
    assert shape.remove_rows(df, "k", []).count() == 3
    assert rows(shape.count_rows(df, "t")) == [(3, "t")]
    odd = df.withColumnRenamed("k", "Unnamed: 0")
    assert shape.drop_index_columns(odd).columns == ["v"]


def test_completeness(spark):
    df = spark.createDataFrame(
        [("1", ".", "x"), ("2", "None", None), ("3", " ", "y"), ("4", "a", "")],
        "COD_PREST string, TIPO_ALTA string, other string",
    )
    got = {r.column_name: tuple(r)[1:] for r in quality.completeness(df).collect()}
    assert got == {
        "COD_PREST": (1.0, 1.0, True),
        "TIPO_ALTA": (0.25, 0.8, False),
        "other": (0.5, None, True),
    }
    got = quality.completeness(df, failing_only=True)
    assert rows(got) == [("TIPO_ALTA", 0.25, 0.8)]


def test_rule_violations(spark):
    df = spark.createDataFrame(
        [(1, "A10", "01/01/2020", "BA"), (2, "a10", "99/99/2020", "BA"), (3, None, "x", "BA")],
        "n int, CID_SAIDA string, DT_OCORR_EVENTO string, UF_SOLICITANTE string",
    )
    got = quality.rule_violations(df)
    assert rows(got) == [("CID_SAIDA", "str", 2), ("DT_OCORR_EVENTO", "dd/mm/yyyy", 2)]
    assert quality.rule_violations(df, failing_only=False).count() == 3
    assert rows(quality.invalid_values(df, keys=["n"])) == [
        (2, "CID_SAIDA", "a10"),
        (2, "DT_OCORR_EVENTO", "99/99/2020"),
        (3, "CID_SAIDA", None),
        (3, "DT_OCORR_EVENTO", "x"),
    ]
    with pytest.raises(ValueError, match="none of the columns"):
        quality.rule_violations(df.select("n"))


def test_invalid_values_are_found_without_a_lambda(spark):
    df = spark.createDataFrame([("1", "x"), ("y", "3"), ("2", None)], "a string, b string")
    out = quality.invalid_values(df, {"a": "integer", "b": "integer"})
    assert rows(out) == [("a", "y"), ("b", None), ("b", "x")]
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_reports(spark):
    df = spark.createDataFrame(
        [("d", 1.0, "x"), ("d", 2.0, "y"), ("e", 4.0, "y"), ("e", 1.0, "y")],
        "TP_REDE_VIDAS string, CUSTO_POTENCIAL double, TP_ACOMODACAO_CIG string",
    )
    assert rows(reports.cost_by_network(df)) == [("d", 3.0), ("e", 5.0)]
    assert rows(reports.count_by_accommodation(df)) == [("x", 1), ("y", 3)]
    got = reports.share_by_accommodation(df, accommodation="TP_ACOMODACAO_CIG")
    assert rows(got) == [("x", 1, 0.25), ("y", 3, 0.75)]
    assert rows(reports.total_cost(df)) == [(8.0,)]


def test_csv(spark, tmp_path):
    folder = str(tmp_path / "csv")
    df = spark.createDataFrame(
        [("0", "007", "São"), ("1", None, "x")], "`Unnamed: 0` string, COD_PREST string, NOME string"
    )
    tables.write_csv(df, folder)
    got = tables.read_claims_csv(spark, folder)
    assert rows(got) == [(None, "x"), ("007", "São")]
    named = tables.read_claims_csv(spark, folder, columns=df.columns)
    assert named.columns == ["COD_PREST", "NOME"]
    latin = str(tmp_path / "latin")
    df.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(latin)
    got = tables.read_claims_csv(spark, latin, sep=";", encoding="ISO-8859-1")
    assert rows(got, "NOME") == [("São",), ("x",)]


def test_csv_keeps_quotes_breaks_and_empty_texts(spark, tmp_path):
    folder = str(tmp_path / "csv")
    texts = ['p, "q", r', "two\nlines", "a\\b", "", None, " x ", '"', "\\", "é;"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "n string, t string")
    tables.write_csv(df, folder)
    got = tables.read_claims_csv(spark, folder, multi_line=True)
    assert rows(got) == rows(df)
    (tmp_path / "upload.csv").write_text('t,n\n"p, ""q"", r",2\n"",3\n,4\n')
    got = tables.read_claims_csv(spark, str(tmp_path / "upload.csv"))
    assert rows(got, "n", "t") == [("2", 'p, "q", r'), ("3", ""), ("4", None)]


def test_append_refuses_other_columns(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.append_or_create(df, "strict")
    tables.append_or_create(df.select("v", "k"), "strict")
    assert spark.table("strict").count() == 2
    for other in (df.withColumn("w", F.lit(1)), df.drop("v")):
        with pytest.raises(ValueError, match="columns"):
            tables.append_or_create(other, "strict")
    spark.sql("DROP TABLE strict")


def test_scratch_folder_is_empty_after_a_run(spark, tmp_path):
    with staging.scratch(spark):
        staged = staging.stage(spark.range(5), "inside")
        path = Path(urlparse(staged.inputFiles()[0]).path).parent
        assert staged.count() == 5 and path.exists()
    assert not path.exists()


def test_code_table_folder(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "tables" / "CBHPM-5"))
    part = next((tmp_path / "tables" / "CBHPM-5").glob("*.parquet"))
    (tmp_path / "tables" / "amb 90.parquet").write_bytes(part.read_bytes())
    (tmp_path / "tables" / "notes.txt").write_text("x")
    got = tables.read_code_tables(spark, str(tmp_path / "tables"))
    assert set(got) == {"AMB_90", "CBHPM_5"}
    assert got["CBHPM_5"].count() == 2
    assert tables.table_name("a/b/Amb-90.v2.dta") == "AMB_90"


def test_sinks(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    tables.save_table(df, "saved")
    tables.save_table(df, "seen", temporary=True)
    assert spark.table("saved").count() == spark.table("seen").count() == 2
    for n in (2, 4):
        tables.append_or_create(df, "batches")
        assert spark.table("batches").count() == n
    tables.append_or_create(df.filter("k > 9"), "hollow")
    tables.append_or_create(df, "hollow")
    assert spark.table("hollow").count() == 2
    for n in (1, 2):
        tables.log_run(spark, "runs", email="e", company="c", person="p", phone="t")
        assert spark.table("runs").count() == n
    assert spark.table("runs").first().DT_EXECUCAO is not None
    assert tables.preview(spark.range(20)).count() == 10
    got = tables.all_text(df)
    assert dict(got.dtypes) == {"k": "string", "v": "string"}
    assert rows(got) == [("1", None), ("2", "b")]
    for name in ("saved", "batches", "hollow", "runs"):
        spark.sql(f"DROP TABLE {name}")


def test_staging_uses_the_named_folder(spark):
    root = staging.staging_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    staged, seen = staging.stage_and_measure(spark.range(5), "t", top=F.max("id"))
    assert seen == {"top": 4}
    assert all(root in f for f in staged.inputFiles())
