from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carespan.operators import consolidate, diagnosis, policy

LINES = "u string, a string, v string, n int"


def lines(spark):
    return spark.createDataFrame(
        [
            ("x", "p", "1.000,50", 1),
            ("x", "q", "9,00", 2),
            ("x", "q", "1.000,50", 3),
            ("y", "r", "5", 4),
            ("y", None, "5", 5),
            ("z", "s", ".", 6),
            (None, "t", "7", 7),
        ],
        LINES,
    )


def args(**more):
    return {"attribute": "a", "unit": "u", "value": "v", **more}


def test_all_ties_multiply_rows(spark):
    got = consolidate.consolidate(lines(spark), **args(replace=False))
    assert rows(got, "n", "a_CORRIGIDA") == [
        (1, "p"), (1, "q"), (2, "p"), (2, "q"), (3, "p"), (3, "q"),
        (4, None), (4, "r"), (5, None), (5, "r"),
    ]


def test_one_keeps_rows(spark):
    got = consolidate.consolidate(lines(spark), **args(ties="one"))
    assert got.columns == ["u", "v", "n", "a"]
    assert rows(got, "n", "a") == [
        (1, "q"), (2, "q"), (3, "q"), (4, "r"), (5, "r"), (6, "s"), (7, "t"),
    ]


@pytest.mark.parametrize("ties", ["one", "all"])
def test_hot_units_give_the_same(spark, hot, monkeypatch, ties):
    from carespan.plans import skew

    data = lines(spark).unionByName(
        spark.range(300).select(
            F.lit("x").alias("u"), F.lit("w").alias("a"), F.lit("1").alias("v"), F.lit(9).alias("n")
        )
    )
    got = rows(consolidate.consolidate(data, **args(ties=ties, dedupe=False)))
    monkeypatch.setattr(skew, "rows_a_task", lambda facts: 10**9)
    assert rows(consolidate.consolidate(data, **args(ties=ties, dedupe=False))) == got


def test_lowest_value(spark):
    got = consolidate.consolidate(lines(spark), **args(agg="minimum", ties="one"))
    assert dict(rows(got, "n", "a"))[1] == "q"


def test_duplicate_rows_are_dropped_only_with_all_ties(spark):
    twice = lines(spark).filter("n = 2").unionByName(lines(spark).filter("n = 2"))
    assert consolidate.consolidate(twice, **args()).count() == 1
    assert consolidate.consolidate(twice, **args(dedupe=False)).count() == 2
    assert consolidate.consolidate(twice, **args(ties="one")).count() == 2


def test_spellings_and_wrong_arguments(spark):
    for spelling in consolidate.DIRECTIONS:
        consolidate.top_attributes(lines(spark), ["a"], "u", value="v", agg=spelling)
    with pytest.raises(KeyError):
        consolidate.top_attributes(lines(spark), ["a"], "u", value="v", agg="best")
    with pytest.raises(ValueError, match="ties"):
        consolidate.consolidate(lines(spark), **args(ties="some"))
    with pytest.raises(ValueError, match="parse"):
        consolidate.consolidate(lines(spark), **args(parse="int"))


def test_birth_date_as_text_and_as_number(spark):
    df = spark.createDataFrame(
        [("c", "9", "old"), ("c", "100", "new"), (None, "1", "x")],
        "COD_CLIENTE string, VLR_PROD_MEDICA string, DT_NASCIMENTO_CLIENTE string",
    )
    col = "DT_NASCIMENTO_CORRIGIDA"
    assert rows(consolidate.consolidate_birth_date(df), col) == [("old",), ("old",)]
    got = consolidate.consolidate_birth_date(df, mode="intended")
    assert rows(got, col) == [("new",), ("new",), ("x",)]


def test_change_report(spark):
    df = spark.createDataFrame(
        [("p", "q", "1,5"), ("q", "q", "2"), ("p", "p", "4")], "a string, b string, v string"
    )
    got = consolidate.change_report(df, attribute="a", corrected="b", value="v")
    assert rows(got) == [("p", 5.5, 4.0, 1), ("q", 2.0, 3.5, 0)]


def test_first_claim(spark):
    d = date(2020, 1, 1)
    df = spark.createDataFrame(
        [
            (1, "b", d),
            (1, "a", d.replace(day=5)),
            (2, "a", d),
            (2, "b", d.replace(day=2)),
            (3, None, d),
        ],
        "ID_INTERNACAO int, COD_CONTROLE string, DT_OCORR_EVENTO date",
    )
    got = consolidate.first_claim(df)
    assert rows(got.distinct(), "ID_INTERNACAO", "COD_CONTROLE2") == [
        (1, "b"), (1, "b"), (2, "a"), (2, "a"), (3, None),
    ]
    got = consolidate.first_claim(df, mode="observed")
    assert rows(got.select("ID_INTERNACAO", "COD_CONTROLE2").distinct()) == [
        (1, None), (2, "a"), (3, None),
    ]


def test_discharge_and_stay_type(spark):
    df = spark.createDataFrame(
        [
            (1, "a", "OBITO", "CLINICA", "1,00"),
            (1, "a", "ALTA", "CIRURGICA", "2.000,00"),
            (1, "b", "ÓBITO", "CLINICA", "3,00"),
            (2, "c", None, "CLINICA", "."),
        ],
        "ID_INTERNACAO int, COD_CONTROLE string, TIPO_ALTA string, TIPO_INTERNACAO string, "
        "VLR_PROD_MEDICA string",
    )
    got = consolidate.discharge_and_stay_type(df)
    cols = ("COD_CONTROLE", "TIPO_INTERNACAO", "OBITO", "VLR_PROD_MEDICA")
    assert rows(got, *cols) == [("a", "CIRURGICA", 0, 2000.0), ("b", "CIRURGICA", 1, 3.0)]
    got = consolidate.discharge_and_stay_type(df, collapse_to_claim=False)
    assert got.count() == 3
    report = consolidate.stay_type_report(df, got)
    assert rows(report) == [("CIRURGICA", 1, 3), ("CLINICA", 3, None)]


def diagnoses(spark):
    return spark.createDataFrame(
        [
            ("g", 5.0, " ", "P1", "S1"),
            ("g", 5.0, "X2", "P2", "S2"),
            ("g", 5.0, "X1", "P2", "S2"),
            ("g", 9.0, "", None, " "),
            ("h", 3.0, None, "P3", "S3"),
            ("h", 2.0, "X9", "P3", "S3"),
            (None, 1.0, "X", "P", "S"),
        ],
        "g string, v double, c1 string, c2 string, c3 string",
    )


def test_diagnosis(spark):
    given = {"group": "g", "columns": ["c1", "c2", "c3"], "value": "v"}
    got = diagnosis.consolidate_diagnosis(diagnoses(spark), **given)
    assert rows(got.select("g", "CID").distinct()) == [(None, None), ("g", None), ("h", "P3")]
    got = diagnosis.consolidate_diagnosis(diagnoses(spark), max_over="filled", **given)
    assert rows(got.select("g", "CID").distinct()) == [
        (None, None), ("g", "X1"), ("g", "X2"), ("h", "P3"),
    ]
    for over in ("all", "filled"):
        got = diagnosis.consolidate_diagnosis(
            diagnoses(spark), max_over=over, ties="one", **given
        )
        assert got.count() == 7
        want = "X1" if over == "filled" else None
        assert rows(got.filter("g = 'g'").select("CID").distinct()) == [(want,)]


def test_policy_holder(spark):
    df = spark.createDataFrame(
        [
            ("c", "1", "e", "n1", 1),
            ("c", "1", "e", "n1", 2),
            ("c", "2", "e", "n0", 3),
            ("c", "3", None, "n9", 4),
            ("d", ".", "e", "n5", 5),
            (" ", "1", "e", "n1", 6),
            (None, "1", "e", "n1", 7),
        ],
        "COD_CONTROLE2 string, ID_GRUPO string, CODIGO_ESTIPULANTE string, NR_CONTRATO string, z int",
    )
    for mode, want in (("observed", ("2", "n1")), ("intended", ("1", "n1"))):
        got = policy.consolidate_policy_holder(df, mode=mode)
        assert got.columns == [
            "CODIGO_ESTIPULANTE", "COD_CONTROLE2", "z", "ID_GRUPO", "NR_ESTIPULANTE", "NR_CONTRATO",
        ]
        assert got.count() == 7
        values = {r.z: (r.ID_GRUPO, r.NR_CONTRATO) for r in got.collect()}
        assert values[1] == values[4] == want
        assert values[5] == ("-1", "n5")
        assert values[6] == values[7] == (None, None)
