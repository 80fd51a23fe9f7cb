from datetime import date

import pytest
from pyspark.sql import functions as F

from carespan.functions import rules, text, values


def one(spark, expression, value=None, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("1.234,56", 1234.56),
        ("1234,5", 1234.5),
        ("12.5", 125.0),  # a decimal point is taken for a thousands point
        ("7", 7.0),
        (".", None),
        ("x", None),
        (None, None),
        ("nan", None),
        ("Infinity", None),
        ("-inf", None),
        ("12F", None),
        ("12D", None),
        ("0x1p3", None),
        ("-3,5", -3.5),
        ("1e3", 1000.0),
    ],
)
def test_money(spark, given, want):
    assert one(spark, values.parse_money("c"), given) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("08/07/2019", date(2019, 7, 8)),
        ("29/02/2020", date(2020, 2, 29)),
        ("29/02/2019", None),
        ("31/02/1999", None),
        ("1/2/1999", None),
        ("01/02/1999 ", None),
        ("1 /02/1999", None),
        ("01/02/0000", None),
        (".", None),
        ("", None),
        (None, None),
    ],
)
def test_date(spark, given, want):
    assert one(spark, values.parse_date("c"), given) == want
    # the pattern parser, which other formats use, agrees (but knows a year 0)
    if given != "01/02/0000":
        assert one(spark, F.try_to_date("c", "dd/MM/yyyy"), given) == want
    assert one(spark, rules.is_date("c"), given) is (want is not None)


@pytest.mark.parametrize("odd", ["nan", "12F", "0x1p3", "Infinity", "1\n2", "", "."])
def test_texts_that_only_look_like_numbers(spark, odd):
    assert one(spark, rules.is_float("c"), odd) is False
    assert one(spark, values.read_value("c", "money"), odd) is None


def test_integers_are_cast_only_where_the_text_has_their_shape(spark):
    texts = ["1.5", ".", " 12 ", "\x1f12\x7f", "+5", "+", "", "9223372036854775808", "٣", "12F", "1\xa0", "5e3", None, "00012"]
    df = spark.createDataFrame([(t,) for t in texts], "c string").withColumn("want", F.col("c").try_cast("bigint").isNotNull())
    out = df.withColumn("got", rules.is_integer("c"))
    assert out.filter("got <> want").count() == 0
    assert "RLIKE" in out._jdf.queryExecution().optimizedPlan().toString().upper()
    halves = spark.createDataFrame([(1.5,), (2.0,), (None,)], "c double")
    assert halves.filter(rules.is_integer("c")).count() == 2


def test_only_days_that_some_year_has_are_cast(spark):
    day = F.format_string("%02d/%02d/%04d", F.col("id") % 34, F.floor(F.col("id") / 34) % 15, F.element_at(F.array(F.lit(1999), F.lit(2000)), (F.col("id") % 2 + 1).cast("int")))
    df = spark.range(34 * 15 * 2 + 1).select(day.alias("c"))
    assert df.filter(~values.parse_date("c").eqNullSafe(F.try_to_timestamp("c", F.lit("dd/MM/yyyy")).cast("date"))).count() == 0
    assert df.filter(F.col("c").rlike(values.DAY) & values.parse_date("c").isNull()).select(F.substring("c", 1, 5)).distinct().count() <= 1


def test_rules_end_with_the_text(spark):
    assert one(spark, rules.is_date("c"), "01/02/2020\n") is False
    assert one(spark, rules.is_diagnosis("c"), "A10\n") is False
    assert one(spark, rules.is_company_number("c"), "11222333000181\n") is False
    assert one(spark, rules.is_company_number("c"), "11222333000181") is True


def test_numbers_without_nan(spark):
    assert one(spark, values.read_value("c", "number"), float("nan"), "double") is None
    assert one(spark, values.read_value("c", "number"), 2.5, "double") == 2.5
    assert one(spark, values.from_day_count("c"), "x") is None


def test_long_runs_of_blanks(spark):
    assert one(spark, text.clean_description("c"), "a" + " " * 250 + "b") == "A B"
    assert one(spark, text.clean_description("c", "observed"), "a" + " " * 250 + "b") == "A   B"


def test_other_date_format(spark):
    assert one(spark, values.parse_date("c", "yyyyMMdd"), "20190708") == date(2019, 7, 8)


def test_first_filled_skips_tokens(spark):
    df = spark.createDataFrame([(".", None, "", "a"), (" ", "b", "c", "d")], "w string, x string, y string, z string")
    got = df.select(values.first_filled(["w", "x", "y", "z"], values.PERSON_KEY_TOKENS)).collect()
    assert [r[0] for r in got] == ["a", " "]


def test_blank_is_never_null(spark):
    df = spark.createDataFrame([(None,), (".",), ("a",)], "c string")
    got = df.select(values.is_blank("c", (".",))).collect()
    assert [r[0] for r in got] == [True, True, False]


def test_day_count(spark):
    assert one(spark, values.from_day_count("c"), 366, "int") == date(1961, 1, 1)


def test_days_between_is_end_minus_start(spark):
    days = values.days_between(F.lit("2020-01-01").cast("date"), F.lit("2020-01-11").cast("date"))
    assert one(spark, days) == 10


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("Ação; nº 5, #1*", "ACAO NO 5 1"),
        ("straße Æon", "STRASSE AEON"),
        ("1.234,56", "1.23456"),
        ("plain", "PLAIN"),
        ("Ọ̀ṣun ł ø", "OSUN L O"),
        ("", ""),
        (None, None),
    ],
)
def test_normalize(spark, given, want):
    got = one(spark, text.normalize("c"), given)
    # a combining sign that stands alone has no ASCII form of its own
    assert (got.replace("̀", "") if got else got) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("dipirona 5mg", "DIPIRONA 5 MG"),
        ("dipirona 10mg", "DIPIRONA 10MG"),
        ("a med b", "A B"),
        ("medida", "MEDIDA"),
        ("soro (fisiológico) 0.9%", "SORO FISIOLOGICO 0 9 "),
        ("a,b;c#d*e", "ABCDE"),
        ("x-y_z/w\\v", "X Y Z W V"),
        ("nº 1ª", "N 1 "),
        ("a\t \n b", "A B"),
        ("  lead", " LEAD"),
        ("Ùnder", "ÙNDER"),  # not among the folded letters
        (None, None),
    ],
)
def test_clean_description(spark, given, want):
    assert one(spark, text.clean_description("c"), given) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("AÇÃO nº1", "ACAO N 1"),
        ("ação", "AÇÃO"),
        ("a;b,c#d*e\\f", "ABCDEF"),
        ("s 0 1 ]", "S 0 1  "),  # letters and digits stay
        ("a\tb", "A B"),
        (None, None),
    ],
)
def test_fold_by_table(spark, given, want):
    assert one(spark, text.fold_by_table("c"), given) == want


@pytest.mark.parametrize(
    ("rule", "good", "bad"),
    [
        (rules.is_diagnosis, ["C16", "Z99"], ["c16", "C1", "C160", None]),
        (rules.is_state, ["BA", "99"], ["B", "BAH", None]),
        (rules.is_integer, ["12", "-3"], ["1.5", "x", ".", None]),
        (rules.is_float, ["12", "1.5", "-3e2"], ["1,5", ".", None]),
        (rules.is_string, ["", "."], [None]),
        (rules.is_email, ["a@b"], ["@", "ab", "a@", None]),
        (
            rules.is_company_number,
            ["11222333000181", "11444777000161"],
            ["11222333000182", "11111111111111", "1122233300018", "1122233300018x", None],
        ),
    ],
)
def test_rules(spark, rule, good, bad):
    for value in good:
        assert one(spark, rule("c"), value) is True, value
    for value in bad:
        assert one(spark, rule("c"), value) is False, value
