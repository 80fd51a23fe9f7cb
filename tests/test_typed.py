"""CSV by declared types; bad lines are put aside."""

from datetime import date

import pytest
from conftest import rows

from carespan.sources import typed

HEADER = "id;nome;valor;data;livre"
TYPES = {"id": "integer", "valor": "number", "data": "date"}


def write(tmp_path, lines, name="a.csv", encoding="latin1", header=HEADER):
    text = "\n".join(([header] if header else []) + lines) + "\n"
    (tmp_path / name).write_bytes(text.encode(encoding))
    return str(tmp_path)


def load(spark, path, **options):
    return typed.read_claims_typed(spark, path, TYPES, sep=";", encoding="ISO-8859-1", **options)


LINES = [
    '1;João;1.5;31/01/2020;"a;b"',
    "2;;;;",
    '3;"";"";"";""',
    "x;Ana;1;01/02/2020;z",
    "5;Ana;1,5;30/02/2020;z",
    "6;few",
    "7;a;1;01/01/2020;b;too many",
    '8;" q ""x"" ";nan;01/01/2020; ',
    "9.0;a;1e3;01/01/2020;",
]


def test_good_rows_and_reasons(spark, tmp_path):
    good, bad = load(spark, write(tmp_path, LINES))
    assert good.dtypes == [("id", "bigint"), ("nome", "string"), ("valor", "double"), ("data", "date"), ("livre", "string")]
    assert rows(good) == [
        (1, "João", 1.5, date(2020, 1, 31), "a;b"),
        (2, None, None, None, None),
        (3, "", None, None, ""),
    ]
    got = {r.line: r.reason for r in bad.collect()}
    assert got == {
        LINES[3]: "id is no integer",
        LINES[4]: "valor is no number; data is no date",
        LINES[5]: "wrong number of fields",
        LINES[6]: "wrong number of fields",
        '8;" q ""x"" ";nan;01/01/2020; ': "valor is no number",
        "9.0;a;1e3;01/01/2020;": "id is no integer",
    }
    assert all(r.file.endswith("a.csv") for r in bad.collect())


def test_several_files_and_a_sink(spark, tmp_path):
    path = write(tmp_path / "in" if (tmp_path / "in").mkdir() is None else tmp_path, LINES[:4])
    write(tmp_path / "in", ["y;a;1;;"], "b.csv")
    sink = str(tmp_path / "bad")
    for _ in range(2):
        load(spark, path, quarantine=sink)
    kept = spark.read.parquet(sink)
    assert kept.count() == 4 and {f.file.rsplit("/")[-1] for f in kept.collect()} == {"a.csv", "b.csv"}


def test_files_are_read_once(spark, tmp_path, monkeypatch):
    path = write(tmp_path, LINES)
    good, bad = load(spark, path)
    for df in (good, bad):
        assert "FileScan csv" not in df._jdf.queryExecution().executedPlan().toString()


def test_no_bad_lines_no_lines_no_header(spark, tmp_path):
    good, bad = load(spark, write(tmp_path, LINES[:1]))
    assert good.count() == 1 and bad.count() == 0
    (tmp_path / "e").mkdir()
    good, bad = load(spark, write(tmp_path / "e", []))
    assert good.count() == bad.count() == 0
    (tmp_path / "n").mkdir()
    path = write(tmp_path / "n", ["1;a;2;;", "z;a;2;;"], header=None)
    good, bad = load(spark, path, header=False, columns=HEADER.split(";"))
    assert rows(good) == [(1, "a", 2.0, None, None)] and bad.count() == 1
    with pytest.raises(ValueError, match="columns"):
        load(spark, path, header=False)


def test_wrong_declarations(spark, tmp_path):
    path = write(tmp_path, LINES)
    with pytest.raises(ValueError, match="types must be"):
        typed.read_claims_typed(spark, path, {"id": "int"}, sep=";")
    with pytest.raises(ValueError, match="no such columns"):
        typed.read_claims_typed(spark, path, {"other": "integer"}, sep=";")
    with pytest.raises(Exception, match="header"):
        load(spark, path, columns=["a", "b", "valor", "data", "id"])[0].collect()


def test_index_columns_go(spark, tmp_path):
    path = write(tmp_path, ["0;1;x"], header="Unnamed: 0;id;nome")
    good, _ = typed.read_claims_typed(spark, path, {"id": "integer"}, sep=";")
    assert good.columns == ["id", "nome"]
