import random
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carespan.operators import stays

DAY = timedelta(days=1)
SCHEMA = "n int, p string, s date, e date"


def make(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def number(df, link="previous"):
    return stays.number_stays(
        df, person="p", start="s", end="e", link=link, stay="id", out_start="a", out_end="b"
    )


def random_rows(seed, n, persons, null=0.0, span=60):
    rng = random.Random(seed)
    first = date(2020, 1, 1)
    out = []
    for i in range(n):
        s = first + rng.randrange(span) * DAY
        e = s + rng.randrange(5) * DAY
        out.append(
            (
                i,
                None if rng.random() < null else f"p{rng.randrange(persons)}",
                None if rng.random() < null else s,
                None if rng.random() < null else e,
            )
        )
    return out


def low(d):
    return (d is not None, d or date.min)


def expected(data, link):
    """Row by row, in order of person, admission, longest first."""
    order = sorted(
        data,
        key=lambda r: (
            (r[1] is not None, r[1] or ""),
            low(r[2]) if link == "previous" else low(r[2] or r[3]),
            # a missing discharge comes last
            -((r[3] if link == "previous" else r[3] or r[2]) or date.min).toordinal(),
            low(r[2]),
            -(r[3] or date.min).toordinal(),
        ),
    )
    ids, last, seen, stay = [], None, None, 0
    for _, p, s, e in order:
        same = last is not None and p is not None and last[1] == p
        if not same:
            seen = None
        if link == "previous":
            if e is not None:
                seen = max(seen or e, e)

            def near(day, s=s, seen=seen):
                return None not in (day, s, seen) and s - DAY <= day <= seen + DAY

            linked = same and (near(last[2]) or near(last[3]))
        else:
            begin, end = s or e, e or s
            linked = same and None not in (begin, seen) and begin <= seen + DAY
            if end is not None:
                seen = max(seen or end, end)
        stay += not linked
        ids.append(stay)
        last = (None, p, s, e)
    dates = {}
    for (_, _, s, e), i in zip(order, ids, strict=True):
        a, b = dates.get(i, (None, None))
        dates[i] = (
            min(x for x in (a, s) if x) if a or s else None,
            max(x for x in (b, e) if x) if b or e else None,
        )
    return sorted(
        ((p, s, e, i, *dates[i]) for (_, p, s, e), i in zip(order, ids, strict=True)),
        key=str,
    )


@pytest.mark.parametrize("link", ["previous", "running_max"])
@pytest.mark.parametrize(("seed", "null"), [(1, 0.0), (2, 0.0), (3, 0.1), (4, 0.4)])
def test_equals_row_by_row(spark, link, seed, null):
    data = random_rows(seed, 400, 12, null)
    got = number(make(spark, data), link)
    assert sorted(rows(got, "p", "s", "e", "id", "a", "b"), key=str) == expected(data, link)


@pytest.mark.parametrize("link", ["previous", "running_max"])
def test_hot_person_and_copies(spark, hot, link):
    data = random_rows(5, 150, 4, 0.2)
    data += [(1000 + i, None, None, None) for i in range(100)]
    data += [(2000 + i, "p1", date(2020, 1, 5), date(2020, 1, 6)) for i in range(100)]
    data += [(3000 + i, "p2", None, date(2020, 1, 6)) for i in range(100)]
    df = make(spark, data).repartition(5)
    got = number(df, link)
    assert sorted(rows(got, "p", "s", "e", "id", "a", "b"), key=str) == expected(data, link)
    assert got.select("n").distinct().count() == len(data)


def test_short_row_inside_a_long_one(spark):
    d = date(2020, 1, 1)
    data = [
        (1, "p", d, d + 9 * DAY),
        (2, "p", d + DAY, d + 2 * DAY),
        (3, "p", d + 5 * DAY, d + 6 * DAY),
    ]
    assert rows(number(make(spark, data)), "n", "id") == [(1, 1), (2, 1), (3, 2)]
    assert rows(number(make(spark, data), "running_max"), "n", "id") == [(1, 1), (2, 1), (3, 1)]


def test_one_day_apart_merges_two_do_not(spark):
    d = date(2020, 1, 1)
    data = [(1, "p", d, d), (2, "p", d + DAY, d + DAY), (3, "p", d + 3 * DAY, d + 3 * DAY)]
    for link in ("previous", "running_max"):
        assert rows(number(make(spark, data), link), "n", "id") == [(1, 1), (2, 1), (3, 2)]


@pytest.mark.parametrize("link", ["previous", "running_max"])
def test_order_of_input_does_not_matter(spark, link):
    data = random_rows(6, 200, 5, null=0.3, span=10)
    data += [(1000 + i, None, None, None) for i in range(40)]
    a = rows(number(make(spark, data), link))
    for parts in (1, 7):
        random.Random(parts).shuffle(data)
        assert rows(number(make(spark, data).repartition(parts), link)) == a


def test_claim_and_line_settle_the_order_of_unlinked_rows(spark):
    data = [(n, None, None, None) for n in (3, 1, 2)]
    df = make(spark, data).withColumns({"COD_CONTROLE": 10 - F.col("n"), "NR_LINHA": F.col("n")})
    assert rows(number(df), "n", "id") == [(1, 3), (2, 2), (3, 1)]


def test_empty(spark):
    assert number(make(spark, [])).count() == 0


def test_running_max_equals_session_windows(spark):
    """Spark's session windows with a gap of the row's length give the same stays."""
    data = random_rows(7, 500, 9)
    df = make(spark, data)
    gap = F.concat((F.datediff("e", "s") + 1).cast("string"), F.lit(" days"))
    want = df.groupBy("p", F.session_window(F.col("s").cast("timestamp"), gap)).count().count()
    assert number(df, "running_max").select("id").distinct().count() == want


def test_repair_dates(spark):
    data = [
        ("01/02/2020", "05/02/2020", "03/02/2020"),
        (".", "05/02/2020", "03/02/2020"),
        ("09/02/2020", ".", "03/02/2020"),  # discharge before admission: raised
        (".", "05/02/2020", "."),
        ("01/02/2020", ".", "."),
        (".", ".", "."),
        (None, "05/02/2020", "03/02/2020"),
    ]
    df = spark.createDataFrame(data, "DT_INTERNACAO string, DT_ALTA string, DT_OCORR_EVENTO string")
    out = [
        (r.DT_INTERNACAO_CORRIGIDA, r.DT_ALTA_CORRIGIDA)
        for r in stays.repair_dates(df).collect()
    ]
    f = date(2020, 2, 1)
    assert out == [
        (f, f + 4 * DAY),
        (f + 2 * DAY, f + 4 * DAY),
        (f + 8 * DAY, f + 8 * DAY),
        (f + 4 * DAY, f + 4 * DAY),
        (f, f),
        (None, None),
        (None, f + 4 * DAY),
    ]
    intended = stays.repair_dates(df, mode="intended").collect()
    assert intended[-1].DT_INTERNACAO_CORRIGIDA == f + 2 * DAY


def test_fill_stay_dates(spark):
    df = spark.createDataFrame(
        [(".", "b", "x"), ("a", ".", "y")], "DT_INTERNACAO string, DT_ALTA string, DT_OCORR_EVENTO string"
    )
    assert rows(stays.fill_stay_dates(df)) == [("a", "y", "y"), ("x", "b", "x")]


GAP_SCHEMA = "ID_INTERNACAO long, ID_PESSOA string, DT_INTERNACAO date, DT_ALTA date"


def gap_rows():
    d = date(2020, 1, 1)
    return [
        (1, None, d, d),
        (2, None, d + 3 * DAY, d + 4 * DAY),
        (3, "p", d, d + 2 * DAY),
        (3, "p", d, d + 2 * DAY),
        (4, "p", d + 12 * DAY, d + 12 * DAY),
        (9, "p", d + 80 * DAY, d + 81 * DAY),
        (10, "q", d, d),
    ]


@pytest.mark.parametrize("block", [1_000_000, 4])
def test_readmission_gap(spark, monkeypatch, block):
    monkeypatch.setattr(stays, "BLOCK", block)
    df = spark.createDataFrame(gap_rows(), GAP_SCHEMA)
    got = stays.readmission_gap(df, within_days=30)
    assert rows(got, "ID_INTERNACAO", "TEMPO_DESDE_ULTIMA_INTERNACAO", "REINTERNACAO") == [
        (1, None, False),
        (2, None, False),
        (3, None, False),
        (3, None, False),
        (4, 10, True),
        (9, 68, False),
        (10, None, False),
    ]
    got = stays.readmission_gap(df, mode="observed")
    assert rows(got, "ID_INTERNACAO", "TEMPO_DESDE_ULTIMA_INTERNACAO")[:2] == [(1, None), (2, 3)]


def test_consolidate_stays_keeps_inpatients(spark):
    data = [
        ("7", ".", "p", "01/01/2020", "02/01/2020", "01/01/2020"),
        (" ", "1", "p", "01/01/2020", "02/01/2020", "01/01/2020"),
        (None, ".", "p", "01/01/2020", "02/01/2020", "01/01/2020"),
    ]
    df = spark.createDataFrame(
        data,
        "NUM_AGR_INTER string, REGIME_DOMICILIAR string, ID_PESSOA string, "
        "DT_INTERNACAO string, DT_ALTA string, DT_OCORR_EVENTO string",
    )
    out = stays.consolidate_stays(df)
    assert out.count() == 1
    assert out.first().DT_ALTA == date(2020, 1, 2)
    assert "DT_ALTA" not in stays.consolidate_stays(df, stay_dates=False).columns


@pytest.mark.parametrize(("seed", "n", "persons", "null", "span"), [(1, 400, 6, 0.0, 60), (2, 400, 5, 0.15, 40), (3, 300, 1, 0.05, 300), (4, 60, 30, 0.4, 9)])
def test_session_windows_give_the_running_max(spark, seed, n, persons, null, span):
    df = make(spark, random_rows(seed, n, persons, null, span))
    assert rows(number(df, "session")) == rows(number(df, "running_max"))


def test_session_windows_with_hot_keys(spark, hot):
    data = random_rows(5, 120, 2, 0.2, 10)
    data += [(200 + i, None, None, None) for i in range(9)] + [(300 + i, "p1", None, None) for i in range(5)]
    df = make(spark, data)
    assert rows(number(df, "session")) == rows(number(df, "running_max"))


def test_sessions_that_touch_and_that_do_not(spark):
    first = date(2020, 2, 27)
    data = [
        (1, "a", first, first + DAY),
        (2, "a", first + 2 * DAY, first + 2 * DAY),  # the day after the discharge
        (3, "a", first + 4 * DAY, first + 9 * DAY),  # two days after
        (4, "a", first + 5 * DAY, first + 5 * DAY),  # inside
        (5, "a", first + 10 * DAY, None),
        (6, "b", first, first + DAY),
    ]
    got = {r.n: (r.id, r.a, r.b) for r in number(make(spark, data), "session").collect()}
    assert [got[n][0] for n in range(1, 7)] == [1, 1, 2, 2, 2, 3]
    assert got[1][1:] == (first, first + 2 * DAY) and got[4][1:] == (first + 4 * DAY, first + 9 * DAY)


def test_sessions_see_days_not_lines(spark):
    df = make(spark, [(i, "p", date(2020, 1, 1 + i % 3), date(2020, 1, 2 + i % 3)) for i in range(500)])
    _, seen = stays._session_groups(df, "p", "s", "e")
    assert seen["top"] == 167 and not seen["spread"]
    assert number(make(spark, []), "session").count() == 0
