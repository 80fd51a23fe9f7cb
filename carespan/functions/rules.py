"""Rules a filled value must meet, as predicates that are never NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carespan.functions.values import as_col, parse_date, parse_number


def is_date(c: str | Column) -> Column:
    """``dd/mm/yyyy`` and a day that exists."""
    return parse_date(c).isNotNull()


def is_string(c: str | Column) -> Column:
    return as_col(c).isNotNull()


def is_diagnosis(c: str | Column) -> Column:
    return F.coalesce(as_col(c).rlike(r"^[A-Z]\d{2}\z"), F.lit(False))


# Whatever the cast of a text reads as an integer has this shape.
INTEGER = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z"


def is_integer(c: str | Column) -> Column:
    c = as_col(c)
    # a cast that fails raises and catches inside, which costs many times a cast or a match;
    # the type's name is folded, so a column of text is matched and any other only cast
    shaped = (F.typeof(c) != "string") | c.cast("string").rlike(INTEGER)
    return F.when(shaped, c.try_cast("bigint")).isNotNull()


def is_float(c: str | Column) -> Column:
    return parse_number(c).isNotNull()


def is_state(c: str | Column) -> Column:
    return F.coalesce(F.length(as_col(c)) == 2, F.lit(False))


def is_email(c: str | Column) -> Column:
    c = as_col(c)
    n = F.length(c)
    return F.coalesce(c.contains("@") & (n > 2) & (n < 320), F.lit(False))


def is_company_number(c: str | Column) -> Column:
    """Fourteen digits, not all alike, whose last two are their check digits."""
    c = as_col(c)
    number = c.try_cast("bigint")
    # digits by division: far cheaper than cutting the text up
    digit = [F.call_function("div", number, F.lit(10 ** (13 - i))) % 10 for i in range(14)]

    def check(place: int) -> Column:
        # weights run 2..9 and start over, counted leftwards from the check digit
        total = F.lit(0)
        for i in range(place):
            total = total + digit[i] * (2 + (place - 1 - i) % 8)
        return (total * 10) % 11 % 10 == digit[place]

    good = c.rlike(r"^\d{14}\z") & ~c.rlike(r"^(\d)\1{13}\z") & check(12) & check(13)
    return F.coalesce(good, F.lit(False))


# name -> (predicate, what the report calls the expected type)
RULES = {
    "date": (is_date, "dd/mm/yyyy"),
    "string": (is_string, "str"),
    "cid": (is_diagnosis, "str"),
    "integer": (is_integer, "int"),
    "float": (is_float, "float"),
    "uf": (is_state, "str"),
    "email": (is_email, "str"),
    "cnpj": (is_company_number, "str"),
}
