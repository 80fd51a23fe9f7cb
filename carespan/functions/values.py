"""Missing values, money, dates and other scalar helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens that stand for "missing" differ by stage.
COMPLETENESS_TOKENS = (".", "None", " ", "")
PERSON_KEY_TOKENS = (".", "")
CLIENT_CODE_TOKENS = (".", " ", "0")
STAY_DATE_TOKENS = (".",)
DIAGNOSIS_TOKENS = ("", " ")
PROCEDURE_TOKENS = ("", " ")

DATE_FORMAT = "dd/MM/yyyy"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column, tokens: Iterable[str]) -> Column:
    """NULL or one of the tokens; never NULL itself."""
    c = as_col(c)
    return c.isNull() | c.cast("string").isin(list(tokens))


def is_filled(c: str | Column, tokens: Iterable[str]) -> Column:
    return ~is_blank(c, tokens)


def blank_to_null(c: str | Column, tokens: Iterable[str]) -> Column:
    c = as_col(c)
    return F.when(is_filled(c, tokens), c)


def first_filled(cols: Sequence[str | Column], tokens: Iterable[str]) -> Column:
    tokens = list(tokens)
    return F.coalesce(*[blank_to_null(c, tokens).cast("string") for c in cols])


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"


def parse_number(c: str | Column, to: str = "double") -> Column:
    """Decimal text to a number; NULL for all else.

    A cast alone would also read ``nan``, ``Infinity``, ``12F`` and ``0x1p3``, and a
    NaN beats every amount it is compared with.
    """
    c = as_col(c).cast("string")
    return F.when(c.rlike(NUMBER), c.try_cast(to))


def parse_money(c: str | Column, to: str = "double") -> Column:
    """``1.234,56`` to 1234.56; text that is no number gives NULL."""
    plain = F.replace(
        F.replace(as_col(c), F.lit("."), F.lit("")), F.lit(","), F.lit(".")
    )
    return parse_number(plain, to)


def read_number(c: str | Column) -> Column:
    """A number column as double, NaN and infinities as NULL."""
    c = as_col(c).try_cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


# How a value column is read before rows are compared by it.
VALUE_READERS = {
    "money": parse_money,  # text in Brazilian notation
    "number": read_number,
    "text": lambda c: as_col(c).cast("string"),  # '9' ranks above '100'
}


def read_value(c: str | Column, parse: str) -> Column:
    if parse not in VALUE_READERS:
        raise ValueError(f"parse must be one of {sorted(VALUE_READERS)}, not {parse!r}")
    return VALUE_READERS[parse](c)


# Days that some year has: a cast that fails raises and catches inside, which is slow.
DAY = (
    r"^(?:(?:0[1-9]|1\d|2[0-9])/(?:0[1-9]|1[0-2])|30/(?:0[13-9]|1[0-2])|31/(?:0[13578]|1[02]))"
    r"/(?!0000)\d{4}\z"
)


def parse_date(c: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """Text to date; a text that is no such date gives NULL."""
    c = as_col(c)
    if fmt != DATE_FORMAT:
        return F.try_to_date(c, fmt)
    # the cast of an ISO text is several times faster than a pattern, above all
    # on texts that are no date
    iso = F.concat_ws("-", F.substring(c, 7, 4), F.substring(c, 4, 2), F.substring(c, 1, 2))
    return F.when(c.rlike(DAY), iso.try_cast("date"))


def days_between(start: str | Column, end: str | Column) -> Column:
    return F.datediff(as_col(end), as_col(start))


def from_day_count(c: str | Column) -> Column:
    """Days since 1960-01-01 (the epoch of one statistics package) to a date."""
    return F.date_add(F.lit("1960-01-01").cast("date"), as_col(c).try_cast("int"))
