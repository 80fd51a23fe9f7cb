"""Claims from CSV by declared types, with bad lines put aside instead of ending the job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from carespan.functions.values import parse_date, parse_number
from carespan.operators.shape import drop_index_columns
from carespan.sources.staging import stage
from carespan.sources.tables import CSV_GAPS, CSV_TEXT

CORRUPT, FILE, LINE, REASONS = "_corrupt_line", "_file", "_bad_line", "_reasons"

# How a declared type is read; what gives NULL is no such value.
READERS = {
    "text": lambda c: c,
    "integer": lambda c: parse_number(c, "bigint"),
    "number": lambda c: parse_number(c, "double"),
    "date": parse_date,
}


class Loaded(NamedTuple):
    """``good`` has the declared columns and types, ``bad`` (file, line, reason)."""

    good: DataFrame
    bad: DataFrame


def header_names(spark: SparkSession, path: str, *, sep: str, encoding: str) -> list[str]:
    """The column names in the files' first lines; only the beginning of a file is read."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    return reader.options(**CSV_TEXT).csv(path).columns


def read_claims_typed(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str],
    *,
    sep: str = ",",
    encoding: str = "UTF-8",
    columns: Iterable[str] | None = None,
    header: bool = True,
    multi_line: bool = False,
    quarantine: str | None = None,
) -> Loaded:
    """Claims by declared types: ``text``, ``integer``, ``number`` or ``date`` (dd/mm/yyyy).

    Columns that ``types`` does not name are text. Nothing, or ``""``, is a gap in a column
    that is not text. A line with more or fewer fields than columns, and one with a value
    that is not of its column's type, is bad: it is no row of ``good``, and comes in ``bad``
    with its file, its text and all reasons. With ``quarantine`` the bad lines are also
    appended to Parquet files there. A file whose header has other names ends the job, as
    all its lines would be bad.

    The files are read once: rows and reasons are staged together, and each side reads its
    own columns. Without a header ``columns`` must name the fields.
    """
    unknown = set(types.values()) - set(READERS)
    if unknown:
        raise ValueError(f"types must be of {sorted(READERS)}, not {sorted(unknown)}")
    if columns is None:
        if not header:
            raise ValueError("files without a header need columns")
        columns = header_names(spark, path, sep=sep, encoding=encoding)
    columns = list(columns)
    absent = set(types) - set(columns)
    if absent:
        raise ValueError(f"no such columns: {sorted(absent)}")
    schema = StructType([StructField(c, StringType()) for c in [*columns, CORRUPT]])
    lines = (
        spark.read.options(**CSV_TEXT, **CSV_GAPS)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(schema)
        .csv(path)
    )
    read = stage(_checked(lines, columns, types, sep), "typed-lines")
    good = read.filter(F.size(REASONS) == 0).select(*[F.col(f"`{c}`") for c in columns])
    bad = read.filter(F.size(REASONS) > 0).select(
        F.col(FILE).alias("file"),
        F.col(LINE).alias("line"),
        F.array_join(REASONS, "; ").alias("reason"),
    )
    if quarantine is not None:
        bad.write.mode("append").parquet(quarantine)
    return Loaded(drop_index_columns(good), bad)


def _checked(
    lines: DataFrame, columns: list[str], types: Mapping[str, str], sep: str
) -> DataFrame:
    """Typed columns, the reasons why a line is bad, and its file and text if it is."""
    typed, reasons = [], []
    fields = F.col(CORRUPT).isNull()
    for c in columns:
        kind, given = types.get(c, "text"), F.col(f"`{c}`")
        value = READERS[kind](given)
        typed.append(value.alias(c))
        if kind != "text":
            wrong = fields & given.isNotNull() & (F.trim(given) != "") & value.isNull()
            reasons.append(F.when(wrong, F.lit(f"{c} is no {kind}")))
    reasons.append(F.when(~fields, F.lit("wrong number of fields")))
    found = F.array_compact(F.array(*reasons))
    text = F.coalesce(F.col(CORRUPT), _as_line(columns, sep))
    is_bad: Column = F.size(found) > 0
    return lines.select(
        *typed,
        found.alias(REASONS),
        F.when(is_bad, F.col("_metadata.file_path")).alias(FILE),
        F.when(is_bad, text).alias(LINE),
    )


def _as_line(columns: list[str], sep: str) -> Column:
    """A row as the line it was; quotes stand only where they are needed."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    plain = {"sep": sep, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""'}
    plain |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return F.to_csv(row, plain)
