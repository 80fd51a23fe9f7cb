"""Reading claims and code tables; writing results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from pathlib import PurePosixPath
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from carespan.operators.shape import drop_index_columns


# on either side: quotes are doubled, blanks stay
CSV_TEXT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# when reading, a quoted empty text is empty; only what stands for nothing is a gap
CSV_GAPS = {"emptyValue": "", "nullValue": "\0"}


def read_claims_csv(
    spark: SparkSession,
    path: str,
    *,
    sep: str = ",",
    encoding: str = "UTF-8",
    columns: Iterable[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Claims from CSV, every column text, without index columns; gaps stay NULL.

    A quote inside a quoted text is doubled, as the upload has it, and a backslash is
    a plain character. ``""`` is the empty text, nothing between two separators a gap.
    ``multi_line`` allows line breaks inside quotes; a file is then read by one task,
    so it should be cut into many. With ``columns`` the files are not opened to find
    their names.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    reader = reader.options(**CSV_TEXT, **CSV_GAPS).option("mode", "FAILFAST")
    # else every line is cut at any sign for a line break, a lone carriage return too
    reader = reader.option("multiLine", multi_line)
    if columns is not None:
        schema = StructType([StructField(c, StringType(), True) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return drop_index_columns(reader.csv(path))


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text; NULL stays NULL."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def table_name(file_name: str) -> str:
    """``Amb 90.parquet`` to ``AMB_90``."""
    stem = PurePosixPath(file_name).name.partition(".")[0]
    kept = [c if c.isascii() and c.isalnum() else "_" for c in stem]
    return "".join(kept).upper()


def read_code_tables(
    spark: SparkSession, root: str, *, fmt: str = "parquet"
) -> Mapping[str, DataFrame]:
    """All code tables of a folder, by table name: a file or a folder of files each."""
    inside = urlparse(root).path.rstrip("/") + "/"
    entry = F.substring_index(F.substring_index("path", inside, -1), "/", 1)
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{fmt}")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(entry.alias("entry"))  # names only, the files are not read
        .distinct()  # one row a table comes back, however many files it has
        .collect()
    )
    entries = sorted(row.entry for row in found)
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return {
        table_name(entry): reader.format(fmt).load(f"{root.rstrip('/')}/{entry}")
        for entry in map(unquote, entries)
    }


def save_table(df: DataFrame, name: str, *, temporary: bool = False) -> None:
    """Overwrite a table, or set a view of that name."""
    if temporary:
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)


def append_or_create(df: DataFrame, name: str) -> None:
    """Append the whole batch where the table has rows, else write it anew.

    The batch must have the table's columns, in any order: a missing or a further one
    is an error, nothing is left out. Whether the table has rows is looked up before
    the write, so two runs at once must not share a table.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name) or spark.table(name).isEmpty():
        df.write.mode("overwrite").saveAsTable(name)
        return
    wanted = spark.table(name).columns
    if sorted(wanted) != sorted(df.columns):
        raise ValueError(f"{name} has columns {wanted}, the batch has {df.columns}")
    df.select(*wanted).write.mode("append").saveAsTable(name)


def log_run(
    spark: SparkSession, name: str, *, email: str, company: str, person: str, phone: str
) -> DataFrame:
    """Append who ran the pipeline, and when; returns the row."""
    row = spark.range(1).select(
        F.lit(email).alias("EMAIL"),
        F.lit(company).alias("CNPJ"),
        F.lit(person).alias("NOME"),
        F.lit(phone).alias("TELEFONE"),
        F.current_timestamp().alias("DT_EXECUCAO"),
    )
    row.write.mode("append").saveAsTable(name)
    return row


def write_csv(df: DataFrame, path: str, *, encoding: str = "UTF-8") -> None:
    """CSV that ``read_claims_csv`` reads back value for value."""
    writer = df.write.mode("overwrite").option("header", True).option("encoding", encoding)
    writer.options(**CSV_TEXT).csv(path)


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    return df.limit(rows)
