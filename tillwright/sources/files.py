"""File readers with explicit column types."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import LOAD_ORDER, MONTH, column_type

# Times that a cleaner must parse itself, to tell a bad text from an empty one.
RAW_TEXT_TYPES = ("timestamp", "date")


def read_csv(
    spark: SparkSession, path: str, table: str, parsed_times: bool = False, multiline: bool = False
) -> DataFrame:
    """A headered CSV file or folder, columns matched by header name.

    Only one header line is read to learn the column order; types come from the data model, so there
    is no inference pass over the data. A file of the folder whose header is another one fails the
    read instead of being misread. Blanks around values are kept. Quotes inside quoted values are
    doubled, as in JSON metadata. `multiline` accepts line breaks inside values, but such files
    cannot be split between tasks.
    """
    options = _csv_options(multiline)
    return spark.read.options(**options).schema(_csv_schema(spark, path, table, parsed_times, options)).csv(path)


def _csv_options(multiline: bool) -> dict:
    return {
        "header": True, "quote": '"', "escape": '"', "multiLine": multiline, "enforceSchema": False,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
        # No text is this value, so nothing between two commas is null and "" stays an empty text.
        "nullValue": "\0",
    }


def _csv_schema(spark: SparkSession, path: str, table: str, parsed_times: bool, options: dict) -> StructType:
    fields = []
    for name in spark.read.options(**options).csv(path).columns:
        kind = column_type(table, name)
        if kind in RAW_TEXT_TYPES and not parsed_times:
            kind = "string"
        fields.append(f"`{name}` {kind}")
    return StructType.fromDDL(", ".join(fields))


def read_csv_apart(
    spark: SparkSession, path: str, table: str, parsed_times: bool = False, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows that can be read, the others) of what `read_csv` reads.

    The others are those with a value that is not of its column's type or with another number of fields than the
    header, as (table_name, file, line): the text as it stands in the file, so that it can be mended and loaded again.
    Every row is in exactly one of the two. All columns are parsed whatever is selected later, as a row's fate must not
    depend on the question; an empty value is no wrong one. Lines without any text are skipped.
    """
    options = _csv_options(multiline)
    schema = _csv_schema(spark, path, table, parsed_times, options)
    line = "_line"
    while line in schema.names:
        line += "_"
    rows = spark.read.options(
        **options, columnPruning=False, mode="PERMISSIVE", columnNameOfCorruptRecord=line
    ).schema(schema.add(line, "string")).csv(path)
    # Only values that are asked for are converted, and found wrong. This asks for all of them and is always true.
    converted = F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in schema if f.name != line]), F.lit(2)) < 2
    good = rows.where(F.col(line).isNull() & converted).drop(line)
    bad = rows.where(F.col(line).isNotNull() & converted).select(
        F.lit(table).alias("table_name"), F.col("_metadata.file_path").alias("file"), F.col(line).alias("line")
    )
    return good, bad


def read_csv_tables_apart(
    spark: SparkSession, folder: str, tables: tuple[str, ...] = LOAD_ORDER, multiline: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The raw set of a folder as `read_csv_apart` reads it, and the unreadable rows of all tables together."""
    parts = {name: read_csv_apart(spark, f"{folder}/{name}.csv", name, multiline=multiline) for name in tables}
    return {name: good for name, (good, _) in parts.items()}, reduce(DataFrame.unionAll, [bad for _, bad in parts.values()])


def read_csv_tables(
    spark: SparkSession,
    folder: str,
    tables: tuple[str, ...] = LOAD_ORDER,
    processed: bool = False,
    multiline: bool = False,
) -> dict[str, DataFrame]:
    """The raw (`<table>.csv`) or processed (`<table>_processed.csv`) set of a folder."""
    ending = "_processed.csv" if processed else ".csv"
    return {
        table: read_csv(spark, f"{folder}/{table}{ending}", table, processed, multiline)
        for table in tables
    }


def read_parquet_tables(
    spark: SparkSession, folder: str, tables: tuple[str, ...] = LOAD_ORDER
) -> dict[str, DataFrame]:
    return {table: spark.read.parquet(f"{folder}/{table}") for table in tables}


def read_months(
    spark: SparkSession, path: str, since: date | None = None, before: date | None = None
) -> DataFrame:
    """Transactions in `[since, before)` from the monthly store.

    The time filter alone would only skip row groups; naming the partition column as well keeps
    other months from being listed and opened at all.
    """
    rows = spark.read.parquet(path)
    month, at = F.col(MONTH), F.col("transaction_timestamp")
    if since is not None:
        start = F.lit(str(since)).cast("date")
        rows = rows.where((month >= F.trunc(start, "month")) & (at >= start.cast("timestamp")))
    if before is not None:
        end = F.lit(str(before)).cast("date")
        rows = rows.where((month <= F.trunc(end, "month")) & (at < end.cast("timestamp")))
    return rows.drop(MONTH)
