"""JDBC reader."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, properties: dict[str, str] | None = None, **options) -> dict[str, str]:
    """Reader or writer options; names follow Spark's JDBC source, None values are left out."""
    merged = {"url": url, **(properties or {}), **options}
    return {key: str(value) for key, value in merged.items() if value is not None}


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A whole table. With `column`, `bounds` and `partitions` it is read by that many tasks."""
    split = (column, bounds, partitions)
    if any(part is not None for part in split) and not all(part is not None for part in split):
        raise ValueError("column, bounds and partitions belong together")
    low, high = bounds or (None, None)
    options = jdbc_options(
        url, properties, dbtable=table, partitionColumn=column, lowerBound=low, upperBound=high,
        numPartitions=partitions, fetchsize=fetch_size,
    )
    return spark.read.format("jdbc").options(**options).load()


def read_query(
    spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None
) -> DataFrame:
    """The result of a query that the database runs."""
    return spark.read.format("jdbc").options(**jdbc_options(url, properties, query=query)).load()


def month_predicates(column: str, first: date, last: date) -> list[str]:
    """Half-open conditions that split a table by calendar month, one task each.

    The outer months are open-ended and nulls join the first, so that no row is left out.
    """
    starts = []
    year, month = first.year, first.month
    while (year, month) <= (last.year, last.month):
        starts.append(date(year, month, 1))
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    if len(starts) < 2:
        return ["1 = 1"]
    conditions = [f"({column} < '{starts[1]}' OR {column} IS NULL)"]
    for start, end in zip(starts[1:], starts[2:]):
        conditions.append(f"({column} >= '{start}' AND {column} < '{end}')")
    conditions.append(f"({column} >= '{starts[-1]}')")
    return conditions


def read_by_month(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    first: date,
    last: date,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table split by month: even when ids have gaps or are skewed."""
    return spark.read.jdbc(
        url, table, predicates=month_predicates(column, first, last), properties=properties or {}
    )


def hash_predicates(column: str, parts: int) -> list[str]:
    """Conditions that split a table of whole-number ids into even parts; nulls join the first."""
    rest = f"mod(abs({column}), {parts})"
    return [f"({rest} = 0 OR {column} IS NULL)", *[f"({rest} = {i})" for i in range(1, parts)]]


def read_split(
    spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict[str, str] | None = None
) -> DataFrame:
    """A table or bracketed query, one task and connection per condition."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
